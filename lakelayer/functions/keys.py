"""Surrogate keys.

The default key is deterministic: SHA-256 of the natural key (and, for
versioned rows, the version start) written in the 8-4-4-4-12 shape of a UUID.
A retried task or a re-run produces the same key, unlike ``uuid()``, which is
re-drawn on every evaluation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakelayer.functions.hashing import canonical_text


def uuid_shape(hex64: Column) -> Column:
    """First 32 hex digits of a hash as ``xxxxxxxx-xxxx-xxxx-xxxx-xxxxxxxxxxxx``."""
    return F.concat_ws(
        "-",
        F.substring(hex64, 1, 8),
        F.substring(hex64, 9, 4),
        F.substring(hex64, 13, 4),
        F.substring(hex64, 17, 4),
        F.substring(hex64, 21, 12),
    )


def surrogate_key(cols: list[str | Column], namespace: str = "") -> Column:
    parts = [canonical_text(c) for c in cols]
    if namespace:
        parts.insert(0, F.lit(namespace))
    return uuid_shape(F.sha2(F.concat_ws("|", *parts), 256))
