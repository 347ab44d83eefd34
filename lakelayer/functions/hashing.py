"""Change-detection hash over a list of columns.

``mode="safe"`` (default) encodes each value as ``<length>:<text>`` and NULL
as ``~`` before joining with ``|``, so ``(NULL, 'a')`` and ``('a', NULL)`` or
``('a|b', 'c')`` and ``('a', 'b|c')`` no longer collide.

``mode="concat"`` is the plain ``sha2(concat_ws('|', cols), 256)``: it skips
NULLs and does not escape the separator. It is kept for compatibility with
tables hashed that way.

Values are hashed through their string cast; doubles therefore hash through
Spark's double-to-string formatting.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NULL_TOKEN = "~"
SEPARATOR = "|"


def canonical_text(col: Column | str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    s = c.cast("string")
    return F.coalesce(F.concat(F.length(s).cast("string"), F.lit(":"), s), F.lit(NULL_TOKEN))


def change_hash(cols: list[str | Column], mode: str = "safe") -> Column:
    if not cols:
        raise ValueError("change_hash needs at least one column")
    if mode == "safe":
        body = F.concat_ws(SEPARATOR, *[canonical_text(c) for c in cols])
    elif mode == "concat":
        body = F.concat_ws(SEPARATOR, *[(F.col(c) if isinstance(c, str) else c).cast("string") for c in cols])
    else:
        raise ValueError(f"unknown hash mode '{mode}'")
    return F.sha2(body, 256)
