"""Column-expression helpers: change hash, surrogate keys, calendar rules.

Everything here returns a ``Column`` built from Spark built-ins, so it stays
inside whole-stage codegen and needs no Python at run time.
"""

from lakelayer.functions.calendar import easter_sunday, is_br_national_holiday
from lakelayer.functions.hashing import change_hash, canonical_text
from lakelayer.functions.keys import surrogate_key, uuid_shape

__all__ = [
    "change_hash",
    "canonical_text",
    "surrogate_key",
    "uuid_shape",
    "easter_sunday",
    "is_br_national_holiday",
]
