"""Lookups (code translation) with a size-checked broadcast.

A lookup side is marked for broadcast only when its row count is known (a fixed table,
or a count that the caller has made) and within a limit. All others are left to the
planner, which goes by their bytes (and AQE by the bytes measured at run time).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULT_MAX_BROADCAST_ROWS = 1_000_000


def bounded_broadcast(df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS, known_rows: int | None = None) -> DataFrame:
    return F.broadcast(df) if known_rows is not None and known_rows <= max_rows else df


def lookup_table(spark: SparkSession, mapping: dict[str, str], key: str = "code", value: str = "label") -> tuple[DataFrame, int]:
    rows = sorted(mapping.items())
    df = spark.createDataFrame(rows, schema=f"{key} string, {value} string")
    return df, len(rows)


def translate(
    df: DataFrame,
    lookup: DataFrame,
    src_col: str,
    out_col: str,
    key: str = "code",
    value: str = "label",
    fallback: str = "lower",
    lookup_rows: int | None = None,
) -> DataFrame:
    """Left-join ``lookup`` on ``src_col`` and add ``out_col``. Codes missing from
    the lookup fall back to ``lower(src)`` (``fallback="lower"``), to the code
    itself (``"code"``) or to NULL (``None``)."""
    side = bounded_broadcast(lookup.select(F.col(key).alias("_lk"), F.col(value).alias("_lv")), known_rows=lookup_rows)
    joined = df.join(side, df[src_col] == side["_lk"], "left")
    if fallback == "lower":
        out = F.coalesce(F.col("_lv"), F.lower(F.col(src_col)))
    elif fallback == "code":
        out = F.coalesce(F.col("_lv"), F.col(src_col))
    else:
        out = F.col("_lv")
    return joined.withColumn(out_col, out).drop("_lk", "_lv")
