"""Deduplication to one row per natural key.

``dedup_latest`` keeps, per key, the row that is greatest by the given order
columns and then by every remaining column (a total order, so the survivor
does not depend on partitioning or retries). It is an aggregation,
``max(struct(order..., rest...))`` grouped by the key, not a window: Spark
combines rows map-side before the shuffle, so a key that holds a third of the
input is reduced to one row per map task instead of being sorted in one task.

With ``partition_by`` (some of the keys) the rows are shuffled by those alone and a join on
them needs no second shuffle of the result. Nothing is combined before that shuffle then:
it suits keys with few duplicates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dedup_latest(df: DataFrame, keys: str | list[str], order_by: list[str | Column], partition_by: str | None = None) -> DataFrame:
    ks = [keys] if isinstance(keys, str) else list(keys)
    if partition_by is not None:
        if partition_by not in ks:
            raise ValueError(f"'{partition_by}' is not one of the keys")
        df = df.repartition(F.col(partition_by))
    order_cols = [(F.col(o) if isinstance(o, str) else o).alias(f"_o{i}") for i, o in enumerate(order_by)]
    rest = [c for c in df.columns if c not in ks]
    # The row itself follows the order fields and breaks their ties, in column order. A
    # column that is an order field is not carried twice.
    at = {o: f"_o{i}" for i, o in reversed(list(enumerate(order_by))) if isinstance(o, str) and o in rest}
    packed = F.struct(*order_cols, *[F.col(c).alias(c) for c in rest if c not in at])
    best = df.groupBy(*ks).agg(F.max(packed).alias("_best"))
    return best.select(*ks, *[F.col(f"_best.{at.get(c, c)}").alias(c) for c in rest]).select(*df.columns)
