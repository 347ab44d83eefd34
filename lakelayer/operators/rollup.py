"""Roll-ups from a child grain to its parent (payments and reviews to orders),
and allocation of a parent amount back down to the child grain.

All are aggregations grouped by the parent key: Spark reduces each parent to
one row per map task before the shuffle, so a parent with millions of
children costs one partial row per task. "Latest" and "largest" picks use
``max_by`` with a struct ordering key, which is a total order when the
struct ends with a unique id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def payments_to_order(
    payments: DataFrame,
    order_key: str,
    value_col: str,
    type_col: str,
    seq_col: str,
    installments_col: str | None = None,
) -> DataFrame:
    """One row per order: total paid (rounded to cents), number of payments,
    installments (max over payments, or the count when there is no column),
    and the type of the largest payment (ties broken by the sequence number)."""
    inst = F.max(installments_col) if installments_col else F.count(F.lit(1))
    return payments.groupBy(order_key).agg(
        F.round(F.sum(value_col), 2).alias("payment_value"),
        F.count(F.lit(1)).alias("n_payments"),
        inst.cast("int").alias("payment_installments"),
        F.max_by(F.col(type_col), F.struct(F.col(value_col), F.col(seq_col))).alias("payment_type"),
    )


def latest_per_key(df: DataFrame, key: str | list[str], value_cols: list[str], order: list[str | Column]) -> DataFrame:
    """Values of the latest row per key by ``order`` (struct order), and the row count."""
    ks = [key] if isinstance(key, str) else list(key)
    ordering = F.struct(*[F.col(o) if isinstance(o, str) else o for o in order])
    picked = F.max_by(F.struct(*[F.col(c) for c in value_cols]), ordering).alias("_latest")
    out = df.groupBy(*ks).agg(picked, F.count(F.lit(1)).alias("n_rows"))
    return out.select(*ks, *[F.col(f"_latest.{c}").alias(c) for c in value_cols], "n_rows")


def allocate(items: DataFrame, parent_key: str, weight_col: str, parents: DataFrame, amount_col: str, out_col: str) -> DataFrame:
    """Split ``parents.amount_col`` over ``items`` in proportion to ``weight_col``.

    Parent weight totals come from a partial aggregation joined back on the
    parent key (no window over a possibly huge parent). Items of a parent
    with zero total weight share equally."""
    totals = items.groupBy(parent_key).agg(
        F.sum(weight_col).alias("_wsum"), F.count(F.lit(1)).alias("_nitems")
    )
    j = items.join(totals, parent_key, "left").join(parents.select(parent_key, amount_col), parent_key, "left")
    share = F.when(F.col("_wsum") != 0, F.col(weight_col) / F.col("_wsum")).otherwise(1.0 / F.col("_nitems"))
    return j.withColumn(out_col, F.col(amount_col) * share).drop("_wsum", "_nitems")
