"""Silver layer: cleaned, typed, deduplicated, validated rows.

Each step is a DataFrame-to-DataFrame function; a job chains them and upserts
the result (``operators.merge.merge_scd1``) into a path table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakelayer.operators.dedup import dedup_latest
from lakelayer.operators.lookup import translate

__all__ = ["clean_strings", "dedup_latest", "translate", "spend_segment", "normalise_zip"]

# Default spend bands for the customer segment (lower bound, label), highest
# first; callers with other amounts pass their own.
SEGMENT_BANDS = [(3_000_000.0, "high"), (1_500_000.0, "mid"), (0.0, "low")]
NO_ORDERS_SEGMENT = "none"


def clean_strings(
    df: DataFrame,
    trim: list[str] = (),
    lower: list[str] = (),
    upper: list[str] = (),
    empty_as_null: bool = True,
) -> DataFrame:
    """Trim, case-fold and turn empty strings into NULL, in one projection."""
    exprs = {}
    for c in set(trim) | set(lower) | set(upper):
        e: Column = F.trim(F.col(c))
        if c in lower:
            e = F.lower(e)
        if c in upper:
            e = F.upper(e)
        if empty_as_null:
            e = F.when(e != "", e)
        exprs[c] = e
    return df.withColumns(exprs) if exprs else df


def normalise_zip(df: DataFrame, source_col: str, width: int = 5, out_col: str = "zip_code") -> DataFrame:
    """Zip prefixes as text under one name for every source; prefixes that lost
    their leading zeros (read as numbers somewhere upstream) are padded back."""
    z = F.trim(F.col(source_col).cast("string"))
    return df.withColumn(out_col, F.when(F.length(z) < width, F.lpad(z, width, "0")).otherwise(z))


def spend_segment(
    customers: DataFrame,
    orders: DataFrame,
    customer_key: str,
    order_customer_key: str,
    amount_col: str,
    out_col: str = "segment",
    bands: list[tuple[float, str]] = SEGMENT_BANDS,
) -> DataFrame:
    """Customer segment from total spend by ``bands``. Orders are summed per customer first
    (partial aggregation, so a customer with a huge order count costs one row
    per map task), then left-joined: customers without orders get ``none``."""
    spend = orders.groupBy(F.col(order_customer_key).alias("_ck")).agg(F.sum(amount_col).alias("_spend"))
    j = customers.join(spend, customers[customer_key] == spend["_ck"], "left")
    seg = F.when(F.col("_spend").isNull(), F.lit(NO_ORDERS_SEGMENT))
    for lo, label in bands:
        seg = seg.when(F.col("_spend") >= lo, F.lit(label))
    return j.withColumn(out_col, seg.otherwise(F.lit(bands[-1][1]))).drop("_ck", "_spend")


def silver_upsert(
    spark,
    source,
    key: list[str],
    order_by: list,
    silver_root: str,
    trim: list[str] = (),
    lower: list[str] = (),
    upper: list[str] = (),
    rules: list = (),
    quality_mode: str = "warn",
    latest_wins: bool = False,
    notes: dict | None = None,
    gone=None,
):
    """Clean -> dedup -> quality -> upsert into the keyed table at ``silver_root``.

    The deduplicated frame is checkpointed (to the session's checkpoint folder)
    so the quality report and the merge read it instead of recomputing the
    lineage; in ``fail`` mode nothing is committed when a rule fails. Only buckets with
    incoming keys are rewritten. With ``latest_wins`` stored and new rows of a key are
    compared in ``order_by``, and stored rows of the keys ``gone`` are taken out first.
    ``notes`` are stored in the same commit.
    Returns ``(table, report_rows)``."""
    from lakelayer.operators import dq
    from lakelayer.session import checkpoint_root
    from lakelayer.sinks.keyed import KeyedTable

    cleaned = clean_strings(source, trim=list(trim), lower=list(lower), upper=list(upper))
    deduped = dedup_latest(cleaned, key, order_by)
    checkpoint_root(spark)
    staged = deduped.checkpoint()
    report = dq.enforce(staged, list(rules), quality_mode) if rules else []
    table = KeyedTable(spark, silver_root, key)
    if not table.exists():
        table.load(staged, notes)
    elif latest_wins:
        # A stored row yields only to one that is later in the same order.
        table.merge_latest(staged, order_by, notes, gone, staged=True)
    else:
        table.merge_scd1(staged, notes)
    return table, report
