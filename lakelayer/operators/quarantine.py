"""Row-level quarantine: split clean rows from rejects with a stated reason.

Two entry shapes:

* ``split(typed_df)`` for the output of ``apply_contract`` (reason already set);
* ``route(df, schema_or_required)`` for a DataFrame that carries typed columns
  and ``_corrupt_record`` but no reason yet (e.g. a typed PERMISSIVE read);
  required fields are the non-nullable ones of the schema.

Clean and reject frames are complementary filters of the same lineage. To
avoid scanning the input twice, ``with_status`` tags each row and sinks write
one dataset partitioned by ``_status``; clean and rejects are then pruned reads.
Counts come from one ``groupBy(reason)`` or from ``df.observe`` during the write.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakelayer.operators.contract import CORRUPT_COL, REASON_COL

STATUS_COL = "_status"
CLEAN = "clean"
QUARANTINE = "quarantine"


def required_columns(schema_or_required) -> list[str]:
    if isinstance(schema_or_required, T.StructType):
        return [f.name for f in schema_or_required.fields if not f.nullable and f.name != CORRUPT_COL]
    return list(schema_or_required)


def reject_condition(df: DataFrame, required: list[str], corrupt_col: str = CORRUPT_COL) -> Column:
    """``_corrupt_record IS NOT NULL OR req_1 IS NULL OR ...``."""
    absent = [c for c in required if c not in df.columns]
    if absent:
        raise ValueError(f"required columns absent from the DataFrame: {absent}")
    conds = [F.col(c).isNull() for c in required]
    if corrupt_col in df.columns:
        conds.insert(0, F.col(corrupt_col).isNotNull())
    return reduce(or_, conds) if conds else F.lit(False)


def reason_expr(df: DataFrame, required: list[str], corrupt_col: str = CORRUPT_COL) -> Column:
    """First match: ``malformed_record``, then ``missing_required_field:<c>``."""
    branches = []
    if corrupt_col in df.columns:
        branches.append((F.col(corrupt_col).isNotNull(), "malformed_record"))
    branches += [(F.col(c).isNull(), f"missing_required_field:{c}") for c in required]
    if not branches:
        return F.lit(None).cast("string")
    expr = F.when(branches[0][0], F.lit(branches[0][1]))
    for cond, label in branches[1:]:
        expr = expr.when(cond, F.lit(label))
    return expr


def route(df: DataFrame, schema_or_required, corrupt_col: str = CORRUPT_COL) -> DataFrame:
    """Add ``_quarantine_reason`` to a typed frame (NULL for clean rows)."""
    required = required_columns(schema_or_required)
    reject_condition(df, required, corrupt_col)  # validates the columns
    return df.withColumn(REASON_COL, reason_expr(df, required, corrupt_col))


def clean_rows(df: DataFrame) -> DataFrame:
    out = df.filter(F.col(REASON_COL).isNull()).drop(REASON_COL)
    return out.drop(CORRUPT_COL) if CORRUPT_COL in out.columns else out


def rejected_rows(df: DataFrame) -> DataFrame:
    return df.filter(F.col(REASON_COL).isNotNull())


def split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(clean, rejects) from a frame that carries ``_quarantine_reason``."""
    return clean_rows(df), rejected_rows(df)


def with_status(df: DataFrame) -> DataFrame:
    return df.withColumn(
        STATUS_COL, F.when(F.col(REASON_COL).isNull(), F.lit(CLEAN)).otherwise(F.lit(QUARANTINE))
    )


def reason_counts(df: DataFrame) -> DataFrame:
    """Rows per reason, with ``clean`` for the NULL reason: one partial aggregate."""
    return df.groupBy(F.coalesce(F.col(REASON_COL), F.lit(CLEAN)).alias("reason")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )


def observe_counts(df: DataFrame, name: str = "quarantine") -> tuple[DataFrame, Observation]:
    """Attach clean/reject counters that are filled by whatever action runs ``df``."""
    obs = Observation(name)
    observed = df.observe(
        obs,
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col(REASON_COL).isNull()).alias("clean_rows"),
        F.count_if(F.col(REASON_COL).isNotNull()).alias("quarantine_rows"),
    )
    return observed, obs
