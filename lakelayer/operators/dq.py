"""Data-quality rules evaluated in one aggregation.

Each rule is a condition that is true for a *failing* row. All rules are
counted by a single ``agg`` (one scan, partial aggregation, one tiny shuffle),
then unpivoted to one row per rule. ``unique`` rules count surplus rows of a
key with ``count - count(distinct key)`` inside the same aggregation; the key is
counted as a struct, so a NULL key is a key like any other.

``enforce`` reads the report (one row per rule, a bounded result) and, in
``fail`` mode, raises when any rule has failures; in ``warn`` mode it returns
the report for logging.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class DataQualityError(RuntimeError):
    pass


@dataclass(frozen=True)
class Rule:
    name: str
    failing: Column | None = None  # row-level: true when the row breaks the rule
    unique: tuple[str, ...] = ()  # key-level: the key must be unique

    @staticmethod
    def not_null(col: str) -> "Rule":
        return Rule(f"not_null:{col}", F.col(col).isNull())

    @staticmethod
    def in_range(col: str, lo, hi) -> "Rule":
        c = F.col(col)
        return Rule(f"in_range:{col}", c.isNull() | (c < lo) | (c > hi))

    @staticmethod
    def in_set(col: str, values: list) -> "Rule":
        c = F.col(col)
        return Rule(f"in_set:{col}", c.isNull() | ~c.isin(values))

    @staticmethod
    def positive(col: str) -> "Rule":
        c = F.col(col)
        return Rule(f"positive:{col}", c.isNull() | (c <= 0))

    @staticmethod
    def unique_key(*cols: str) -> "Rule":
        return Rule("unique:" + ",".join(cols), unique=tuple(cols))


def report(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """One row per rule: ``rule, n_rows, n_failed, passed``."""
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, r in enumerate(rules):
        if r.unique:
            aggs.append(
                (F.count(F.lit(1)) - F.count_distinct(F.struct(*[F.col(c) for c in r.unique]))).alias(f"_f{i}")
            )
        else:
            aggs.append(F.count_if(r.failing).alias(f"_f{i}"))
    counted = df.agg(*aggs)
    rows = F.array(
        *[
            F.struct(F.lit(r.name).alias("rule"), F.col(f"_f{i}").cast("bigint").alias("n_failed"))
            for i, r in enumerate(rules)
        ]
    )
    return counted.select(F.col("_n").alias("n_rows"), F.inline(rows)).select(
        "rule", "n_rows", "n_failed", (F.col("n_failed") == 0).alias("passed")
    )


def enforce(df: DataFrame, rules: list[Rule], mode: str = "warn") -> list[dict]:
    if mode not in ("warn", "fail"):
        raise ValueError(f"unknown quality mode '{mode}'")
    rows = [r.asDict() for r in report(df, rules).collect()]
    failed = [r for r in rows if not r["passed"]]
    if failed and mode == "fail":
        raise DataQualityError("quality rules failed: " + ", ".join(f"{r['rule']}={r['n_failed']}" for r in failed))
    return rows
