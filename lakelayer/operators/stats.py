"""Exact grouped medians with bounded memory per task.

``median(v)`` as an aggregate keeps every distinct value of a group in one
buffer, so one hot group (a zip code with a third of all points) would be
held by one task. Here:

1. One partial aggregation counts each group's values, for all columns at once.
2. Groups with at most ``small_group_rows`` values take Spark's exact ``median``
   (bounded buffer). When there is no larger group (the usual case) that is one
   aggregation over the input.
3. For larger groups the value of each middle rank is found digit by digit. A
   double's 64 bits, read as an integer and flipped for negative numbers, sort like the
   numbers themselves, with NaN last. That integer has seven digits of at most ten
   bits. A round counts, per group, column and rank, how many values with the digits
   known so far have each next digit (map-side partial sums, at most 1,024 rows per
   group and rank), and keeps the digit that the rank falls in. The rounds end when every
   slice is small enough to be sorted, and after seven at the latest: then the value itself is known,
   whatever the values are. The state of a round has two rows
   per large group and column; it is checkpointed into the session's checkpoint folder
   and broadcast to the scan behind a count, so a hot group's rows are filtered where
   they are read and never shuffled whole to one task.

The median of an even count is the midpoint of the two middle values, as
``percentile(v, 0.5)`` interpolates. Groups and values are those of the plain
aggregate: NULL is a group, a group of NULL values has a NULL median, NaN is
the largest value, and -0.0 equals 0.0.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakelayer.operators.lookup import bounded_broadcast
from lakelayer.session import checkpoint_root

#: Bits of the digits from the highest down; together 64.
DIGITS = (4, 10, 10, 10, 10, 10, 10)


def _midpoint(lo_v, hi_v):
    return F.when(lo_v == hi_v, lo_v).otherwise(lo_v * F.lit(0.5) + hi_v * F.lit(0.5))


def ordered_bits(v: Column) -> Column:
    """64-bit integer that sorts like the double: sign, exponent and mantissa as IEEE 754
    stores them, negated for negative numbers. NaN comes last; -0.0 and 0.0 are equal."""
    a = F.abs(v)
    near = F.floor(F.log2(a)).cast("int")
    # The logarithm may be off by one next to a power of two; powers of two are exact.
    e = near + (F.pow(F.lit(2.0), near + 1) <= a).cast("int") - (F.pow(F.lit(2.0), near) > a).cast("int")
    normal = (e + 1023).cast("long") * F.lit(2**52) + ((a / F.pow(F.lit(2.0), e) - 1.0) * F.lit(2.0**52)).cast("long")
    tiny = (a * F.lit(2.0**537) * F.lit(2.0**537)).cast("long")
    bits = (
        F.when(F.isnan(v), F.lit(0x7FF8 << 48))
        .when(a == float("inf"), F.lit(0x7FF0 << 48))
        .when(a < 2.0**-1022, tiny)
        .otherwise(normal)
    )
    return F.when((v < 0) & ~F.isnan(v), -bits).otherwise(bits)


def grouped_median(df: DataFrame, group_cols: list[str], value_col: str, out_col: str = "median", **options) -> DataFrame:
    """The median of one column; options as for ``grouped_medians``."""
    return grouped_medians(df, group_cols, {out_col: value_col}, **options)


def grouped_medians(
    df: DataFrame,
    group_cols: list[str],
    medians: dict[str, str],
    small_group_rows: int = 1_000_000,
    max_broadcast_groups: int = 100_000,
) -> DataFrame:
    """``medians``: output column -> value column. The counting pass reads the group
    columns only; the values of all columns are read together."""
    g = list(group_cols)
    outs = list(medians)
    rows = df.select(*g, *[F.col(c).cast("double").alias(f"_v{i}") for i, c in enumerate(medians.values())])
    large = rows.groupBy(*g).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > small_group_rows)
    checkpoint_root(df.sparkSession)
    large = large.select(*g).checkpoint()
    n_large = large.count()
    plain = [F.median(f"_v{i}").alias(o) for i, o in enumerate(outs)]
    if n_large == 0:
        # Every group is small: no row needs routing, one aggregation does it.
        return rows.groupBy(*g).agg(*plain)
    # Each large group has more than small_group_rows rows, so their number
    # is at most rows / small_group_rows; the broadcast is checked against it.
    keys = _renamed(bounded_broadcast(large, max_rows=max_broadcast_groups, known_rows=n_large), g)
    small = rows.join(keys, _same(rows, g), "left_anti").groupBy(*g).agg(*plain)
    hot = rows.join(keys, _same(rows, g), "left_semi")
    exact = _by_digits(hot, g, len(outs), small_group_rows, 2 * len(outs) * n_large, 2 * len(outs) * max_broadcast_groups)
    exact = _renamed(exact, g)
    joined = large.join(exact, _same(large, g), "left")
    return small.unionByName(joined.select(*g, *[F.col(f"_m{i}").alias(o) for i, o in enumerate(outs)]))


def _renamed(df, g) -> DataFrame:
    return df.withColumnsRenamed({c: f"_g{i}" for i, c in enumerate(g)})


def _same(df, g):
    """Equal groups, NULL being a group like any other."""
    return reduce(lambda a, b: a & b, (df[c].eqNullSafe(F.col(f"_g{i}")) for i, c in enumerate(g)), F.lit(True))


def _by_digits(rows: DataFrame, g: list[str], n_cols: int, small_rows: int, n_state: int, max_state: int) -> DataFrame:
    """Medians ``_m0 .. `` of every group of ``rows`` (NULL groups included, columns without a
    value absent), digit by digit of the ordered bits."""
    cells = rows.select(*g, F.posexplode(F.array(*[f"_v{i}" for i in range(n_cols)])).alias("_c", "_v")).filter("_v IS NOT NULL")
    cells = cells.withColumn("_x", ordered_bits(F.col("_v")))
    shift = 64 - DIGITS[0]
    digit = F.shiftright("_x", shift).alias("_p")
    hist = cells.groupBy(*g, "_c", digit).agg(F.count(F.lit(1)).alias("_cnt"), F.max("_v").alias("_val"))
    # Both middle ranks, from the number of values that the first histogram gives.
    ranks = F.array(*[F.struct(F.lit(t).alias("_t"), F.floor((F.col("_n") - 1 + t) / 2).cast("long").alias("_k")) for t in (0, 1)])
    hist = hist.withColumn("_n", F.sum("_cnt").over(Window.partitionBy(*g, "_c")))
    hist = hist.withColumn("_tk", F.explode(ranks)).select(*g, "_c", "_tk._t", "_tk._k", F.lit(0).cast("long").alias("_below"), "_p", "_cnt", "_val")
    state = _chosen(hist, g).checkpoint()

    def inside() -> DataFrame:
        """Values with the digits known so far. The state has two rows per large group and
        column: broadcast behind a count, so the rows of a hot group are filtered where they
        are read, not shuffled."""
        known = bounded_broadcast(state.drop("_cnt", "_val"), max_rows=max_state, known_rows=n_state)
        known = _renamed(known, [*g, "_c"]).withColumnRenamed("_p", "_known")
        return cells.join(known, _same(cells, [*g, "_c"]) & (F.shiftright("_x", shift) == F.col("_known"))).select(*cells.columns, "_t", "_k", "_below")

    for bits in DIGITS[1:]:
        if state.filter(F.col("_cnt") > small_rows).isEmpty():
            break
        slices = inside()
        shift -= bits
        hist = slices.groupBy(*g, "_c", "_t", "_k", "_below", F.shiftright("_x", shift).alias("_p")).agg(
            F.count(F.lit(1)).alias("_cnt"), F.max("_v").alias("_val")
        )
        state = _chosen(hist, g).checkpoint()
    if shift:
        # Every slice is small: its values are sorted, and the rank read off.
        listed = inside().groupBy(*g, "_c", "_t", "_k", "_below").agg(F.sort_array(F.collect_list("_v")).alias("_vs"))
        state = listed.withColumn("_val", F.element_at("_vs", (F.col("_k") - F.col("_below") + 1).cast("int")))
    value = [F.max(F.when((F.col("_c") == i) & (F.col("_t") == t), F.col("_val"))) for i in range(n_cols) for t in (0, 1)]
    return state.groupBy(*g).agg(*[_midpoint(value[2 * i], value[2 * i + 1]).alias(f"_m{i}") for i in range(n_cols)])


def _chosen(hist: DataFrame, g: list[str]) -> DataFrame:
    """Of each rank's histogram (at most 1,024 rows) the slice that holds the rank."""
    w = Window.partitionBy(*g, "_c", "_t").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    hist = hist.withColumn("_below", (F.col("_below") + F.coalesce(F.sum("_cnt").over(w), F.lit(0))).cast("long"))
    return hist.filter((F.col("_below") <= F.col("_k")) & (F.col("_k") < F.col("_below") + F.col("_cnt")))
