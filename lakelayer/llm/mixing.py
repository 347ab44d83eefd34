"""Mixing sources to target weights by hierarchical budgets.

A tree of levels (domain, language, source) has a weight per node. The token
budget flows from the root: a node's budget is split among its children by weight,
but a child never gets more than its subtree holds (tokens times ``max_epochs``).
What a short child leaves goes to its siblings by weight; only what all siblings
together cannot use lowers the parent's share and so goes to the ancestors'
siblings. A leaf takes its budget as whole epochs plus a token-prefix of one more
epoch, in an order drawn from the seed and the epoch's number.

The split of a level is one window over the children (the order in which they run
short), so it is as large as the tree, not the table. A leaf's prefix is found from
a histogram over hash ranges, and only the range where the budget ends is ordered
row by row: a leaf with a third of all rows is never sorted as a whole.

Defined cases: null level values count as the empty string; null and empty texts
have no tokens and come with whatever prefix they fall in; null and repeated ids are
rows like others (equal rows are in a prefix together); weights of zero give nothing;
an empty table gives no rows; the caller's columns pass through whatever their names.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakelayer.llm.common import SPACES, staged

RANGES_BITS = 12


def word_tokens(text: Column) -> Column:
    """Words of the text, as a token count."""
    trimmed = F.btrim(F.coalesce(text.cast("string"), F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, SPACES + "+"))).cast("long")


def allocate(leaves: DataFrame, levels: Sequence[str], weights: Mapping[tuple, float], budget: float, max_epochs: float) -> DataFrame:
    """``leaves`` (the level columns and ``tokens``) with ``budget`` tokens each.

    ``weights`` maps paths from the root, as tuples, to weights; others weigh 1. A path
    (None, ..., name) holds for that name under every parent; a full path goes first."""
    spark = leaves.sparkSession
    leaves = leaves.withColumn("_cap", F.col("tokens") * F.lit(float(max_epochs)))

    def weighed(nodes: DataFrame, path: list[str]) -> DataFrame:
        """``nodes`` with the weight ``_w`` that ``weights`` gives the node at ``path``; those of weight zero go."""
        here = {p: float(w) for p, w in weights.items() if len(p) == len(path)}
        anywhere = [(p[-1], w) for p, w in here.items() if len(path) > 1 and not any(x is not None for x in p[:-1])]
        given = [(*p, w) for p, w in here.items() if all(x is not None for x in p)]
        if given:
            table = spark.createDataFrame(given, ", ".join(f"`{c}` string" for c in path) + ", _w double")
            nodes = nodes.join(F.broadcast(table), path, "left")
        else:
            nodes = nodes.withColumn("_w", F.lit(None).cast("double"))
        if anywhere:
            table = spark.createDataFrame(anywhere, f"`{path[-1]}` string, _any double")
            nodes = nodes.join(F.broadcast(table), path[-1], "left").withColumn("_w", F.coalesce("_w", "_any")).drop("_any")
        return nodes.withColumn("_w", F.coalesce("_w", F.lit(1.0))).filter("_w > 0")

    # What stands under a weight of zero is no capacity of the nodes above it.
    usable = leaves
    for depth in range(1, len(levels) + 1):
        usable = weighed(usable, list(levels[:depth])).drop("_w")
    parents = None
    for depth in range(1, len(levels) + 1):
        path, above = list(levels[:depth]), list(levels[:depth - 1])
        nodes = weighed(usable.groupBy(*path).agg(F.sum("_cap").alias("_cap")), path)
        nodes = nodes.join(parents, above) if above else nodes.withColumn("_budget", F.lit(float(budget)))
        order = Window.partitionBy(*above).orderBy(F.col("_cap") / F.col("_w"), path[-1])
        before, whole = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        left = F.col("_budget") - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))
        share = left / (F.sum("_w").over(whole) - F.coalesce(F.sum("_w").over(before), F.lit(0.0)))
        nodes = nodes.withColumn("_share", share).withColumn("_short", F.col("_cap") <= F.col("_share") * F.col("_w"))
        rate = F.first(F.when(~F.col("_short"), F.col("_share")), ignorenulls=True).over(whole)
        nodes = nodes.withColumn("_rate", rate)
        parents = nodes.select(*path, F.when(F.col("_rate").isNull(), F.col("_cap")).otherwise(F.least(F.col("_cap"), F.col("_rate") * F.col("_w"))).alias("_budget"))
        parents = staged(parents, "budgets")
    return leaves.join(parents, list(levels)).select(*levels, "tokens", F.floor(F.col("_budget") + 1e-6).alias("budget"))


def mix(docs: DataFrame, levels: Mapping[str, Column], weights: Mapping[tuple, float], budget: float | None = None, max_epochs: float = 4.0, seed: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Selected rows as (row, <levels>, tokens, epochs): ``row`` is the caller's row as a
    struct, ``epochs`` how often it is used (at least once). ``budget`` is in tokens,
    by default all that there are."""
    names = list(levels)
    columns = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.select(
        F.struct(*columns).alias("row"),
        *[F.coalesce(c.cast("string"), F.lit("")).alias(n) for n, c in levels.items()],
        word_tokens(F.col(f"`{text_col}`")).alias("tokens"),
        F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(-(2**63))).alias("_id"),
        F.xxhash64(F.col(f"`{text_col}`")).alias("_tie"),
    )
    small = staged(rows.drop("row"), "mix-rows")
    leaves = staged(small.groupBy(*names).agg(F.sum("tokens").alias("tokens")), "leaves")
    if budget is None:
        budget = leaves.agg(F.sum("tokens")).first()[0] or 0
    plan = allocate(leaves, names, weights, budget, max_epochs)
    epochs = F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens"))).otherwise(F.lit(0)).cast("long")
    plan = plan.withColumn("whole", epochs).withColumn("rest", F.col("budget") - F.col("whole") * F.col("tokens"))
    plan = staged(plan.drop("tokens", "budget"), "leaf-plan")

    def keyed(df: DataFrame) -> DataFrame:
        """Rows with their leaf's plan and their place in the order of the last epoch."""
        drawn = F.xxhash64(F.lit(seed), F.col("whole"), F.col("_id"), F.col("_tie"))
        return df.join(plan, names).withColumn("_h", drawn).withColumn("_range", F.shiftrightunsigned("_h", 64 - RANGES_BITS))

    ranges = staged(keyed(small).groupBy(*names, "rest", "_range").agg(F.sum("tokens").alias("n")), "leaf-ranges")
    upto = Window.partitionBy(*names).orderBy("_range")
    ends = ranges.withColumn("_upto", F.sum("n").over(upto)).filter("_upto > rest")
    ends = ends.groupBy(*names).agg(F.min_by(F.struct("_range", (F.col("_upto") - F.col("n")).alias("before")), "_range").alias("e")).select(*names, F.col("e._range").alias("_range"), "e.before")
    inside = keyed(small).join(ends, [*names, "_range"])
    place = F.struct("_h", "_id", "_tie")
    # The default frame takes equal rows together.
    inside = inside.withColumn("_upto", F.col("before") + F.sum("tokens").over(Window.partitionBy(*names, "_range").orderBy("_h", "_id", "_tie")))
    last = inside.filter("_upto <= rest").groupBy(*names).agg(F.max(place).alias("_last"))
    cuts = staged(ends.select(*names, F.col("_range").alias("_end")).join(last, names, "left"), "leaf-cuts")

    in_prefix = (F.col("_range") < F.col("_end")) | ((F.col("_range") == F.col("_end")) & F.coalesce(place <= F.col("_last"), F.lit(False)))
    chosen = keyed(rows).join(cuts, names, "left").withColumn("epochs", F.col("whole") + F.when(in_prefix, 1).otherwise(0))
    return chosen.filter("epochs > 0").select("row", *names, "tokens", F.col("epochs").cast("long").alias("epochs"))


def expand(chosen: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The caller's rows, repeated once per epoch."""
    repeated = chosen.select("row", F.explode(F.sequence(F.lit(1), F.col("epochs"))).alias("_epoch"))
    return repeated.select(*[F.col(f"row.`{c}`").alias(c) for c in columns])
