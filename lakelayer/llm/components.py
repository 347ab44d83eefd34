"""Connected components of a graph held as a DataFrame of links.

Alternating large-star and small-star steps (Kiveris et al., "Connected
components in MapReduce and beyond", 2014): each step replaces a node's links by
links to the smallest neighbour, so every component becomes a star around its
smallest node in a logarithmic number of rounds. Each round is written to the
shared folder; no links or components reach the driver, only a count and a
checksum per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakelayer.llm.common import staged


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def connected_components(links: DataFrame) -> DataFrame:
    """``links`` (a, b; either order, repeats and self links allowed) to
    (node, root): root is the smallest node reachable. A node without a link to
    another node does not appear; no links give no rows."""
    pairs = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    pairs = staged(pairs, "links")
    state = _state(pairs)
    while state[0]:
        # Large star: every larger neighbour of a node is linked to the node's smallest neighbour.
        both = pairs.union(pairs.select("b", "a")).toDF("u", "v")
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        # Small star: a node and its smaller neighbours are linked to the smallest of them.
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", "m"))
        pairs = staged(small.distinct(), "links")
        before, state = state, _state(pairs)
        if state == before:
            break
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("root")).union(pairs.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
