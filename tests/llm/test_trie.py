"""The prefix trie against a plain rebuild in Python."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from lakelayer.llm import prefixtrie, queries
from lakelayer.llm.common import table

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string"


def plain(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 6
        rebuilt = tuple(own.get(c - c % 100, [])[:h]) + tuple(own[c][h:])
        for d in range(len(rebuilt) + 1):
            members[rebuilt[:d]].append(c)
        ends[rebuilt].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, convs in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(convs) - 1) * len(node[-1][1]) if node else 0
    return sorted(
        (convs[0], len(node), members[node[:-1]][0] if node else None, len(convs), children[node], leaves[node], saved[node],
         hashlib.sha256(",".join(map(str, ends[node])).encode()).hexdigest())
        for node, convs in members.items()
    )


def found(df):
    return sorted(tuple(r) for r in df.select(*COLUMNS).collect())


def of_rows(spark, rows, limit=prefixtrie.QUEUE_ROWS):
    df = spark.createDataFrame(rows, SCHEMA).withColumn("shard", F.lit("clash")).withColumn("depth", F.lit(7))
    c = F.col("conv_id")
    turns, convs = prefixtrie.rebuilt(prefixtrie.positions(df), c - c % 100, F.crc32(c.cast("string").cast("binary")) % 6, most=5)
    return prefixtrie.trie(turns, convs, limit)


def conversations(seed, n, turns, vocabulary):
    rng = random.Random(seed)
    rows = [(c, t, rng.choice(["user", "bot", None]), rng.choice(vocabulary)) for c in rng.sample(range(3 * n), n) for t in range(rng.randint(1, turns))]
    rng.shuffle(rows)
    return rows


def test_query_matches_plain_rebuild(spark):
    df = queries.op11_prefix_trie(spark, "/root/testdata/sf0.001")
    assert df.columns == COLUMNS
    rows = [tuple(r) for r in table(spark, "/root/testdata/sf0.001", "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert found(df) == plain(rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_many_shards_and_spilling_queues(spark, monkeypatch, seed):
    """Shared beginnings over many shards that are merged three at a time, queues that
    spill at once, conversations that cross partitions, and duplicates hashed in pieces."""
    monkeypatch.setattr(prefixtrie, "MERGED_SHARDS", 3)
    monkeypatch.setattr(prefixtrie, "PIECE_IDS", 3)
    rows = conversations(seed, 150, 9, ["a", "b", "ü", None, ""]) + [(1000, t, "user", f"long {t % 7}") for t in range(400)]
    rows += [(c, 0, "user", "same") for c in range(2000, 2060)]
    settings = {"spark.sql.shuffle.partitions": "23", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        got = found(of_rows(spark, rows, limit=2))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == plain(rows)


def test_odd_rows(spark):
    rows = [(None, 0, "user", "x"), (5, None, None, None), (5, None, None, None), (5, 0, "user", "a"), (6, 3, "user", "z"), (-250, 1, None, "neg"), (7, 1, "a", "b" * 100_000), (7, 1, "a", "a")]
    # The remainder of a negative id has its sign in Spark; Python's plain version is asked for ids from 0 up.
    positive = [r for r in rows if r[0] is None or r[0] >= 0]
    assert found(of_rows(spark, positive)) == plain(positive)
    assert of_rows(spark, rows).filter("depth = 0").first()["n_convs"] == 4
    assert found(of_rows(spark, [])) == []
    assert found(of_rows(spark, [(None, 1, "a", "b")])) == []


def test_level_queue_spills_and_adds_up():
    import numpy as np

    rng = np.random.default_rng(3)
    queue, plain_sums = prefixtrie.LevelQueue(limit=5), defaultdict(int)
    for _ in range(30):
        to, value = rng.integers(0, 20, 4), rng.integers(0, 9, 4)
        queue.push(2, np.column_stack([to, np.ones(4, np.int64), value]))
        for t, v in zip(to.tolist(), value.tolist()):
            plain_sums[t] += v
    taken = [queue.take(2, 9), queue.take(2)]
    assert {int(r[0]): int(r[2]) for part in taken for r in part} == plain_sums and queue.take(2) is None
