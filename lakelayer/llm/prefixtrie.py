"""Trie of conversation prefixes by time-forward processing.

1. ``positions`` orders the turns of every conversation and ``prefixes`` names each
   prefix by a 128-bit running XOR of names that contain the turn's place. Both work on
   range partitions: what a partition needs to know of the earlier ones is one row for
   each, so a conversation may be cut anywhere, however long.
2. A node is a distinct prefix; its key is (smallest member, depth). A parent's key is
   smaller than its children's, and the nodes are cut into shards by ranges of keys.
3. ``subtree_totals`` sorts a shard's nodes in reverse level order (Spark's external
   sort) and sends every node's totals to its parent through a priority queue by level
   whose runs spill to disk. What is meant for a node of another shard leaves the shard,
   added up per receiver. The receivers, linked to the receivers that they report to
   in turn, are a tree of their own: it is solved in the same way over merged shards,
   and its totals are handed to a last pass over the nodes.
4. The conversations that end at a node are hashed as a stream in numeric order; a node
   with very many is cut into pieces by range before that.

Defined cases: rows with a null conversation id are in no conversation; a null role or
text is empty; turns are ordered by turn (null first), then role, then text, and repeated
rows are repeated turns; an empty table has no nodes; other columns are not read.
"""

from __future__ import annotations

import hashlib
import tempfile
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakelayer.llm.common import staged

#: Messages a queue holds in memory before its runs go to disk.
QUEUE_ROWS = 2_000_000
#: Neighbouring shards that become one when the receivers between them are solved.
MERGED_SHARDS = 16
#: Ids hashed or handed on at a time.
PIECE_IDS = 10_000


def _longs(batch, *names: str) -> list[np.ndarray]:
    return [batch.column(n).to_numpy(zero_copy_only=False).astype(np.int64) for n in names]


def _segments(*keys: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal keys, and the end."""
    new = np.ones(len(keys[0]), bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return np.append(np.flatnonzero(new), len(keys[0]))


def _carried(rows: DataFrame, state: list[str], add) -> DataFrame:
    """``rows`` (part, conv_id, ``state`` ...) with ``_base_*`` columns: the state that
    the conversation which a part starts with had at the end of the part before. One
    row per part reaches the driver."""
    last = F.max(F.struct("conv_id", "local", *state))
    parts = sorted(rows.groupBy("part").agg(F.min("conv_id").alias("first"), last.alias("last")).collect())
    bases, before, carry = [], None, None
    for part, first, tail in parts:
        base = carry if first == before else None
        if base:
            bases.append((part, first, *base))
        values = [tail[s] for s in state]
        carry = [add(b, v) for b, v in zip(base, values)] if base and tail["conv_id"] == first else values
        before = tail["conv_id"]
    schema = "part int, conv_id long" + "".join(f", _base_{s} long" for s in state)
    return rows.join(F.broadcast(rows.sparkSession.createDataFrame(bases, schema)), ["part", "conv_id"], "left")


def positions(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos from 1, name, n_chars) of every turn."""

    def count(batches):
        part, conv, seen = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            (convs,) = _longs(batch, "conv_id")
            if not len(convs):
                continue
            cuts = _segments(convs)
            local = np.arange(1, len(convs) + 1) - np.repeat(cuts[:-1], np.diff(cuts))
            if convs[0] == conv:
                local[: cuts[1]] += seen
            conv, seen = convs[-1], int(local[-1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(convs), part, np.int32)), *(batch.column(c) for c in ("conv_id", "name", "n_chars")), pa.array(local)],
                names=["part", "conv_id", "name", "n_chars", "local"],
            )

    text = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")]
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", *text).filter("conv_id IS NOT NULL")
    rows = rows.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, 32)).sortWithinPartitions("conv_id", "turn", "role", "text")
    name = F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")))
    rows = rows.select("conv_id", name.alias("name"), F.length("text").cast("long").alias("n_chars"))
    rows = staged(rows.mapInArrow(count, "part int, conv_id long, name binary, n_chars long, local long"), "turns")
    pos = F.col("local") + F.coalesce(F.col("_base_local"), F.lit(0))
    return _carried(rows, ["local"], lambda a, b: a + b).select("conv_id", pos.alias("pos"), "name", "n_chars")


def rebuilt(turns: DataFrame, head_of: Column, borrowed: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Conversations that start with the first ``borrowed`` (at most ``most``) turns of
    the conversation ``head_of`` and go on with their own after as many.
    A lending conversation is its own head. Returns the turns (conv_id, depth, name,
    n_chars) and (conv_id, n_turns)."""
    lending = turns.filter(head_of == F.col("conv_id")).filter(F.col("pos") <= most)
    heads = lending.groupBy(F.col("conv_id").alias("_head")).agg(F.sort_array(F.collect_list(F.struct("pos", "name", "n_chars"))).alias("first"))
    own = turns.groupBy("conv_id").agg(F.max("pos").alias("n_own"))
    convs = own.join(heads, head_of == F.col("_head"), "left").withColumn("_h", borrowed)
    convs = convs.withColumn("_k", F.least("_h", F.coalesce(F.size("first"), F.lit(0))).cast("long"))
    lent = convs.filter("_k > 0").select("conv_id", F.explode(F.slice("first", 1, F.col("_k").cast("int"))).alias("t")).select("conv_id", F.col("t.pos").alias("depth"), "t.name", "t.n_chars")
    sizes = heads.select("_head", F.size("first").cast("long").alias("_size"))
    kept = turns.withColumn("_h", borrowed).filter("pos > _h").join(sizes, head_of == F.col("_head"), "left")
    depth = F.col("pos") - F.col("_h") + F.least("_h", F.coalesce("_size", F.lit(0)))
    return kept.select("conv_id", depth.alias("depth"), "name", "n_chars").union(lent), convs.select("conv_id", (F.col("_k") + F.greatest(F.col("n_own") - F.col("_h"), F.lit(0))).alias("n_turns"))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, n_chars, h1, h2, p1, p2): names of the prefix that ends with
    this turn and of the one before it. The empty prefix is named 0, 0."""

    def name(batches):
        part, conv, run = TaskContext.get().partitionId(), None, np.zeros(2, np.uint64)
        for batch in batches:
            convs, depth = _longs(batch, "conv_id", "depth")
            if not len(convs):
                continue
            raw = np.frombuffer(b"".join(batch.column("name").to_pylist()), "<u8").reshape(-1, 2)
            place = depth.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            tag = np.stack([_mixed(raw[:, 0] + place), _mixed(raw[:, 1] ^ _mixed(place))])
            cuts = _segments(convs)
            total = np.bitwise_xor.accumulate(tag, axis=1)
            start = np.concatenate([np.zeros((2, 1), np.uint64), total], axis=1)[:, cuts[:-1]]
            if convs[0] == conv:
                start[:, 0] ^= run
            total ^= np.repeat(start, np.diff(cuts), axis=1)
            conv, run = convs[-1], total[:, -1].copy()
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(convs), part, np.int32)), *(batch.column(c) for c in ("conv_id", "n_chars")), pa.array(depth), *(pa.array(x.view(np.int64)) for x in (*total, *tag))],
                names=["part", "conv_id", "n_chars", "local", "h1", "h2", "t1", "t2"],
            )

    rows = turns.repartitionByRange("conv_id", "depth").sortWithinPartitions("conv_id", "depth")
    rows = staged(rows.mapInArrow(name, "part int, conv_id long, n_chars long, local long, h1 long, h2 long, t1 long, t2 long"), "prefixes")
    rows = _carried(rows, ["h1", "h2"], lambda a, b: a ^ b)
    full = {h: F.col(h).bitwiseXOR(F.coalesce(F.col(f"_base_{h}"), F.lit(0))) for h in ("h1", "h2")}
    rows = rows.select("conv_id", F.col("local").alias("depth"), "n_chars", "t1", "t2", *(c.alias(h) for h, c in full.items()))
    return rows.select("conv_id", "depth", "n_chars", "h1", "h2", *(F.col(f"h{i}").bitwiseXOR(F.col(f"t{i}")).alias(f"p{i}") for i in (1, 2)))


_END = ["h1", "h2", "depth"]


def ends_digest(ends: DataFrame) -> DataFrame:
    """``ends`` (h1, h2, depth, conv_id) to one row per (h1, h2, depth): ``n_ends`` and
    the SHA-256 of the decimal ids in numeric order, comma-joined."""
    names = [*_END, "first", "n", "piece", "sha"]
    schema = "h1 long, h2 long, depth long, first long, n long, piece binary, sha string"
    fields = pa.schema([*((k, pa.int64()) for k in names[:5]), ("piece", pa.binary()), ("sha", pa.string())])

    def cut(batches):
        """Groups inside the partition are hashed; those at its two ends, which may go on
        in another partition, are handed on in pieces."""
        out: dict[str, list] = {k: [] for k in names}
        key, ids, inner, held = None, [], False, 0

        def flush(done: bool):
            nonlocal held
            if key is None or not ids:
                return
            text = ",".join(map(str, ids)).encode()
            for k, v in zip(names, (*key, ids[0], len(ids), None if done else text, hashlib.sha256(text).hexdigest() if done else None)):
                out[k].append(v)
            held += 0 if done else len(text)

        for batch in batches:
            cols = _longs(batch, *_END, "conv_id")
            if not batch.num_rows:
                continue
            cuts, convs = _segments(*cols[:3]).tolist(), cols[3].tolist()
            for a, b in zip(cuts, cuts[1:]):
                here = tuple(int(c[a]) for c in cols[:3])
                if here != key:
                    flush(done=inner)
                    inner = key is not None
                    key, ids = here, []
                ids = ids + convs[a:b]
                while len(ids) > PIECE_IDS:
                    rest, ids = ids[PIECE_IDS:], ids[:PIECE_IDS]
                    flush(done=False)
                    ids, inner = rest, False
            if held > 1_000_000 or len(out["n"]) >= PIECE_IDS:
                yield pa.RecordBatch.from_pydict(out, schema=fields)
                out, held = {k: [] for k in names}, 0
        flush(done=False)
        yield pa.RecordBatch.from_pydict(out, schema=fields)

    def join(batches):
        key, n, state = None, 0, None
        for batch in batches:
            rows: list[tuple] = []
            for *here, first, count, piece in zip(*(batch.column(c).to_pylist() for c in names[:6])):
                if here != key:
                    if state is not None:
                        rows.append((*key, n, state.hexdigest()))
                    key, n, state = here, 0, hashlib.sha256()
                state.update((b"," if n else b"") + piece)
                n += count
            yield _records(rows)
        if state is not None:
            yield _records([(*key, n, state.hexdigest())])

    def _records(rows):
        cols = list(zip(*rows)) if rows else [()] * 5
        return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols[:4]), pa.array(cols[4], pa.string())], names=[*_END, "n_ends", "ends_sha256"])

    rows = ends.select(*_END, "conv_id").repartitionByRange(*_END, "conv_id").sortWithinPartitions(*_END, "conv_id")
    rows = staged(rows.mapInArrow(cut, schema), "ends")
    whole = rows.filter("sha IS NOT NULL").select(*_END, F.col("n").alias("n_ends"), F.col("sha").alias("ends_sha256"))
    pieces = rows.filter("sha IS NULL").repartition(*_END).sortWithinPartitions(*_END, "first").select(*names[:6])
    return whole.union(pieces.mapInArrow(join, "h1 long, h2 long, depth long, n_ends long, ends_sha256 string"))


class LevelQueue:
    """Priority queue of messages by the receiver's level. A level holds sorted runs of
    (receiver, count, values ...), each with one row per receiver. Beyond ``limit`` rows in
    memory every level's runs are merged and moved to the task's own unnamed temporary
    file, which only this task reads and which ends with it."""

    def __init__(self, limit: int = QUEUE_ROWS):
        self.limit, self.held = limit, 0
        self.runs: dict[int, list[np.ndarray]] = {}

    @staticmethod
    def combined(rows: np.ndarray) -> np.ndarray:
        rows = rows[np.argsort(rows[:, 0], kind="stable")]
        if not len(rows):
            return rows
        cuts = _segments(rows[:, 0])[:-1]
        return np.column_stack([rows[cuts, 0], np.add.reduceat(rows[:, 1:], cuts, axis=0)])

    def push(self, level: int, rows: np.ndarray) -> None:
        run = self.combined(rows)
        self.runs.setdefault(level, []).append(run)
        self.held += len(run)
        if self.held > self.limit:
            self._spill()

    def _spill(self) -> None:
        for level, runs in self.runs.items():
            kept = [r for r in runs if isinstance(r, np.memmap)]
            fresh = [r for r in runs if not isinstance(r, np.memmap) and len(r)]
            if not fresh:
                continue
            merged = self.combined(np.concatenate(fresh))
            with tempfile.TemporaryFile() as file:
                merged.tofile(file)
                file.flush()
                self.runs[level] = [*kept, np.memmap(file, np.int64, "r", shape=merged.shape)]
        self.held = 0

    def take(self, level: int, upto: int | None = None) -> np.ndarray | None:
        """Messages to receivers up to ``upto`` (all if None), added up per receiver."""
        runs = self.runs.get(level)
        if not runs:
            return None
        cuts = [len(r) if upto is None else int(np.searchsorted(r[:, 0], upto, "right")) for r in runs]
        out = [np.asarray(r[:c]) for r, c in zip(runs, cuts) if c]
        self.held -= sum(c for r, c in zip(runs, cuts) if not isinstance(r, np.memmap))
        rest = [r[c:] for r, c in zip(runs, cuts) if c < len(r)]
        if rest:
            self.runs[level] = rest
        else:
            del self.runs[level]
        return self.combined(np.concatenate(out)) if out else None


def _forward(nodes: DataFrame, values: list[str], bounds: list[tuple], links: bool, limit: int) -> DataFrame:
    """One pass over every shard in reverse level order. With ``links`` the result is
    what leaves the shards (kind 0: added-up messages to a node of another shard; kind 1:
    for each path of a conversation in a shard, the node outside that it reports to);
    else the nodes with their totals in place of ``values`` and ``n_children``."""
    n_shards = len(bounds)
    keep = [c for c in nodes.columns if c not in (*values, "n_children")]
    link_names = ["kind", "shard", "conv_id", "depth", "n_children", *values]

    def outside(level: int, rows: np.ndarray) -> pa.RecordBatch:
        shard = np.array([bisect_right(bounds, (int(c), level)) - 1 for c in rows[:, 0]], np.int64)
        cols = [np.zeros(len(rows), np.int64), shard, rows[:, 0], np.full(len(rows), level), *rows[:, 1:].T]
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in cols], names=link_names)

    def exits(shard: int, heads: dict[int, tuple]) -> pa.RecordBatch:
        """Every path's node outside the shard, by pointer doubling over the paths inside."""
        convs = np.array(sorted(heads), np.int64)
        up = np.array([heads[c][1:] for c in convs.tolist()], np.int64).reshape(-1, 2)
        low = bounds[shard]
        inside = np.array([d >= 0 and (c, d) >= low for c, d in up.tolist()], bool)
        jump = np.where(inside, np.searchsorted(convs, up[:, 0]), np.arange(len(convs)))
        while True:
            further = jump[jump]
            if np.array_equal(further, jump):
                break
            jump = further
        top = up[jump]
        real = top[:, 1] >= 0
        pad = [np.zeros(int(real.sum()), np.int64)] * (len(values) - 1)
        cols = [np.ones(int(real.sum()), np.int64), np.full(int(real.sum()), shard), convs[real], top[real, 1], top[real, 0], np.zeros(int(real.sum()), np.int64), *pad]
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in cols], names=link_names)

    def up(batches):
        queue, shard, level, heads = LevelQueue(limit), None, None, {}

        def left(down_to: int | None):
            """Messages to levels that have passed: their receivers are in other shards."""
            for at in sorted((x for x in queue.runs if down_to is None or x > down_to), reverse=True):
                rows = queue.take(at)
                if rows is not None and links:
                    yield outside(at, rows)

        for batch in batches:
            shards, depth, conv, p_conv, p_depth = _longs(batch.select(["shard", "depth", "conv_id"]), "shard", "depth", "conv_id") + [
                batch.column(c).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("parent_conv_id", "parent_depth")
            ]
            total = np.column_stack(_longs(batch, "n_children", *values)) if batch.num_rows else np.zeros((0, 1 + len(values)), np.int64)
            cuts = _segments(shards, depth) if batch.num_rows else np.zeros(1, np.int64)
            for a, b in zip(cuts, cuts[1:]):
                if shards[a] != shard:
                    yield from left(None)
                    if links and shard is not None:
                        yield exits(shard, heads)
                    shard, level, heads = int(shards[a]), None, {}
                if depth[a] != level:
                    level = int(depth[a])
                    yield from left(level)
                got = queue.take(level, int(conv[b - 1]))
                if got is not None:
                    at = np.searchsorted(conv[a:b], got[:, 0])
                    here = conv[a:b][at] == got[:, 0]
                    total[a + at[here]] += got[here, 1:]
                    if links and not here.all():
                        yield outside(level, got[~here])
                send = p_depth[a:b] >= 0
                message = np.column_stack([p_conv[a:b], np.ones(b - a, np.int64), total[a:b, 1:]])[send]
                to = p_depth[a:b][send]
                for target in np.unique(to):
                    queue.push(int(target), message[to == target])
                if links:
                    # Levels descend, so what stays is the top of the path in this shard.
                    heads.update(zip(conv[a:b].tolist(), zip(depth[a:b].tolist(), p_conv[a:b].tolist(), p_depth[a:b].tolist())))
            if not links:
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *(pa.array(np.ascontiguousarray(t)) for t in total.T)], names=[*keep, "n_children", *values])
        yield from left(None)
        if links and shard is not None:
            yield exits(shard, heads)

    by_shard = nodes.repartition(n_shards, "shard") if n_shards > 1 else nodes.repartition(1)
    ordered = by_shard.sortWithinPartitions("shard", F.desc("depth"), "conv_id")
    longs = ", ".join(f"{c} long" for c in ["n_children", *values])
    if links:
        return ordered.mapInArrow(up, "kind long, shard long, conv_id long, depth long, " + longs)
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in nodes.schema.fields if f.name in keep)
    return ordered.mapInArrow(up, f"{kept}, {longs}")


def subtree_totals(nodes: DataFrame, values: list[str], bounds: list[tuple], limit: int = QUEUE_ROWS) -> DataFrame:
    """``nodes``: shard, conv_id, depth (together the key), parent_conv_id, parent_depth
    (null at the root; a parent's key is smaller and its depth lower), at least two long
    columns ``values``, and other columns that are kept. ``bounds``: the first key of
    every shard, in order. Returns the nodes with ``values`` added up over their
    subtrees and ``n_children``."""
    nodes = nodes.withColumn("n_children", F.lit(0).cast("long"))
    if len(bounds) > 1:
        slim = ["shard", "conv_id", "depth", "parent_conv_id", "parent_depth", "n_children", *values]
        out = staged(_forward(nodes.select(*slim), values, bounds, True, limit), "links")
        ports = out.filter("kind = 0").groupBy("shard", "conv_id", "depth").agg(*(F.sum(c).alias(c) for c in ("n_children", *values)))
        exits = out.filter("kind = 1").select("shard", "conv_id", F.col("n_children").alias("parent_conv_id"), F.col("depth").alias("parent_depth"))
        ports = staged(ports.join(exits, ["shard", "conv_id"], "left").withColumnRenamed("n_children", "_received"), "ports")
        merged = ports.withColumn("shard", F.floor(F.col("shard") / MERGED_SHARDS).cast("long"))
        got = staged(subtree_totals(merged, values, bounds[::MERGED_SHARDS], limit), "received")
        got = got.select("conv_id", "depth", F.col("_received").alias("_more"), *(F.col(v).alias(f"_more_{v}") for v in values))
        nodes = nodes.join(got, ["conv_id", "depth"], "left").withColumns(
            {"n_children": F.coalesce("_more", F.lit(0))} | {v: F.col(v) + F.coalesce(F.col(f"_more_{v}"), F.lit(0)) for v in values}
        ).drop("_more", *(f"_more_{v}" for v in values))
    return _forward(nodes, values, bounds, False, limit)


def trie(turns: DataFrame, convs: DataFrame, limit: int = QUEUE_ROWS) -> DataFrame:
    """``turns`` (conv_id, depth from 1, name, n_chars) and ``convs`` (conv_id, n_turns;
    also those without turns) to one row per node: conv_id, depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256, n_ends."""
    spark = turns.sparkSession
    rows = prefixes(turns)
    none = [F.lit(0).cast("long").alias(c) for c in ("h1", "h2")]
    bare = convs.filter("n_turns = 0").select(*none, F.lit(0).cast("long").alias("depth"), "conv_id")
    last = rows.groupBy("conv_id").agg(F.max(F.struct("depth", "h1", "h2")).alias("l")).select("l.h1", "l.h2", "l.depth", "conv_id")
    ends = ends_digest(last.union(bare))
    nodes = rows.groupBy(*_END).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("n_chars").alias("n_chars"), F.max("p1").alias("p1"), F.max("p2").alias("p2"))
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).filter("n_convs > 0")
    root = root.select(*none, F.lit(0).cast("long").alias("depth"), "conv_id", "n_convs", F.lit(0).cast("long").alias("n_chars"), F.lit(None).cast("long").alias("p1"), F.lit(None).cast("long").alias("p2"))
    nodes = staged(nodes.union(root).join(ends, _END, "left"), "trie-nodes")
    # A node's parent is found by the parent's name; the root's children need no join.
    top = nodes.filter("depth = 0").first()
    root_id = F.lit(top["conv_id"] if top else None).cast("long")
    parents = nodes.filter("depth > 0").select(F.col("conv_id").alias("_parent"), (F.col("depth") + 1).alias("depth"), F.col("h1").alias("p1"), F.col("h2").alias("p2"))
    inner = nodes.filter("depth > 1").join(parents, ["depth", "p1", "p2"])
    linked = inner.unionByName(nodes.filter("depth < 2").withColumn("_parent", F.when(F.col("depth") == 1, root_id)))
    tree = linked.select(
        "conv_id",
        "depth",
        F.col("_parent").alias("parent_conv_id"),
        F.when(F.col("depth") > 0, F.col("depth") - 1).alias("parent_depth"),
        "n_convs",
        F.coalesce("n_ends", F.lit(0)).alias("n_ends"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
        (F.coalesce("n_ends", F.lit(0)) == F.col("n_convs")).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("n_chars")).alias("saved_tokens"),
    )
    tree = tree.repartitionByRange("conv_id", "depth").withColumn("shard", F.spark_partition_id().cast("long"))
    tree = staged(tree, "trie")
    firsts = sorted((tuple(r["k"]), r["shard"]) for r in tree.groupBy("shard").agg(F.min(F.struct("conv_id", "depth")).alias("k")).collect())
    # Shards are numbered without gaps, in the order of their keys; one row each.
    number = spark.createDataFrame([(s, i) for i, (_, s) in enumerate(firsts)], "shard long, _number long")
    tree = tree.join(F.broadcast(number), "shard").drop("shard").withColumnRenamed("_number", "shard")
    bounds = [k for k, _ in firsts] or [(0, 0)]
    return subtree_totals(tree, ["n_leaves", "saved_tokens"], bounds, limit).drop("shard", "parent_depth")


#: The query's rows: conversations rebuilt with up to five turns of their hundred's head.
#: ``crc`` computes CRC-32 byte by byte from a table made by the polynomial.
ORACLE_SQL = r"""
WITH crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS t),
own AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT conv_id, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
                                  lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM own), crc),
turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, pos) AS depth, role, text FROM (
    SELECT c.conv_id, 0 AS part, pos, role, text FROM convs c JOIN own o ON o.conv_id = c.conv_id - c.conv_id % 100 AND pos <= h
    UNION ALL SELECT c.conv_id, 1, pos, role, text FROM convs c JOIN own o ON o.conv_id = c.conv_id AND pos > h)),
paths AS (
  SELECT conv_id, depth, length(text) AS chars,
         string_agg(length(role) || ':' || role || length(text) || ':' || text, '') OVER (PARTITION BY conv_id ORDER BY depth) AS path
  FROM turns UNION ALL SELECT conv_id, 0, 0, '' FROM convs),
placed AS (
  SELECT *, lag(path) OVER (PARTITION BY conv_id ORDER BY depth) AS above, depth = max(depth) OVER (PARTITION BY conv_id) AS is_end FROM paths),
nodes AS (
  SELECT depth, path, any_value(above) AS above, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) * (count(*) - 1) AS own, bool_and(is_end) AS leaf,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (is_end), '')) AS ends_sha256
  FROM placed GROUP BY depth, path),
sums AS (
  SELECT p.depth, p.path, sum(leaf::INT) AS n_leaves, sum(own) AS saved
  FROM nodes n JOIN paths p ON p.conv_id = n.conv_id AND p.depth <= n.depth GROUP BY p.depth, p.path),
children AS (SELECT depth - 1 AS depth, above AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0)::BIGINT AS n_children,
       s.n_leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n JOIN sums s ON s.depth = n.depth AND s.path = n.path
     LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.path = n.above LEFT JOIN children c ON c.depth = n.depth AND c.path = n.path
"""
