"""Packing of token ids into sequences: shortest-pack-first over the length histogram.

1. ``tokenise`` encodes every document and cuts it into pieces of at most
   ``capacity`` ids. Each piece gets its rank among the pieces of equal length
   that the same task made. No shuffle.
2. ``shortest_pack_first`` works on the histogram of lengths alone (at most
   ``capacity`` entries, whatever the input's size): longest lengths first, each
   piece goes to the open pack that is shortest so far. Equal packs are one
   pattern with a count, so the number of patterns is bounded by the histogram.
3. ``place`` turns patterns back into documents: a piece's rank among all pieces
   of its length is its task-local rank plus the prefix sum of the earlier tasks'
   counts, and ranks map to slots of the patterns. A frequent length is never
   gathered in one task.

Defined cases: a null or empty text is only the end id; null and repeated ids
are packed like others; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import heapq
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakelayer.llm.common import narrow, staged
from lakelayer.llm.pieces import encoder

CAPACITY = 2048
#: Fewer than the encoder's own: in a pipeline its workers also hold other stages' models.
CACHE_PIECES = 200_000
_RANKS = 2**44


def tokenise(docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """Pieces: doc_id, start, length, doc_tokens, ids_crc32 and ids (little-endian unsigned
    32-bit; left out where only lengths and digests are wanted), and the number ``part`` and
    local rank used by ``place``. Staged."""
    columns = ["doc_id", "start", "length", "doc_tokens", "ids_crc32", "part", "local_rank", *(["ids"] if with_ids else [])]
    types = {"ids": pa.binary()}

    def cut(batches):
        enc, part = encoder(tokenizer_path, CACHE_PIECES), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        end = np.asarray([end_id], "<u4").tobytes()
        for batch in batches:
            encoded = [enc.encode(text) + end for text in batch.column("text").to_pylist()]
            tokens = np.array([len(x) // 4 for x in encoded], np.int64)
            pieces = -(-tokens // capacity)
            doc = np.repeat(np.arange(len(tokens)), pieces)
            start = (np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * capacity
            length = np.minimum(capacity, tokens[doc] - start)
            # Rank of a piece among those of its length in this task.
            order = np.argsort(length, kind="stable")
            found = np.bincount(length, minlength=capacity + 1)
            rank = np.empty(len(length), np.int64)
            rank[order] = np.arange(len(length)) - np.repeat(np.cumsum(found) - found, found)
            rank += seen[length]
            seen += found
            ids = [memoryview(encoded[d])[4 * a:4 * (a + n)] for d, a, n in zip(doc.tolist(), start.tolist(), length.tolist())]
            out = [batch.column("doc_id").take(pa.array(doc)), start, length, tokens[doc], np.fromiter(map(crc32, ids), np.int64, len(ids)), np.full(len(doc), part), rank]
            out += [[bytes(x) for x in ids]] if with_ids else []
            yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x, types.get(c, pa.int64())) for c, x in zip(columns, out)], names=columns)

    schema = ", ".join(f"{c} {'binary' if c == 'ids' else 'long'}" for c in columns)
    return staged(narrow(docs, id_col, text_col).mapInArrow(cut, schema), "pieces", compression="zstd")


def shortest_pack_first(histogram: dict[int, int], capacity: int) -> list[tuple[int, tuple[tuple[int, int], ...]]]:
    """Patterns ``(count, ((length, times), ...))`` that hold every piece once.

    Lengths go in descending order. While an open pack has room, the pieces go
    one each to the packs with the most room; when none has room, new packs take
    as many of this length as fit."""
    room: dict[int, list] = {}
    widest: list[int] = []
    done = []

    def put(count, pattern, left):
        if not left:
            done.append((count, pattern))
            return
        if left not in room:
            room[left] = []
            heapq.heappush(widest, -left)
        room[left].append((count, pattern))

    for length in sorted(histogram, reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"length {length} does not fit a capacity of {capacity}")
        n = histogram[length]
        while n > 0:
            left = -widest[0] if widest else 0
            if left < length:
                each = capacity // length
                if n >= each:
                    put(n // each, ((length, each),), capacity - each * length)
                if n % each:
                    put(1, ((length, n % each),), capacity - (n % each) * length)
                break
            count, pattern = room[left].pop()
            if not room[left]:
                del room[left]
                heapq.heappop(widest)
            used = min(n, count)
            if count > used:
                put(count - used, pattern, left)
            last, times = pattern[-1]
            grown = (*pattern[:-1], (last, times + 1)) if last == length else (*pattern, (length, 1))
            put(used, grown, left - length)
            n -= used
    return done + [p for left in sorted(room) for p in room[left]]


def _slots(patterns) -> dict[str, np.ndarray]:
    """Per pattern and length: first rank, first sequence, times and first offset, sorted by (length, rank)."""
    taken: dict[int, int] = {}
    rows, sequence = [], 0
    for count, pattern in patterns:
        offset = 0
        for length, times in pattern:
            first = taken.get(length, 0)
            rows.append((length * _RANKS + first, sequence, times, offset, first))
            taken[length] = first + count * times
            offset += length * times
        sequence += count
    table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)
    return {k: table[:, i].copy() for i, k in enumerate(("key", "sequence", "times", "offset", "first"))}


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (length, part, local_rank and any other columns) with
    ``sequence_id`` and ``offset``. What the driver gets is the histogram, at most
    ``capacity`` rows, and the slots, a few per length of a pattern: neither grows with
    the input. The counts per task and length do (a row for each); they are joined to
    the pieces by a shuffle or a broadcast, as Spark decides by their size."""
    counts = staged(pieces.groupBy("part", "length").agg(F.count("*").alias("n")), "piece-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = pieces.sparkSession.sparkContext.broadcast(_slots(shortest_pack_first(histogram, capacity)))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_base"))
    keep = pieces.columns
    ranked = pieces.join(bases, ["part", "length"]).select(*keep, (F.col("_base") + F.col("local_rank")).alias("_rank"))

    def locate(batches):
        t = slots.value
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            rank = batch.column("_rank").to_numpy(zero_copy_only=False)
            i = np.searchsorted(t["key"], length * _RANKS + rank, "right") - 1
            nth = rank - t["first"][i]
            kept = [batch.column(c) for c in keep]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(t["sequence"][i] + nth // t["times"][i]), pa.array(t["offset"][i] + nth % t["times"][i] * length)],
                names=[*keep, "sequence_id", "offset"],
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema.fields if f.name != "_rank")
    return ranked.mapInArrow(locate, f"{fields}, sequence_id long, offset long")


def sequences(pieces: DataFrame, placed: DataFrame) -> DataFrame:
    """The packed sequences themselves: ``sequence_id``, ``ids`` (binary, pieces in
    order of offset) and ``doc_ids``. A group is one sequence, at most ``capacity`` ids."""
    key = ["part", "length", "local_rank"]
    rows = placed.select(*key, "doc_id", "sequence_id", "offset").join(pieces.select(*key, "ids"), key)
    in_order = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids")))
    return rows.groupBy("sequence_id").agg(in_order.alias("p")).select(
        "sequence_id", F.expr("aggregate(p, cast('' as binary), (a, x) -> a || x.ids)").alias("ids"), F.col("p.doc_id").alias("doc_ids")
    )
