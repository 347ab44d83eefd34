"""SimHash near duplicates by a byte-position inverted index with count filtering.

A fingerprint is eight positional bytes. Two fingerprints that differ in at most
``max_bits`` bits share at least ``8 - max_bits`` of them, so only pairs whose
tally of shared positional bytes reaches that number can link. Lists of single
bytes would hold a 256th of all fingerprints each and their pairs grow with the
square of the input; the index therefore intersects as many lists at a time as
the guaranteed minimum (70 combinations of 4 positions for 4 bits). A pair meets
in such a list exactly if its tally reaches the minimum. The tally and the bit
distance are then verified.

Exact copies share a fingerprint and enter the index once. A list of up to
``LIST_LIMIT`` fingerprints is compared inside its task in vector blocks and
yields a spanning forest of its verified links, so a list of m members yields
fewer than m links. Longer lists take another exact way whose cost is linear:
two fingerprints are within 2r bits exactly if some value lies within r bits of
both, so members are listed under every value within r bits and neighbours under
one value are verified. No list is cut.

A list holds at most one entry per fingerprint out of its 70, so one list has at
most a seventieth of the index whatever the size of a group of copies.

Defined cases: null and empty texts have fingerprint zero and link like others;
rows with a null id get the smallest id of their component (null if it has
none); repeated rows are kept; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakelayer.llm.common import narrow, staged
from lakelayer.llm.components import connected_components

SEED = 42
SHINGLE_WORDS = 4
MAX_BITS = 4
#: Above this length comparing a list costs more than listing its members' neighbourhoods.
LIST_LIMIT = 4096
_BLOCK = 65_536


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash over word shingles, repeats included; zero without words."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = (ends - [len(w) + 1 for w in words]).tolist()
    ends = (ends - 1).tolist()
    n = max(1, len(words) - shingle_words + 1)
    last = ends[min(shingle_words, len(words)) - 1:]
    ones = np.zeros(64, np.int64)
    for at in range(0, n, _BLOCK):
        to = min(at + _BLOCK, n)
        h = np.array([xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts[at:to], last[at:to])], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp) per row, over whole texts; staged."""

    def run(batches):
        for batch in batches:
            fps = [fingerprint(t, shingle_words) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fps, pa.int64())], names=["doc_id", "fp"])

    return staged(narrow(docs, id_col, text_col).mapInArrow(run, "doc_id long, fp long"), "fingerprints")


def hex_of(fp: str) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def _forest(members: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links of a spanning forest of the members within ``max_bits`` of each other."""
    links, rest = [], members
    while len(rest):
        front, rest = [rest[0]], rest[1:]
        while front and len(rest):
            x = front.pop()
            near = np.bitwise_count(rest ^ x) <= max_bits
            found = rest[near]
            links += [(int(x), int(y)) for y in found]
            front += list(found)
            rest = rest[~near]
    return links


def _linker(max_bits: int, limit: int, first_shared: np.ndarray | None):
    """Task function over rows (key, fp) sorted by both: links (a, b) of each run of
    equal keys; (a, a) for the members of a run beyond ``limit``."""

    def runs_to_links(key, fp):
        cut = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1], [True])))
        size = np.diff(cut)
        out = []
        two = cut[:-1][size == 2]
        if len(two):
            a, b = fp[two], fp[two + 1]
            ok = np.bitwise_count(a ^ b) <= max_bits
            if first_shared is not None:  # a pair counts in the first list that it shares
                shared = (a ^ b).view(np.uint8).reshape(-1, 8) == 0
                code = np.packbits(shared, axis=1, bitorder="little")[:, 0]
                ok &= first_shared[code] == key[two] >> 56
            out.append(np.stack([a[ok], b[ok]], 1))
        for i in np.flatnonzero(size > 2):
            links = _forest(fp[cut[i]:cut[i + 1]], max_bits)
            if links:
                out.append(np.array(links, np.uint64))
        return np.concatenate(out) if out else np.empty((0, 2), np.uint64)

    def batch_of(links):
        links = np.ascontiguousarray(links.astype(np.uint64))
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(links[:, i]).view(np.int64)) for i in (0, 1)], names=["a", "b"])

    def run(batches):
        key, fp, long_key = np.empty(0, np.uint64), np.empty(0, np.uint64), None
        for batch in batches:
            key = np.concatenate([key, batch.column("key").to_numpy(zero_copy_only=False).view(np.uint64)])
            fp = np.concatenate([fp, batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)])
            if not len(key):
                continue
            if long_key is not None:  # still in a run beyond the limit
                n = int(np.searchsorted(key != long_key, True)) if (key != long_key).any() else len(key)
                if n:
                    yield batch_of(np.stack([fp[:n], fp[:n]], 1))
                key, fp = key[n:], fp[n:]
                if not len(key):
                    continue
                long_key = None
            start = len(key) - int(np.argmax(key[::-1] != key[-1])) if (key != key[-1]).any() else 0
            sizes = np.diff(np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1], [True]))))
            if sizes.max() > limit:
                long_run = np.repeat(sizes > limit, sizes)
                yield batch_of(np.stack([fp[long_run], fp[long_run]], 1))
                if long_run[-1]:
                    long_key = key[-1]
                else:
                    long_run[start:] = False
                keep = ~long_run
                start = int(keep[:start].sum())
                key, fp = key[keep], fp[keep]
            links = runs_to_links(key[:start], fp[:start])
            if len(links):
                yield batch_of(links)
            key, fp = key[start:], fp[start:]
        links = runs_to_links(key, fp) if len(key) else ()
        if len(links):
            yield batch_of(links)

    return run


def _grouped(rows: DataFrame, run) -> DataFrame:
    return rows.repartition("key").sortWithinPartitions("key", "fp").mapInArrow(run, "a long, b long")


def links_between(fps: DataFrame, max_bits: int = MAX_BITS, limit: int = LIST_LIMIT) -> DataFrame:
    """Links (a, b) among distinct fingerprints (column fp) that connect exactly those
    connected by distances of at most ``max_bits`` (1 to 7)."""
    least = 8 - max_bits
    combos = list(combinations(range(8), least))
    first_shared = np.full(256, 255, np.uint64)
    for code in range(256):
        shared = tuple(p for p in range(8) if code >> p & 1)
        if len(shared) >= least:
            first_shared[code] = combos.index(shared[:least])

    def lists(batches):
        for batch in batches:
            fp = batch.column("fp").to_numpy(zero_copy_only=False).astype(np.int64)
            octets = fp.view(np.uint8).reshape(-1, 8).astype(np.uint64)
            for c, combo in enumerate(combos):
                key = np.full(len(fp), c << 56, np.uint64)
                for i, p in enumerate(combo):
                    key |= octets[:, p] << np.uint64(8 * i)
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(fp)], names=["key", "fp"])

    links = staged(_grouped(fps.select("fp").mapInArrow(lists, "key long, fp long"), _linker(max_bits, limit, first_shared)).distinct(), "near-links")
    members = links.filter("a = b").select(F.col("a").alias("fp")).distinct()
    if members.isEmpty():
        return links
    radius = (max_bits + 1) // 2
    flips = np.array([sum(1 << i for i in bits) for r in range(radius + 1) for bits in combinations(range(64), r)], np.uint64)

    def neighbourhood(batches):
        for batch in batches:
            fp = batch.column("fp").to_numpy(zero_copy_only=False).astype(np.int64)
            for at in range(0, len(fp), 256):
                some = fp[at:at + 256]
                near = (some.view(np.uint64)[:, None] ^ flips[None, :]).ravel()
                yield pa.RecordBatch.from_arrays([pa.array(near.view(np.int64)), pa.array(np.repeat(some, len(flips)))], names=["key", "fp"])

    # At most one member per flip stands under a value: the lists are short whatever the input.
    near = _grouped(members.mapInArrow(neighbourhood, "key long, fp long"), _linker(max_bits, len(flips), None)).distinct()
    return links.filter("a <> b").union(staged(near, "near-links"))


def near_duplicates(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp, component_id, root) per row: the smallest doc_id reachable over links,
    and the component's smallest fingerprint (which also names components without ids)."""
    rows = fingerprints(docs, shingle_words, id_col, text_col)
    classes = staged(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "fingerprint-classes")
    roots = connected_components(links_between(classes, max_bits))
    joined = staged(classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left"), "fingerprint-roots")
    linked = joined.filter("root IS NOT NULL")
    lowest = linked.groupBy("root").agg(F.min("first").alias("component_id"))
    alone = joined.filter("root IS NULL").select("fp", F.col("first").alias("component_id"), F.col("fp").alias("root"))
    components = linked.join(lowest, "root").select("fp", "component_id", "root").union(alone)
    return rows.join(staged(components, "fingerprint-components"), "fp").select("doc_id", "fp", "component_id", "root")


def keep_one(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest id (a row without
    id only where no member has one), of several rows with that id the one whose columns
    sort first. All columns pass through."""
    found = staged(near_duplicates(docs, shingle_words, max_bits, id_col, text_col), "near-duplicates")
    own = docs[id_col].cast("long")
    kept = found.filter("doc_id = component_id").select("doc_id").distinct()
    times = found.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("_id")).agg(F.count("*").alias("n"))
    ids = staged(times.join(kept, F.col("_id") == F.col("doc_id"), "left_semi"), "kept-ids")
    # One plan at every size: the ids grow with the input, so they are never broadcast,
    # and each task hashes its narrow ids instead of sorting whole texts.
    single = docs.join(ids.filter("n = 1").select("_id").hint("shuffle_hash"), own == F.col("_id"), "left_semi")
    several = ids.filter("n > 1").select("_id")
    unnamed = docs.filter(own.isNull())
    if several.isEmpty() and found.filter("doc_id IS NULL AND component_id IS NULL").isEmpty():
        return single

    # Repeated ids and rows without id: choose among the rows of a component. An id's
    # rows may be in several components, and count only where the id is the smallest.
    fp_of = F.pandas_udf(lambda texts: texts.map(lambda t: fingerprint(t, shingle_words)), "long")
    rows = docs.join(several.hint("shuffle_hash"), own == F.col("_id"), "left_semi").union(unnamed)
    rows = rows.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), fp_of(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))).alias("_fp"), F.col(f"`{id_col}`").cast("long").alias("_doc"))
    components = found.groupBy(F.col("fp").alias("_fp")).agg(F.min("component_id").alias("component_id"), F.min("root").alias("_root"))
    chosen = rows.join(components, "_fp").filter(F.col("_doc").eqNullSafe(F.col("component_id")))
    group = F.when(F.col("_doc").isNull(), F.col("_root"))
    one = chosen.groupBy("_doc", group.alias("_group")).agg(F.min("_row").alias("_row"))
    return single.union(one.select(*[F.col(f"_row.`{c}`").alias(c) for c in docs.columns]))
