"""Repeated passages found by recompression of the word sequences.

1. Documents are gathered into blocks of bounded size, each stored as one compressed row.
2. Recompression (Jez, "Recompression: a simple and powerful technique for word
   equations", 2013): every round names runs of one symbol, then pairs of a symbol of the
   left class and one of the right class. A name is a hash of what it stands for, and a
   symbol's class is a bit of its hash, so equal runs and pairs get equal names in all
   blocks without an exchange. What lies between the first and the last symbol that a
   passage touches is therefore named alike wherever the passage stands; the zone for which
   this holds is followed for every window through the rounds.
3. Reveal: a window can only occur twice if each pair of neighbouring high-level symbols of
   its zone does. A block sends its distinct pair names, dealt by name; what comes
   back is one bit per name: does another place have it? Windows with a name of their own
   drop out. Windows whose zone is too short for a pair (as in long runs) stay in.
4. Verify: of the windows that are left, blocks send the distinct 96-bit names of the whole
   windows in the same way. Windows whose name has another place are repeated.

A name goes out once per block, so a passage in a third of all documents is at most one
entry per block at its receiver. No pairs of documents are formed and nothing is capped.

Defined cases: null and empty texts have no words; a text shorter than a window is kept;
repeated rows and ids are documents of their own (their windows repeat each other); null
ids are kept; an empty table gives no rows; other columns are not read. A block is at
least one whole text, so memory grows with the longest text.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakelayer.llm.common import narrow, staged

#: Bytes of text in a block (a longer text is a block of its own).
BLOCK_BYTES = 2_000_000
#: Rounds of recompression before neighbouring symbols are compared. After three, a zone
#: has about half of a window of 35 words left and the symbols stand for 2.5 words each.
ROUNDS = 3
#: Rows of about a megabyte are read a few at a time.
_STORE = {"compression": "uncompressed", "parquet.block.size": 16 << 20}
#: Names that one receiving group should hold.
BUCKET_NAMES = 1_000_000
#: Words whose hashes a worker keeps.
HELD_WORDS = 300_000

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_OTHER = _U(0xD6E8FEB86659FD93)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, _U)
    out[:1] = 1
    return np.cumprod(out, dtype=_U)


def _inverse(base: np.uint64) -> np.uint64:
    return _U(pow(int(base), -1, 2**64))


def _windows(values: np.ndarray, base: np.uint64, size: int) -> np.ndarray:
    """Polynomial names (modulo 2^64) of all stretches of ``size`` values."""
    n = len(values)
    sums = np.concatenate([np.zeros(1, _U), np.cumsum(values * _powers(base, n), dtype=_U)])
    return (sums[size:] - sums[:-size]) * _powers(_inverse(base), n - size + 1)


# ------------------------------------------------------------------ blocks
_DOCS = pa.schema([("doc_id", pa.int64()), ("text", pa.binary()), ("open", pa.binary())])


def _packed(doc_ids: list, texts: list, open_windows: list) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, _DOCS, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(pa.RecordBatch.from_pydict({"doc_id": doc_ids, "text": texts, "open": open_windows}, schema=_DOCS))
    return sink.getvalue().to_pybytes()


def _unpacked(blob: bytes) -> pa.Table:
    return pa.ipc.open_stream(blob).read_all()


def blocks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(block, n_bytes, docs): documents in rows of about ``BLOCK_BYTES`` of text. Staged."""

    def gather(batches):
        part, made, ids, texts, held = TaskContext.get().partitionId(), 0, [], [], 0

        def row():
            return pa.RecordBatch.from_arrays(
                [pa.array([(part << 32) + made], pa.int64()), pa.array([held], pa.int64()), pa.array([_packed(ids, texts, [None] * len(ids))], pa.binary())],
                names=["block", "n_bytes", "docs"],
            )

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()):
                size = len(text or b"")
                if ids and held + size > BLOCK_BYTES:
                    yield row()
                    made, ids, texts, held = made + 1, [], [], 0
                ids.append(doc_id)
                texts.append(text)
                held += size + 16
        if ids:
            yield row()

    return staged(narrow(docs, id_col, text_col).mapInArrow(gather, "block long, n_bytes long, docs binary"), "blocks", **_STORE)


# ------------------------------------------------------------------ words of a block
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BYTE = _mixed(np.arange(1, 257, dtype=_U) * _U(0xA24BAED4963EE407))


def _word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and the number of the text that it is in."""
    joined = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    space = _SPACE[joined]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if len(joined) and not space[0]:
        edge = np.concatenate([[0], edge])
    starts, ends = edge[0::2], edge[1::2]
    sums = np.concatenate([np.zeros(1, _U), np.cumsum(_BYTE[joined] * _powers(_BASE, len(joined)), dtype=_U)])
    hashes = _mixed((sums[ends] - sums[starts]) * _powers(_inverse(_BASE), len(joined))[starts] + (ends - starts).astype(_U))
    text_ends = np.cumsum([len(t) + 1 for t in texts])
    return hashes, np.searchsorted(text_ends, starts, "right")


class _Hashes(dict):
    """128-bit hash of a word, kept for the words met last."""

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= HELD_WORDS:
            self.clear()
        self[word] = out = xxhash.xxh3_128_digest(word)
        return out


_HASHES = _Hashes()


# ------------------------------------------------------------------ recompression
def _cover(starts: np.ndarray, n: int) -> np.ndarray:
    """Number of the symbol that covers each word."""
    mark = np.zeros(n, np.int32)
    mark[starts] = 1
    return np.cumsum(mark, dtype=np.int32) - 1


def recompressed(hashes: np.ndarray, doc: np.ndarray, size: int, rounds: int = ROUNDS):
    """Symbols after ``rounds`` rounds over the words of several documents.

    Returns the symbols' names, first words and documents; the first words of all windows
    of ``size`` words; and the zone of each window as numbers of its first symbol and
    of the one after its last."""
    n = len(hashes)
    names, starts, docs = hashes, np.arange(n), doc
    windows = np.flatnonzero(doc[: n - size + 1] == doc[size - 1:]) if n >= size else np.zeros(0, np.int64)
    lo, hi = windows.copy(), windows + size

    def shrunk():
        """The zone without the symbols that hold its first and its last word: those may
        reach beyond it, and then differ between occurrences."""
        cover, ends, real = _cover(starts, n), np.append(starts[1:], n), lo < hi
        return np.where(real, ends[cover[np.minimum(lo, n - 1)]], lo), np.where(real, starts[cover[np.maximum(hi - 1, 0)]], lo)

    for r in range(1, rounds + 1):
        # Runs.
        fresh = np.ones(len(names), bool)
        fresh[1:] = (names[1:] != names[:-1]) | (docs[1:] != docs[:-1])
        at = np.flatnonzero(fresh)
        length = np.diff(np.append(at, len(names))).astype(_U)
        names = np.where(length > 1, _mixed(names[at] + length * _BASE + _U(2 * r)), names[at])
        starts, docs = starts[at], docs[at]
        lo, hi = shrunk()
        # Pairs.
        left = (_mixed(names + _U(r * int(_OTHER) % 2**64)) & _U(1)).astype(bool)
        pair = np.zeros(len(names), bool)
        pair[:-1] = left[:-1] & ~left[1:] & (docs[1:] == docs[:-1])
        first = np.flatnonzero(pair)
        names = names.copy()
        names[first] = _joined(names[first], names[first + 1])
        kept = np.ones(len(names), bool)
        kept[first + 1] = False
        names, starts, docs = names[kept], starts[kept], docs[kept]
        lo, hi = shrunk()
    # Zones begin and end at symbols; empty ones have no symbol.
    cover = np.append(_cover(starts, n), len(starts))
    first, last = cover[np.minimum(lo, n)], cover[np.minimum(hi, n)]
    return names, starts, docs, windows, first, np.maximum(first, last)


def _joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return _mixed(a * _U(3) + _mixed(b + _BASE))


def _pairs(names: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """48-bit names of neighbouring symbols of a document, and which symbols have one."""
    if len(names) < 2:
        return np.zeros(0, _U), np.zeros(len(names), bool)
    has = np.append(docs[1:] == docs[:-1], False)
    at = np.flatnonzero(has)
    return _joined(names[at], names[at + 1]) >> _U(16), has


# ------------------------------------------------------------------ asking other blocks
_VERIFY = np.dtype([("a", "<u8"), ("b", "<u4")])


def _order(names: np.ndarray) -> np.ndarray:
    return np.lexsort((names["b"], names["a"])) if names.dtype.names else np.argsort(names, kind="stable")


def _distinct(names: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct names, for each name its number among them, and their counts."""
    order = _order(names)
    ordered = names[order]
    fresh = np.ones(len(names), bool)
    fresh[1:] = ordered[1:] != ordered[:-1]
    which = np.empty(len(names), np.int64)
    which[order] = np.cumsum(fresh) - 1
    at = np.flatnonzero(fresh)
    return ordered[at], which, np.diff(np.append(at, len(names)))


def _dealt(distinct: np.ndarray, n_buckets: int) -> list[np.ndarray]:
    """Numbers of the distinct names of each bucket, in order; the low bits choose the bucket."""
    key = distinct["a"] if distinct.dtype.names else distinct
    bucket = (key % _U(n_buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    return np.split(order, np.searchsorted(bucket[order], np.arange(1, n_buckets)))


def _bytes_of(names: np.ndarray) -> bytes:
    """48-bit names take six bytes each, 96-bit names twelve."""
    if names.dtype.names:
        return names.tobytes()
    return names.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _names_of(data: bytes, wide: bool) -> np.ndarray:
    if wide:
        return np.frombuffer(data, _VERIFY)
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.reshape(-1).view("<u8")


def _asked(df: DataFrame, names_of_block, n_buckets: int) -> DataFrame:
    """``df`` (block, docs) to (block, bucket, names): the distinct names of a block by bucket."""

    def ask(batches):
        for batch in batches:
            for block, blob in zip(batch.column("block").to_pylist(), batch.column("docs").to_pylist()):
                distinct = _distinct(names_of_block(_unpacked(blob)))[0]
                rows = [(i, _bytes_of(distinct[x])) for i, x in enumerate(_dealt(distinct, n_buckets)) if len(x)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block] * len(rows), pa.int64()), pa.array([i for i, _ in rows], pa.int64()), pa.array([x for _, x in rows], pa.binary())],
                    names=["block", "bucket", "names"],
                )

    return df.select("block", "docs").mapInArrow(ask, "block long, bucket long, names binary")


def _answered(asked: DataFrame, wide: bool) -> DataFrame:
    """(block, bucket, bits): for each name that a block sent, whether another block sent it too."""

    def answer(group: pa.Table) -> pa.Table:
        lists = [_names_of(x, wide) for x in group.column("names").to_pylist()]
        every = np.concatenate(lists)
        order = _order(every)
        ordered = every[order]
        same = ordered[1:] == ordered[:-1]
        twice = np.zeros(len(every), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        bits = [np.packbits(x).tobytes() for x in np.split(twice, np.cumsum([len(x) for x in lists])[:-1])]
        return pa.table({"block": group.column("block"), "bucket": group.column("bucket"), "bits": pa.array(bits, pa.binary())})

    return asked.groupBy("bucket").applyInArrow(answer, "block long, bucket long, bits binary")


def _elsewhere(names: np.ndarray, answers: pa.Table, n_buckets: int) -> np.ndarray:
    """Of a block's names (repeats included): is there another place with it, here or in another block?"""
    distinct, which, count = _distinct(names)
    repeated = count > 1
    bits = dict(zip(answers.column("bucket").to_pylist(), answers.column("bits").to_pylist()))
    for i, part in enumerate(_dealt(distinct, n_buckets)):
        if len(part):
            repeated[part] |= np.unpackbits(np.frombuffer(bits[i], np.uint8), count=len(part)).astype(bool)
    return repeated[which]


# ------------------------------------------------------------------ the two stages
def _hashed(table: pa.Table) -> tuple[list, list, np.ndarray, np.ndarray]:
    texts = [t or b"" for t in table.column("text").to_pylist()]
    return table.column("doc_id").to_pylist(), texts, *_word_hashes(texts)


def _reveal_names(table: pa.Table, size: int) -> np.ndarray:
    _, _, hashes, doc = _hashed(table)
    names, _, docs, *_ = recompressed(hashes, doc, size)
    return _pairs(names, docs)[0]


_RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def _kept(doc_id, words: list[bytes], removed: np.ndarray | None) -> tuple:
    n = len(words)
    kept = words if removed is None else [w for w, r in zip(words, removed.tolist()) if not r]
    return doc_id, n, n - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()


def _result_columns(rows: list[tuple]) -> list[pa.Array]:
    cols = list(zip(*rows)) if rows else [()] * 4
    return [*(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.string())]


def _opened(rows: DataFrame, answers: DataFrame, size: int, n_buckets: int) -> DataFrame:
    """Results of the documents without a window that may be repeated, and the other
    documents (``docs``) with those windows marked."""

    def mark(left: pa.Table, right: pa.Table) -> pa.Table:
        out, blocks_of, blobs = [], [], []
        for block, blob in zip(left.column("block").to_pylist(), left.column("docs").to_pylist()):
            ids, texts, hashes, doc = _hashed(_unpacked(blob))
            names, _, docs, windows, first, last = recompressed(hashes, doc, size)
            pairs, has = _pairs(names, docs)
            own = np.zeros(len(names) + 1, np.int64)
            own[1:][has] = ~_elsewhere(pairs, right, n_buckets)
            own = np.cumsum(own)
            # A zone of k symbols holds the k - 1 pairs that start with all but its last one.
            until = np.maximum(last - 1, first)
            window_open = np.zeros(len(hashes), bool)
            window_open[windows[own[until] == own[first]]] = True
            bounds = np.searchsorted(doc, np.arange(len(ids) + 1))
            rest: tuple[list, list, list] = ([], [], [])
            for i, (doc_id, text) in enumerate(zip(ids, texts)):
                marks = window_open[bounds[i]:bounds[i + 1]]
                if marks.any():
                    for to, x in zip(rest, (doc_id, text, np.packbits(marks).tobytes())):
                        to.append(x)
                else:
                    out.append(_kept(doc_id, text.split(), None))
            if rest[0]:
                blocks_of.append(block)
                blobs.append(_packed(*rest))
        n, k = len(out), len(blobs)
        cols = [pa.concat_arrays([c, pa.nulls(k, c.type)]) for c in _result_columns(out)]
        return pa.Table.from_arrays(
            [*cols, pa.array([None] * n + blocks_of, pa.int64()), pa.array([None] * n + blobs, pa.binary())],
            names=["doc_id", "n_words", "n_removed", "kept_sha256", "block", "docs"],
        )

    both = rows.select("block", "docs").groupBy("block").cogroup(answers.groupBy("block"))
    return both.applyInArrow(mark, f"{_RESULT}, block long, docs binary")


def _window_names(words: list[bytes], marks: bytes, size: int) -> tuple[np.ndarray, np.ndarray]:
    """First words and 96-bit names of the marked windows of one text."""
    halves = np.frombuffer(b"".join(map(_HASHES.__getitem__, words)), "<u8").reshape(-1, 2)
    at = np.flatnonzero(np.unpackbits(np.frombuffer(marks, np.uint8), count=len(words)))
    out = np.zeros(len(at), _VERIFY)
    out["a"] = _mixed(_windows(halves[:, 0], _BASE, size)[at])
    out["b"] = _mixed(_windows(halves[:, 1], _OTHER, size)[at]) >> _U(32)
    return at, out


def _verify_names(table: pa.Table, size: int) -> np.ndarray:
    return np.concatenate([_window_names(t.split(), m, size)[1] for t, m in zip(table.column("text").to_pylist(), table.column("open").to_pylist())])


def _closed(rows: DataFrame, answers: DataFrame, size: int, n_buckets: int) -> DataFrame:
    """Results of the documents with marked windows."""

    def remove(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for blob in left.column("docs").to_pylist():
            table = _unpacked(blob)
            words = [t.split() for t in table.column("text").to_pylist()]
            named = [_window_names(w, m, size) for w, m in zip(words, table.column("open").to_pylist())]
            repeated = _elsewhere(np.concatenate([x for _, x in named]), right, n_buckets)
            parts = np.split(repeated, np.cumsum([len(at) for at, _ in named])[:-1])
            for doc_id, w, (at, _), found in zip(table.column("doc_id").to_pylist(), words, named, parts):
                edges = np.zeros(len(w) + 1, np.int64)
                np.add.at(edges, at[found], 1)
                np.add.at(edges, at[found] + size, -1)
                out.append(_kept(doc_id, w, np.cumsum(edges)[:-1] > 0))
        return pa.Table.from_arrays(_result_columns(out), names=["doc_id", "n_words", "n_removed", "kept_sha256"])

    both = rows.select("block", "docs").groupBy("block").cogroup(answers.groupBy("block"))
    return both.applyInArrow(remove, _RESULT)


def remove_repeats(docs: DataFrame, size: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents without the words of windows of ``size`` consecutive words that start
    anywhere else too. Returns doc_id, n_words, n_removed and kept_sha256 (of the kept words
    joined by one space)."""
    stored = blocks(docs, id_col, text_col)
    # One name for 2.5 words of some six bytes, as measured; only the groups' size depends on it.
    n_bytes = stored.agg(F.sum("n_bytes")).first()[0] or 0
    n_buckets = max(16, n_bytes // (15 * BUCKET_NAMES))
    answers = _answered(_asked(stored, lambda t: _reveal_names(t, size), n_buckets), wide=False)
    marked = staged(_opened(stored, answers, size, n_buckets), "marked", **_STORE)
    results = marked.filter("docs IS NULL").select("doc_id", "n_words", "n_removed", "kept_sha256")
    rest = marked.filter("docs IS NOT NULL")
    answers = _answered(_asked(rest, lambda t: _verify_names(t, size), n_buckets), wide=True)
    return results.union(_closed(rest, answers, size, n_buckets))


#: The query's rows, by the texts of all windows.
ORACLE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (SELECT r, i, array_to_string(w[i:i + 34], ' ') AS words FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM d)),
repeated AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY words) AS n FROM windows) WHERE n > 1),
gone AS (SELECT DISTINCT r, unnest(range(i, i + 35)) AS p FROM repeated),
kept AS (
  SELECT r, string_agg(word, ' ' ORDER BY p) AS words, count(*) AS n
  FROM (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d) ANTI JOIN gone USING (r, p) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(words, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""
