"""Spelling variants: words of a vocabulary that differ by one code point, found with
bidirectional FM-index search schemes, and the chains from rare to frequent forms.

1. ``vocabulary`` counts the words of whole texts; each task adds up its own before the
   shuffle.
2. A word near another one agrees with it in its left half (as a prefix) or in its right
   half (as a suffix), because the one error lies in the other half. The vocabulary is cut
   twice into shards of bounded size: by ranges of words and by ranges of reversed words.
   A word is asked in those shards of the first cut whose range can hold words with its left
   half as a prefix, and likewise in the second cut with its right half.
3. A shard's words, each between delimiters, are one text with a bidirectional FM-index
   (wavelet matrices of the text and of its reverse, suffix-rank intervals kept in both).
   The scheme matches one half with its delimiter exactly, then turns round and extends
   across the other half up to the other delimiter, allowing one error. All words of a
   batch are extended together. The second cut leaves out what agrees in the left half,
   as the first one has it: every pair is found once.
4. ``forms`` takes the most frequent near word of each word and follows the forms to the
   last by pointer doubling.

Defined cases: null and empty texts have no words; a null document id counts as empty in
``misprint``; words of one text and repeated rows all count; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, bisect_right
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakelayer.llm.common import narrow, staged

RUNS = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = {c: c + 32 for c in range(65, 91)}
#: Sorts after whatever may follow the letters of a half.
_LAST = "\U0010ffff"
#: Words of an index shard, and words searched together.
SHARD_WORDS = 40_000
BATCH_WORDS = 1024
#: Code points of a batch when all its words are as long as the longest (one word at least).
BATCH_POINTS = 100_000
#: Distinct words that a counting task holds before it hands them on.
HELD_WORDS = 200_000


def misprints(doc_id: int | None):
    """The words as they stand in one document: of its words one in 97 loses a code point."""
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())

    def of(word: str) -> str:
        h = zlib.crc32(word.encode(), start)
        if h % 97:
            return word
        at = h % len(word)
        return word[:at] + word[at + 1:]

    return of


def vocabulary(docs: DataFrame, min_length: int, min_count: int, variant=None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) of the lower-cased runs of letters, of at least ``min_length`` code points
    and ``min_count`` occurrences. ``variant(doc_id)`` gives a function that may change a
    word of that document before it is counted, but not make it longer."""

    def count(batches):
        held: Counter = Counter()

        def out():
            kept = [(w, n) for w, n in held.items() if len(w) >= min_length]
            return pa.RecordBatch.from_pydict({"word": [w for w, _ in kept], "n": [n for _, n in kept]}, schema=pa.schema([("word", pa.string()), ("n", pa.int64())]))

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                change = variant(doc_id) if variant else None
                lowered: Counter = Counter()
                for run, n in Counter(RUNS.findall(text or "")).items():
                    if len(run) >= min_length:
                        lowered[run if run.islower() else run.translate(_LOWER)] += n
                for word, n in lowered.items():
                    held[change(word) if change else word] += n
                if len(held) >= HELD_WORDS:
                    yield out()
                    held.clear()
        yield out()

    words = narrow(docs, id_col, text_col).mapInArrow(count, "word string, n long")
    return words.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


class _Wavelet:
    """Wavelet matrix over symbols below ``2 ** bits``: ranks and the distinct symbols
    of intervals, for many intervals at once."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.ranks, self.zeros, self.bits = [], [], bits
        for shift in range(bits - 1, -1, -1):
            one = (symbols >> shift) & 1
            rank = np.zeros(len(symbols) + 1, np.int32)
            np.cumsum(one, out=rank[1:])
            self.ranks.append(rank)
            self.zeros.append(len(symbols) - int(rank[-1]))
            symbols = np.concatenate([symbols[one == 0], symbols[one == 1]])
        self.first: dict[int, int] = {}
        for s, at in zip(*np.unique(symbols, return_index=True)):
            self.first[int(s)] = int(at)

    def children(self, lo, hi):
        """Per interval the symbols that occur in it, ascending: (interval's number, symbol,
        rank at lo, rank at hi), in order of number and symbol."""
        who, code = np.arange(len(lo)), np.zeros(len(lo), np.int64)
        for rank, zeros in zip(self.ranks, self.zeros):
            a, b = rank[lo].astype(np.int64), rank[hi].astype(np.int64)
            left, right = (lo - a, hi - b), (zeros + a, zeros + b)
            l_ok, r_ok = left[0] < left[1], right[0] < right[1]
            who = np.concatenate([who[l_ok], who[r_ok]])
            code = np.concatenate([code[l_ok] * 2, code[r_ok] * 2 + 1])
            lo = np.concatenate([left[0][l_ok], right[0][r_ok]])
            hi = np.concatenate([left[1][l_ok], right[1][r_ok]])
        order = np.lexsort((code, who))
        who, code, lo, hi = who[order], code[order], lo[order], hi[order]
        first = np.zeros(int(code.max()) + 1 if len(code) else 1, np.int64)
        for s, at in self.first.items():
            if s < len(first):
                first[s] = at
        return who, code, lo - first[code], hi - first[code]

    def child(self, lo, hi, symbol):
        """Per interval: ranks of its one ``symbol`` at both ends, and how many symbols in it are smaller."""
        smaller = np.zeros(len(lo), np.int64)
        start = np.zeros(len(lo), np.int64)
        for i, (rank, zeros) in enumerate(zip(self.ranks, self.zeros)):
            one = ((symbol >> (self.bits - 1 - i)) & 1).astype(bool)
            a, b, s = rank[lo].astype(np.int64), rank[hi].astype(np.int64), rank[start].astype(np.int64)
            smaller += np.where(one, (hi - lo) - (b - a), 0)
            lo, hi, start = np.where(one, zeros + a, lo - a), np.where(one, zeros + b, hi - b), np.where(one, zeros + s, start - s)
        return lo - start, hi - start, smaller


class VariantIndex:
    """Bidirectional FM-index of the text ``$w1$w2$...$`` over the distinct ``words``."""

    def __init__(self, words: list[str]):
        self.words = sorted(words)
        text = "\0" + "\0".join(self.words) + "\0"
        points = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.int64)
        self.alphabet = np.unique(points)
        symbols = np.searchsorted(self.alphabet, points)
        bits = max(1, int(len(self.alphabet) - 1).bit_length())
        self.before = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=len(self.alphabet)))])
        self.n = len(symbols)
        order = self._suffixes(symbols)
        self.back = _Wavelet(symbols[order - 1], bits)
        # Rows of a whole "$word$" are among those that start with the delimiter; the delimiters stand in the order of the words.
        n_delimiters = len(self.words) + 1
        starts = np.flatnonzero(symbols == 0)
        self.word_of_row = np.searchsorted(starts, order[:n_delimiters])
        backwards = symbols[::-1]
        self.forth = _Wavelet(backwards[self._suffixes(backwards) - 1], bits)

    @staticmethod
    def _suffixes(symbols: np.ndarray) -> np.ndarray:
        """Suffix array of the cyclic text by prefix doubling. All symbols being between
        delimiters, the ranks are distinct after a few words' length."""
        rank, n, step = symbols.astype(np.int64), len(symbols), 1
        while True:
            key = rank * (n + 1) + np.roll(rank, -step)
            order = np.argsort(key, kind="stable")
            sorted_key = key[order]
            fresh = np.concatenate([[0], np.cumsum(sorted_key[1:] != sorted_key[:-1])])
            rank = np.empty(n, np.int64)
            rank[order] = fresh
            step *= 2
            if fresh[-1] == n - 1 or step >= n:
                return order

    def codes(self, text: str) -> np.ndarray:
        """Symbols of a text; -1 where the shard has no such code point."""
        points = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.int64)
        at = np.minimum(np.searchsorted(self.alphabet, points), len(self.alphabet) - 1)
        return np.where(self.alphabet[at] == points, at, -1)

    def _step(self, state, symbol, forward: bool):
        """Intervals (lo, hi, other lo) extended by one symbol each, on the left
        (``forward`` False) or on the right; empty ones come out with hi <= lo."""
        lo, hi, other = state
        wavelet = self.forth if forward else self.back
        a, b, smaller = wavelet.child(lo, hi, symbol)
        return self.before[symbol] + a, self.before[symbol] + b, other + smaller

    def _turned(self, state):
        lo, hi, other = state
        return other, other + (hi - lo), lo

    def near(self, queries: list[str], left: bool) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (number of the query, number of the shard's word) at exactly one inserted,
        deleted or replaced code point which agree in the query's left half (its first
        half of code points; with ``left`` False: in the rest)."""
        found: list[tuple[np.ndarray, np.ndarray]] = []
        # Words of like length together: a very long one would make its whole batch wide.
        order, at = sorted(range(len(queries)), key=lambda i: len(queries[i])), 0
        while at < len(order):
            end = at + 1
            while end < len(order) and end - at < BATCH_WORDS and (end - at + 1) * len(queries[order[end]]) <= BATCH_POINTS:
                end += 1
            numbers = np.array(order[at:end])
            who, word = self._near([queries[i] for i in order[at:end]], left)
            found.append((numbers[who], word))
            at = end
        return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64))

    def _near(self, queries, left):
        coded = [self.codes(q) for q in queries]
        halves = [len(c) // 2 for c in coded]
        # Exact half with its delimiter, read towards that delimiter; then the rest and the other delimiter, read away from it.
        exact = [np.append(c[:h][::-1] if left else c[h:], 0) for c, h in zip(coded, halves)]
        rest = [np.append(c[h:] if left else c[:h][::-1], 0) for c, h in zip(coded, halves)]
        size = np.array([len(r) for r in rest])
        table = np.full((len(queries), int(size.max()) + 1), -1, np.int64)
        for i, r in enumerate(rest):
            table[i, : len(r)] = r
        who = np.arange(len(queries))
        state = (np.zeros(len(queries), np.int64), np.full(len(queries), self.n), np.zeros(len(queries), np.int64))
        for k in range(max(map(len, exact))):
            symbol = np.array([exact[i][k] if k < len(exact[i]) else -2 for i in who.tolist()])
            go = symbol >= 0
            done = symbol == -2
            stepped = self._step(tuple(x[go] for x in state), symbol[go], forward=not left)
            state = tuple(np.concatenate([x[done], y]) for x, y in zip(state, stepped))
            who = np.concatenate([who[done], who[go]])
            alive = state[0] < state[1]
            who, state = who[alive], tuple(x[alive] for x in state)
        lo, hi, other = self._turned(state)
        # Frontier of states: query, symbols of the rest consumed, error made, intervals.
        at, err = np.zeros(len(who), np.int64), np.zeros(len(who), bool)
        hits_who, hits_row = [], []
        side = self.forth if left else self.back
        while len(who):
            want = table[who, at]
            # One error: branch from states without one. The text's symbol is replaced (both
            # go on) or is one too many (the query waits); or the query's symbol is one too many.
            free = np.flatnonzero(~err)
            parent, symbol, a, b = side.children(lo[free], hi[free])
            origin = free[parent]
            count = b - a
            before = np.cumsum(count) - count
            first = np.searchsorted(parent, parent)
            smaller = before - before[first]
            c_state = (self.before[symbol] + a, self.before[symbol] + b, other[origin] + smaller)
            inner = symbol != 0
            differ = inner & (symbol != want[origin]) & (at[origin] < size[who[origin]] - 1)
            waits = inner
            skip = free[at[free] < size[who[free]] - 1]
            # Match of the wanted symbol, with or without an error before.
            known = np.flatnonzero(want >= 0)
            m_lo, m_hi, m_other = self._step((lo[known], hi[known], other[known]), want[known], forward=left)
            ok = m_lo < m_hi
            known, m_lo, m_hi, m_other = known[ok], m_lo[ok], m_hi[ok], m_other[ok]
            ended = at[known] == size[who[known]] - 1
            over = ended & err[known]
            rows = m_lo[over] if not left else m_other[over]
            hits_who.append(who[known][over])
            hits_row.append(rows)
            known, m_lo, m_hi, m_other = (x[~ended] for x in (known, m_lo, m_hi, m_other))
            one = np.ones
            parts = [
                (who[known], at[known] + 1, err[known], m_lo, m_hi, m_other),
                (who[origin][differ], at[origin][differ] + 1, one(differ.sum(), bool), *(x[differ] for x in c_state)),
                (who[origin][waits], at[origin][waits], one(waits.sum(), bool), *(x[waits] for x in c_state)),
                (who[skip], at[skip] + 1, one(len(skip), bool), lo[skip], hi[skip], other[skip]),
            ]
            who, at, err, lo, hi, other = (np.concatenate(x) for x in zip(*parts))
        w, r = np.concatenate(hits_who or [np.zeros(0, np.int64)]), np.concatenate(hits_row or [np.zeros(0, np.int64)])
        if not len(w):
            return w.astype(np.int64), r.astype(np.int64)
        # Several ways of making the same error lead to the same word.
        pairs = np.unique(w * len(self.words) + self.word_of_row[r])
        return pairs // len(self.words), pairs % len(self.words)


def _found(vocab: DataFrame, left: bool, n_shards: int) -> DataFrame:
    """Per word and shard of one cut: (word, n_near, best_n, best) of the near words that
    agree in the left half, or (``left`` False) in the right half but not in the left."""
    key = F.col("word") if left else F.reverse("word")
    cut = vocab.repartitionByRange(n_shards, key).select(F.spark_partition_id().alias("shard"), F.lit(0).alias("asks"), "word", "n")
    cut = staged(cut, "spelling-shards")
    # One row per shard reaches the driver.
    firsts = sorted((r["k"], r["shard"]) for r in cut.groupBy("shard").agg(F.min(key).alias("k")).collect())
    bounds, shards = [k for k, _ in firsts], [s for _, s in firsts]

    def route(batches):
        for batch in batches:
            out: dict[str, list] = {"shard": [], "asks": [], "word": [], "n": []}
            for word in batch.column("word").to_pylist():
                half = len(word) // 2
                known = word[:half] if left else word[half:][::-1]
                for i in range(max(0, bisect_right(bounds, known) - 1), bisect_left(bounds, known + _LAST)):
                    for k, v in zip(out, (shards[i], 1, word, 0)):
                        out[k].append(v)
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([("shard", pa.int32()), ("asks", pa.int32()), ("word", pa.string()), ("n", pa.int64())]))

    def search(batches):
        fields = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])
        shard, words, index, counts = None, {}, None, None
        for batch in batches:
            rows = {k: batch.column(k).to_pylist() for k in ("shard", "asks", "word", "n")}
            at, n_rows = 0, batch.num_rows
            while at < n_rows:
                end = at
                while end < n_rows and rows["shard"][end] == rows["shard"][at] and rows["asks"][end] == rows["asks"][at]:
                    end += 1
                if rows["shard"][at] != shard:
                    shard, words, index = rows["shard"][at], {}, None
                if not rows["asks"][at]:
                    words.update(zip(rows["word"][at:end], rows["n"][at:end]))
                elif words:
                    if index is None:
                        index = VariantIndex(list(words))
                        counts = np.array([words[w] for w in index.words])
                    yield best(index, counts, rows["word"][at:end], fields)
                at = end

    def best(index, counts, queries, fields):
        who, word = index.near(queries, left)
        if not left:
            new = np.array([not index.words[j].startswith(queries[i][: len(queries[i]) // 2]) for i, j in zip(who.tolist(), word.tolist())], bool)
            who, word = who[new], word[new]
        order = np.lexsort((word, -counts[word], who))
        who, word = who[order], word[order]
        asked, first, n_near = np.unique(who, return_index=True, return_counts=True)
        top = word[first]
        return pa.RecordBatch.from_pydict(
            {"word": [queries[i] for i in asked.tolist()], "n_near": n_near, "best_n": counts[top], "best": [index.words[j] for j in top.tolist()]}, schema=fields
        )

    asked = vocab.mapInArrow(route, "shard int, asks int, word string, n long")
    # By ranges: hashes of so few numbers would put several shards into one task.
    both = cut.union(asked).repartitionByRange(max(1, len(bounds)), "shard").sortWithinPartitions("shard", "asks")
    return both.mapInArrow(search, "word string, n_near long, best_n long, best string")


def near_words(vocab: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``vocab`` (word, n) with ``n_near`` and the most frequent near word (``best``; of
    equal ones the smallest) with its count. Words have at least two code points."""
    vocab = staged(vocab.select("word", "n"), "vocabulary")
    n_shards = max(1, -(-vocab.count() // shard_words))
    found = _found(vocab, True, n_shards).union(_found(vocab, False, n_shards))
    top = F.min(F.struct((-F.col("best_n")).alias("minus"), "best")).alias("top")
    found = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), top)
    return vocab.join(found, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.col("top.best").alias("best"), (-F.col("top.minus")).alias("best_n"))


def forms(found: DataFrame, times: int = 2) -> DataFrame:
    """word, form, root, n, n_near, form_n: a word's form is its most frequent near word if
    that occurs at least ``times`` (two or more) times as often; the root is the last form."""
    found = staged(found, "near-words")
    is_form = F.col("best_n") >= times * F.col("n")
    rows = found.select("word", F.when(is_form, F.col("best")).alias("form"), "n", "n_near", F.when(is_form, F.col("best_n")).alias("form_n"))
    up = rows.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    # Counts at least double along the forms: there are no circles, and a chain has at most
    # as many links as a count has bits, so the rounds of doubling are few.
    while True:
        up = staged(up, "roots")
        further = up.select(F.col("word").alias("_w"), F.col("root").alias("_r"))
        if up.join(further, F.col("root") == F.col("_w"), "left_semi").isEmpty():
            break
        up = up.join(further, F.col("root") == F.col("_w"), "left").select("word", F.coalesce("_r", "root").alias("root"))
    return rows.join(up, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


#: The query's rows, by strings with one code point left out instead of an index. ``crc``
#: computes CRC-32 byte by byte from a table made by the polynomial.
ORACLE_SQL = r"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS t),
runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents) WHERE length(run) >= 5 GROUP BY ALL),
hashed AS (
  SELECT w, n, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, length(x), 2),
           lambda i: (16 * (strpos('0123456789ABCDEF', substr(x, i + 1, 1)) - 1) + strpos('0123456789ABCDEF', substr(x, i + 2, 1)) - 1)::BIGINT)),
         lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) AS h
  FROM (SELECT w, n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || w)) AS x FROM runs), crc),
vocab AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word, sum(n)::BIGINT AS n
  FROM hashed GROUP BY 1 HAVING length(word) >= 5 AND sum(n) >= 3),
gaps AS (
  SELECT word, n, i, substr(word, 1, i - 1) AS a, substr(word, i + 1) AS b FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM vocab)),
near AS (
  SELECT x.word, y.word AS other FROM gaps x JOIN gaps y ON x.i = y.i AND x.a = y.a AND x.b = y.b AND x.word <> y.word
  UNION SELECT g.word, v.word FROM gaps g JOIN vocab v ON v.word = g.a || g.b
  UNION SELECT v.word, g.word FROM gaps g JOIN vocab v ON v.word = g.a || g.b),
best AS (
  SELECT near.word, count(*) AS n_near, arg_min(struct_pack(w := other, n := v.n), struct_pack(m := -v.n, w := other)) AS f
  FROM near JOIN vocab v ON v.word = other GROUP BY near.word),
forms AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN f.n >= 2 * v.n THEN f.w END AS form, CASE WHEN f.n >= 2 * v.n THEN f.n END AS form_n
  FROM vocab v LEFT JOIN best ON best.word = v.word),
chain(word, last) AS (SELECT word, word FROM forms UNION ALL SELECT chain.word, form FROM chain JOIN forms ON forms.word = chain.last WHERE form IS NOT NULL)
SELECT forms.word, forms.form, root.last AS root, forms.n, forms.n_near::BIGINT AS n_near, forms.form_n
FROM forms JOIN (SELECT chain.word, chain.last FROM chain JOIN forms f ON f.word = chain.last WHERE f.form IS NULL) root ON root.word = forms.word
"""
