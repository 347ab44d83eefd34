"""Repeated passages against a plain table of all windows."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from lakelayer.llm import queries, substrings
from lakelayer.llm.common import table

COLUMNS = ["doc_id", "n_words", "n_removed", "kept_sha256"]


def plain(rows, size=35):
    words = [re.findall("[^\x20\x09-\x0d]+", t or "") for _, t in rows]
    seen = Counter(tuple(w[i:i + size]) for w in words for i in range(len(w) - size + 1))
    out = []
    for (doc_id, _), w in zip(rows, words):
        gone = set()
        for i in range(len(w) - size + 1):
            if seen[tuple(w[i:i + size])] > 1:
                gone.update(range(i, i + size))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc_id, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


def test_query_matches_plain(spark):
    df = queries.op13_repeated_passages(spark, "/root/testdata/sf0.001")
    assert df.columns == COLUMNS
    rows = [tuple(r) for r in table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text").collect()]
    expected = plain(rows)
    assert found(df) == expected and 0 < sum(r[2] > 0 for r in expected) < len(expected)


@pytest.mark.parametrize("seed,vocabulary,size", [(1, 2, 12), (2, 3, 35), (3, 40, 35), (4, 1, 5)])
def test_passages_runs_and_small_blocks(spark, monkeypatch, seed, vocabulary, size):
    """Passages shared across and inside documents, long runs of one word, periodic texts,
    and blocks of a few documents each."""
    monkeypatch.setattr(substrings, "BLOCK_BYTES", 1500)
    rng = random.Random(seed)

    def words(n):
        return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]

    passages = [words(rng.randint(size - 2, 3 * size)) for _ in range(6)] + [["a"] * (size + 5), ["a", "b"] * size, ["a"] * (size - 1)]
    rows = []
    for i in range(60):
        parts = [words(rng.randint(0, 2 * size)) if rng.random() < 0.6 else rng.choice(passages) for _ in range(rng.randint(0, 4))]
        rows.append((i, "\n".join(" ".join(p) for p in parts)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert found(substrings.remove_repeats(df, size)) == plain(rows, size)


def test_odd_rows(spark):
    long = " ".join(f"x{i % 1009}é" for i in range(60_000))
    rows = [(1, None), (1, None), (None, ""), (2, " \t\r\n\x0b\x0c "), (3, "  a b  c\x1cd \n" * 40), (None, long), (4, "same " * 34), (4, "same " * 34), (5, "one two " * 18), (6, "one two " * 18)]
    df = spark.createDataFrame([(*r, 1, "clash") for r in rows], "doc_id long, text string, block int, names string")
    assert found(substrings.remove_repeats(df, 35)) == plain(rows)
    assert found(substrings.remove_repeats(df.limit(0), 35)) == []
    short = rows[:4]
    assert found(substrings.remove_repeats(spark.createDataFrame(short, "doc_id long, text string"), 35)) == plain(short)


def test_equal_passages_get_equal_zone_names():
    """The zone of a window is named alike wherever the window stands."""
    rng = np.random.default_rng(7)
    passage = rng.integers(0, 50, 35).astype(np.uint64)
    seen = set()
    for _ in range(50):
        around = [rng.integers(0, 50, rng.integers(0, 30)).astype(np.uint64) for _ in range(2)]
        hashes = substrings._mixed(np.concatenate([around[0], passage, around[1]]) + np.uint64(1))
        names, starts, _, windows, first, last = substrings.recompressed(hashes, np.zeros(len(hashes), np.int64), 35)
        at = int(np.flatnonzero(windows == len(around[0]))[0])
        zone = slice(first[at], last[at])
        seen.add((tuple(names[zone].tolist()), tuple((starts[zone] - len(around[0])).tolist())))
    assert len(seen) == 1 and len(next(iter(seen))[0]) > 1
