"""Spelling variants against plain comparisons."""

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from lakelayer.llm import queries, spelling
from lakelayer.llm.common import table

COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def plain_vocabulary(rows):
    out = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", text or ""):
            word = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % 97 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1:]
            out[word] += 1
    return {w: n for w, n in out.items() if len(w) >= 5 and n >= 3}


def plain_near(words):
    """Near words through all strings with one code point left out or open."""
    by_gap, shorter = defaultdict(set), defaultdict(set)
    for w in words:
        for i in range(len(w)):
            by_gap[(i, w[:i] + "\0" + w[i + 1:])].add(w)
            shorter[w[:i] + w[i + 1:]].add(w)
    near = {w: set(shorter.get(w, ())) for w in words}
    for w in words:
        for i in range(len(w)):
            near[w] |= by_gap[(i, w[:i] + "\0" + w[i + 1:])]
            gone = w[:i] + w[i + 1:]
            if gone in words:
                near[w].add(gone)
        near[w].discard(w)
    return near


def plain_forms(vocab):
    near, form = plain_near(vocab), {}
    for w, n in vocab.items():
        best = min(near[w], key=lambda u: (-vocab[u], u), default=None)
        form[w] = best if best and vocab[best] >= 2 * n else None
    out = []
    for w, n in vocab.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), vocab[form[w]] if form[w] else None))
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


def test_query_matches_plain(spark):
    df = queries.op12_spelling_variants(spark, "/root/testdata/sf0.001")
    assert df.columns == COLUMNS
    rows = [tuple(r) for r in table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text").collect()]
    expected = plain_forms(plain_vocabulary(rows))
    assert found(df) == expected and sum(r[4] for r in expected) > 100


@pytest.mark.parametrize("letters,shard_words", [("ab", 7), ("abc", 50), ("aäöß", 20)])
def test_many_shards(spark, letters, shard_words):
    """Small alphabets: long runs of a letter, repeated letters at the border of the halves,
    words whose half reaches over several shards."""
    rng = random.Random(shard_words)
    vocab = {"".join(rng.choice(letters) for _ in range(rng.randint(5, 9))): rng.choice([3, 4, 7, 15, 40]) for _ in range(300)}
    df = spark.createDataFrame(list(vocab.items()), "word string, n long")
    assert found(spelling.forms(spelling.near_words(df, shard_words))) == plain_forms(vocab)


def test_odd_rows(spark):
    rows = [(1, None), (None, "Straße straße STRASSE strasse strasse"), (2, ""), (2, "straße × ÷aaaaa aaaaa AAAAA aaaa"), (2, "x" * 50_000), (2, "straße × ÷aaaaa aaaaa AAAAA aaaa")]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, word string, n int")
    vocab = spelling.vocabulary(df, 5, 3, spelling.misprints)
    assert {r["word"]: r["n"] for r in vocab.collect()} == plain_vocabulary(rows)
    assert found(spelling.forms(spelling.near_words(vocab))) == plain_forms(plain_vocabulary(rows))
    assert found(spelling.forms(spelling.near_words(spelling.vocabulary(df.limit(0), 5, 3, spelling.misprints)))) == []


def test_index_on_random_words():
    rng = random.Random(5)
    words = sorted({"".join(rng.choice("abcde") for _ in range(rng.randint(2, 8))) for _ in range(400)})
    index = spelling.VariantIndex(words)
    asked = words + ["zzzzz", "abzde"]
    pairs = set()
    for left in (True, False):
        who, word = index.near(asked, left)
        got = {(asked[i], index.words[j]) for i, j in zip(who.tolist(), word.tolist())}
        assert len(got) == len(who)
        pairs |= got
    near = plain_near(set(asked))
    assert pairs == {(w, u) for w in asked for u in near[w] if u in set(words)}


def test_very_long_words(spark):
    rng = random.Random(8)
    long = "".join(rng.choice("abé") for _ in range(3000))
    variants = [long, long[:700] + long[701:], long[:2500] + "z" + long[2500:], long[:1500] + "y" + long[1501:], "a" * 4000, "a" * 3999, "short", "shorts"]
    vocab = {w: n for w, n in zip(variants, (40, 3, 4, 5, 9, 3, 7, 30))}
    df = spark.createDataFrame(list(vocab.items()), "word string, n long")
    assert found(spelling.forms(spelling.near_words(df, 3))) == plain_forms(vocab)
