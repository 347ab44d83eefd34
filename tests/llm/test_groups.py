"""SimHash near duplicates, search, mixing and the pipeline against brute force."""

import collections
import math
import random
import re
from pathlib import Path

import numpy as np
import pyarrow.parquet as pq
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from lakelayer.llm import mixing, queries, search, simhash

SF = "/root/testdata/sf0.001"


# ------------------------------------------------------------------ SimHash
def plain_fingerprint(text, n=4):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps, max_bits=4):
    """Smallest index reachable, over all pairs."""
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= max_bits:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(fps))]


def test_op7_against_all_pairs(spark):
    got = {r.doc_id: r for r in queries.op7_simhash_near_duplicates(spark, SF).collect()}
    texts = dict(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    ids = sorted(texts)
    fps = [plain_fingerprint(texts[i]) for i in ids]
    assert [got[i].fingerprint for i in ids] == [f"{fp:016x}" for fp in fps]
    assert [got[i].component_id for i in ids] == [ids[r] for r in plain_components(fps)]


def signed(x):
    return x - 2**64 if x >= 2**63 else x


@pytest.mark.parametrize("limit", [simhash.LIST_LIMIT, 3])
@pytest.mark.parametrize("max_bits", [3, 4])
def test_links_connect_what_all_pairs_connect(spark, limit, max_bits):
    rng = random.Random(limit + max_bits)
    fps = {0, 2**64 - 1}
    for _ in range(12):  # clouds around centres, chains, lone values
        at = rng.getrandbits(64)
        for _ in range(25):
            x = at
            for b in rng.sample(range(64), rng.randint(0, 5)):
                x ^= 1 << b
            fps.add(x)
            at = x if rng.random() < 0.2 else at
    fps |= {rng.getrandbits(64) for _ in range(60)}
    fps = sorted(fps)
    df = spark.createDataFrame([(signed(x),) for x in fps], "fp long")
    links = simhash.links_between(df, max_bits, limit).collect()
    number = {signed(x): i for i, x in enumerate(fps)}
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for r in links:
        assert ((r.a ^ r.b) & (2**64 - 1)).bit_count() <= max_bits
        a, b = sorted((find(number[r.a]), find(number[r.b])))
        root[b] = a
    assert [find(i) for i in range(len(fps))] == plain_components(fps, max_bits)


ODD = [(4, "Same text here again today"), (2, "same TEXT here again today"), (None, "same text here again today"), (7, None), (5, ""), (9, "one"), (9, "one"), (None, "alone no id"), (11, "word " * 20_000), (12, "x y z"), (12, "other words under one id altogether")]


def test_near_duplicates_odd_rows(spark):
    df = spark.createDataFrame([(*r, "a", 1) for r in ODD], "doc_id long, text string, fp string, component_id int")
    got = sorted(simhash.near_duplicates(df).select("doc_id", "component_id").collect(), key=str)
    assert sorted((r.doc_id, r.component_id) for r in got if r.doc_id is not None) == [(2, 2), (4, 2), (5, 5), (7, 5), (9, 9), (9, 9), (11, 11), (12, 12), (12, 12)]
    assert sorted(str(r.component_id) for r in got if r.doc_id is None) == ["2", "None"]
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == ["11", "12", "2", "5", "9", "None"]  # one row of an id
    assert simhash.keep_one(df.limit(0)).count() == 0


def test_keep_one_with_repeated_and_missing_ids(spark):
    base = " ".join(f"word{i}" for i in range(300))
    near = base + " end"
    other = " ".join(f"other{i}" for i in range(300))
    assert simhash.fingerprint(base, 4) != simhash.fingerprint(other, 4)
    keep = lambda rows: sorted((r.doc_id or -1, r.text[:6]) for r in simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    # The second row of id 5 is a text of its own; the first is a copy of 3.
    assert keep([(3, base), (5, near), (5, other)]) == [(3, "word0 "), (5, "other0")]
    # Near copies without ids: one stays; unless a member has an id, then that one.
    assert keep([(None, base), (None, near), (None, other), (None, other)]) == [(-1, "other0"), (-1, "word0 ")]
    assert keep([(None, base), (None, near), (7, near), (None, other)]) == [(-1, "other0"), (7, "word0 ")]
    assert keep([(7, base), (7, near), (7, base)]) == [(7, "word0 ")]


# ------------------------------------------------------------------- search
def plain_search(rows, k):
    words = [collections.Counter((t or "").encode().lower().split()) for _, t in rows]
    n = len(rows)
    mean = sum(sum(w.values()) for w in words) / n
    df = collections.Counter(x for w in words for x in w)
    asked = collections.defaultdict(set)
    for (i, _), w in zip(rows, words):
        if i is not None and i % 20 == 0:
            asked[i] |= set(w)
    out = []
    for q, terms in asked.items():
        scores = []
        for (i, _), w in zip(rows, words):
            norm = 1.2 * (0.25 + 0.75 * sum(w.values()) / mean)
            s = sum(math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * w[t] * 2.2 / (w[t] + norm) for t in terms if t in w)
            if i != q and s > 0:
                scores.append((-round(s, 6), -2**63 if i is None else i))
        out += [(q, r + 1, None if d == -2**63 else d, -s) for r, (s, d) in enumerate(sorted(scores)[:k])]
    return out


def rounded(rows):
    return sorted(((q, r, str(d), round(s, 4)) for q, r, d, s in rows))


@pytest.mark.parametrize("size", [search.SHARD_POSTINGS, 700])
def test_op9_against_scoring_every_row(spark, size, monkeypatch):
    monkeypatch.setattr(search, "SHARD_POSTINGS", size)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.op9_bm25_top_k(spark, SF).collect()
    assert rounded((r.query_id, r.rank, r.doc_id, r.score) for r in got) == rounded(plain_search(rows, 10))


def test_search_prunes_and_stays_exact(spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(2000)]
    weights = [1 / (i + 1) for i in range(2000)]
    rows = [(i, " ".join(rng.choices(vocabulary, weights, k=rng.randint(5, 120)))) for i in range(1, 1500)]
    rows += [(2000 + i, rows[19][1]) for i in range(40)]  # many copies of a query: ties by id
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    got = search.search(df, F.col("doc_id") % 20 == 0).collect()
    assert rounded((r.query_id, r.rank, r.doc_id, r.score) for r in got) == rounded(plain_search(rows, 10))


@pytest.mark.parametrize("cells, held", [(0, 1), (3_000, 5_000), (10**7, 10**6)])
def test_shards_agree_for_every_size_of_matrix_and_batch(cells, held, monkeypatch):
    monkeypatch.setattr(search, "DENSE_CELLS", cells)
    monkeypatch.setattr(search, "BATCH_SCORES", held)
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choices([f"w{j}" for j in range(900)], [1 / (j + 1) for j in range(900)], k=rng.randint(1, 90)))) for i in range(1, 700)]
    rows += [(1000 + i, rows[39][1]) for i in range(30)] + [(2000, "only this")]
    held_terms = [search._terms(t) for _, t in rows]
    mean = sum(x[2] for x in held_terms) / len(rows)
    df = collections.Counter(t for x in held_terms for t in x[0].tolist())
    shard = search.Shard([i for i, _ in rows], [x[2] for x in held_terms], [x[0] for x in held_terms], [x[1] for x in held_terms], mean)
    asked = [n for n, (i, _) in enumerate(rows) if i % 20 == 0]
    terms = np.concatenate([held_terms[n][0] for n in asked])
    weights = np.array([math.log(1 + (len(rows) - df[t] + 0.5) / (df[t] + 0.5)) for t in terms.tolist()])
    at = np.concatenate([[0], np.cumsum([len(held_terms[n][0]) for n in asked])])
    own = np.array([rows[n][0] for n in asked])
    got = [(int(own[i]), r + 1, d, float(x)) for i, docs, scores in shard.top(own, at, terms, weights, 10) for r, (d, x) in enumerate(zip(docs, scores))]
    assert rounded(got) == rounded(plain_search(rows, 10))


@pytest.mark.parametrize("at_once", [1, 7, 256])
def test_rows_of_a_batch_are_scored_together(at_once, monkeypatch):
    """One exact scoring for a batch, in stretches that also cut a query's rows; a given threshold is kept."""
    monkeypatch.setattr(search, "EXACT_ROWS", at_once, raising=False)
    rng = random.Random(7)
    texts = [" ".join(rng.choices([f"w{j}" for j in range(300)], k=rng.randint(1, 60))) for _ in range(400)]
    texts += [texts[3]] * 20
    held = [search._terms(t) for t in texts]
    shard = search.Shard([*range(len(texts))], [x[2] for x in held], [x[0] for x in held], [x[1] for x in held], 30.0)
    asked = [*range(0, 100, 5), 3]
    cut = np.concatenate([[0], np.cumsum([len(held[n][0]) for n in asked])])
    terms = np.concatenate([held[n][0] for n in asked])
    weights = np.random.default_rng(7).random(len(terms)) + 0.1

    def score(i, d):
        weight = dict(zip(terms[cut[i]:cut[i + 1]].tolist(), weights[cut[i]:cut[i + 1]].tolist()))
        norm = 1.2 * (0.25 + 0.75 * held[d][2] / 30.0)
        return sum(weight[t] * c * 2.2 / (c + norm) for t, c in zip(held[d][0].tolist(), held[d][1].tolist()) if t in weight)

    calls, exact = [], search.Shard.exact
    monkeypatch.setattr(search.Shard, "exact", lambda *a: calls.append(1) or exact(*a))
    least = np.array([0.0, 5.0, 1e9] * 7)
    got = {i: (d.tolist(), x.tolist()) for i, d, x in shard.top(np.array(asked), cut, terms, weights, 10, least)}
    assert len(calls) == 1
    for i, own in enumerate(asked):
        every = sorted((-round(score(i, d), 6), d) for d in range(len(texts)) if d != own)
        want = [(d, -x) for x, d in every[:10] if -x > 0 and -x >= least[i]]
        docs, scores = got.get(i, ([], []))
        assert docs == [d for d, _ in want] and scores == pytest.approx([x for _, x in want])


def test_short_lists_are_read_once(monkeypatch):
    """A query reads its short lists in one piece, and its common words only for the blocks that it may enter."""
    rng = random.Random(9)
    kinds = [[f"{kind}{j}" for j in range(400)] for kind in "ab"]
    rows = [(i, " ".join(rng.choices(kinds[i % 2], [1 / (j + 1) for j in range(400)], k=rng.randint(20, 60)))) for i in range(2000)]
    rows += [(3000 + i, rows[20 + i % 2][1]) for i in range(40)]
    held = [search._terms(t) for _, t in rows]
    mean = sum(x[2] for x in held) / len(rows)
    df = collections.Counter(t for x in held for t in x[0].tolist())
    shard = search.Shard([i for i, _ in rows], [x[2] for x in held], [x[0] for x in held], [x[1] for x in held], mean)
    asked = [n for n, (i, _) in enumerate(rows) if i % 20 == 0]
    cut = np.concatenate([[0], np.cumsum([len(held[n][0]) for n in asked])])
    terms = np.concatenate([held[n][0] for n in asked])
    weights = np.array([math.log(1 + (len(rows) - df[t] + 0.5) / (df[t] + 0.5)) for t in terms.tolist()])
    reads, read = [], search.Shard._read
    monkeypatch.setattr(search.Shard, "_read", lambda *a: reads.append(1) or read(*a))
    own = np.array([rows[n][0] for n in asked])
    got = [(int(own[i]), r + 1, d, float(x)) for i, docs, scores in shard.top(own, cut, terms, weights, 10) for r, (d, x) in enumerate(zip(docs, scores))]
    assert len(reads) <= len(asked)
    assert rounded(got) == rounded(plain_search(rows, 10))


@pytest.mark.parametrize("n", [1, 2, 3, 1000, 5000])
def test_words_are_found_by_their_first_bits(n):
    rng = np.random.default_rng(n)
    words = np.unique(np.concatenate([rng.integers(-(2**63), 2**63 - 1, n), [-(2**63), 2**63 - 1, 0, -1][:n]]))
    words = np.append(words, words[-1:] - np.arange(1, 30)) if n == 5000 else words  # many of one beginning
    words = np.unique(words)
    shard = search.Shard([1], [len(words)], [words], [np.ones(len(words), np.int32)], 10.0)
    asked = rng.permutation(np.concatenate([words, words + np.where(words < 2**63 - 1, 1, 0), rng.integers(-(2**63), 2**63 - 1, 500)]))
    place = {w: i for i, w in enumerate(words.tolist())}
    assert shard.find(asked).tolist() == [place.get(w, -1) for w in asked.tolist()]
    assert shard.find(asked[:0]).tolist() == []


def test_queries_alike_are_read_together(spark, monkeypatch):
    """Queries are written in the order of their commonest words, so that a batch holds queries alike."""
    rng = random.Random(10)
    rows = [(i, "every " + " ".join([f"the{i // 20 % 4}"] * 2 + [f"of{i // 20 % 4}"] + rng.choices([f"w{i // 20 % 4}_{j}" for j in range(300)], k=30))) for i in range(20, 1620)]
    folders, path = [], search.scratch_path
    monkeypatch.setattr(search, "scratch_path", lambda spark, name: folders.append(path(spark, name)) or folders[-1])
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = search.search(df, F.col("doc_id") % 20 == 0)
    kind = {search._terms(f"the{k}")[0][0]: k for k in range(4)}
    assert len(folders) == 2
    for folder in folders:
        files = sorted(Path(folder.removeprefix("file:")).glob("*.parquet"))
        terms = [x for f in files for x in pq.read_table(f, columns=["terms"])["terms"].to_pylist()]
        kinds = [next(kind[t] for t in x if t in kind) for x in terms]
        assert len(kinds) == 80 and sum(a != b for a, b in zip(kinds, kinds[1:])) == 3
    assert rounded((r.query_id, r.rank, r.doc_id, r.score) for r in got.collect()) == rounded(plain_search(rows, 10))


@pytest.mark.parametrize("part", [1, 2, 10])
def test_rows_are_searched_once(spark, part, monkeypatch):
    """Rows of the seed search are not searched again; its hits are merged with those of the rest."""
    monkeypatch.setattr(search, "SEED", part)
    rng = random.Random(8)
    words = [f"w{i}" for i in range(200)]
    rows = [(None if i % 50 == 7 else i, " ".join(rng.choices(words, k=rng.randint(3, 40)))) for i in range(1, 500)]
    rows += [(600 + i, rows[19][1]) for i in range(15)] + rows[100:120] + [(700, None), (None, None)]
    searched, best_of = [], search._best_of
    monkeypatch.setattr(search, "_best_of", lambda some, *more: searched.append(some.count()) or best_of(some, *more))
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    got = search.search(df, F.col("doc_id") % 20 == 0).collect()
    assert sum(searched) == len(rows)
    # Rows of one id are several hits and one query.
    assert rounded((r.query_id, r.rank, r.doc_id, r.score) for r in got) == rounded(plain_search(rows, 10))


def test_search_odd_rows(spark):
    rows = [(20, "a b"), (20, "c"), (1, None), (2, ""), (None, "a c"), (3, "B a"), (3, "b a"), (40, "nothing shared"), (60, None), (4, "a " * 50_000)]
    df = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, score int")
    got = search.search(df, F.col("doc_id") % 20 == 0, k=3).collect()
    assert rounded((r.query_id, r.rank, r.doc_id, r.score) for r in got) == rounded(plain_search(rows, 3))
    assert search.search(df.limit(0), F.lit(True)).count() == 0


# ------------------------------------------------------------------- mixing
def plain_budgets(caps, weights, budget):
    """Water-filling by repeated shares, one level after another."""
    def split(nodes, total):
        open_, given = dict(nodes), {}
        while open_:
            w = sum(x[1] for x in open_.values())
            short = {n: x for n, x in open_.items() if x[0] <= total * x[1] / w + 1e-9}
            if not short:
                return {**given, **{n: total * x[1] / w for n, x in open_.items()}}
            for n, x in short.items():
                given[n] = x[0]
                del open_[n]
            total -= sum(x[0] for x in short.values())
        return given

    # Tokens under a zero weight are no capacity.
    caps = {leaf: c for leaf, c in caps.items() if all(weights.get(leaf[:d], 1.0) > 0 for d in (1, 2, 3))}
    out, parents = {}, {(): budget}
    for depth in (1, 2, 3):
        found = {}
        for parent, total in parents.items():
            nodes = {}
            for leaf, cap in caps.items():
                if leaf[:depth - 1] == parent:
                    p = leaf[:depth]
                    nodes[p] = (nodes.get(p, (0, 0))[0] + cap, weights.get(p, 1.0))
            found.update(split({n: x for n, x in nodes.items() if x[1] > 0}, total))
        parents = found
    return parents


def test_budgets_go_to_siblings_before_ancestors(spark):
    tokens = {("a", "x", "1"): 10, ("a", "x", "2"): 500, ("a", "y", "1"): 40, ("b", "x", "1"): 1000, ("b", "x", "2"): 5, ("c", "z", "1"): 0, ("d", "z", "9"): 70}
    weights = {("a",): 2.0, ("a", "x"): 3.0, ("b", "x", "2"): 4.0, ("d",): 0.0}
    leaves = spark.createDataFrame([(*k, v) for k, v in tokens.items()], "d string, l string, s string, tokens long")
    for budget in (0.0, 100.0, 700.0, 2000.0, 9000.0):
        got = {(r.d, r.l, r.s): r.budget for r in mixing.allocate(leaves, ["d", "l", "s"], weights, budget, 2.0).collect()}
        want = plain_budgets({k: 2 * v for k, v in tokens.items()}, weights, budget)
        assert got == {k: int(v + 1e-6) for k, v in want.items()}, budget


def test_zero_weights_below_the_top_leave_no_gap(spark):
    leaves = spark.createDataFrame([("a", "x", "1", 1000), ("a", "y", "1", 100), ("b", "x", "1", 5000), ("b", "x", "2", 70)], "d string, l string, s string, tokens long")
    for weights in ({("a", "x"): 0.0}, {("a", "x"): 0.0, ("b", "x", "2"): 0.0}, {("b", "x", "1"): 0.0}, {(None, "x"): 0.0}):
        got = {(r.d, r.l, r.s): r.budget for r in mixing.allocate(leaves, ["d", "l", "s"], weights, 1000.0, 1.0).collect()}
        plain = {(d, "x") if k == (None, "x") else k: w for k, w in weights.items() for d in ("a", "b")}
        want = plain_budgets({tuple(r[:3]): r.tokens for r in leaves.collect()}, plain, 1000.0)
        assert got == {k: int(v + 1e-6) for k, v in want.items()}
        assert sum(got.values()) >= min(1000, sum(r.tokens for r in leaves.collect() if tuple(r[:3]) in want)) - 2


def test_op4_against_sorting_every_leaf(spark):
    """The registered query: every leaf's rows in the seeded order, taken up to its budget."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    domain = F.regexp_extract(F.coalesce("source", F.lit("")), "^[A-Za-z]*", 0)
    tie = F.xxhash64("text")
    orders = [F.xxhash64(F.lit(queries.MIX_SEED), F.lit(e).cast("long"), F.col("doc_id"), tie).alias(f"h{e}") for e in range(5)]
    rows = docs.select("doc_id", domain.alias("d"), F.coalesce("lang", F.lit("")).alias("l"), F.coalesce("source", F.lit("")).alias("s"), "text", *orders).collect()
    leaves = collections.defaultdict(list)
    for r in rows:
        leaves[r.d, r.l, r.s].append((r, len(re.findall("[^\x20\x09-\x0d]+", r.text or ""))))
    held = {leaf: sum(n for _, n in some) for leaf, some in leaves.items()}
    weights = {(d, lang): w for d, _, _ in leaves for lang, w in queries.LANGUAGE_WEIGHTS.items()}
    budgets = plain_budgets({leaf: 4 * n for leaf, n in held.items()}, weights, sum(held.values()))
    want = {}
    for leaf, some in leaves.items():
        budget = int(budgets[leaf] + 1e-6)
        whole = budget // held[leaf] if held[leaf] else 0
        rest, used = budget - whole * held[leaf], 0
        for r, n in sorted(some, key=lambda x: (x[0][f"h{whole}"] % 2**64, x[0].doc_id)):
            used += n
            epochs = whole + (used <= rest and whole < 4)
            if epochs:
                want[r.doc_id] = (*leaf, n, epochs)
    got = {r.doc_id: (r.domain, r["lang"], r.source, r.n_tokens, r.epochs) for r in queries.op4_source_mix(spark, SF).collect()}
    assert got == want and len(set(x[-1] for x in want.values())) > 1


def test_weights_for_a_name_under_every_parent(spark):
    tokens = {(d, l, s): 100 * (i + 1) for i, (d, l, s) in enumerate((d, l, s) for d in "abc" for l in ("en", "de") for s in "12")}
    leaves = spark.createDataFrame([(*k, v) for k, v in tokens.items()], "d string, l string, s string, tokens long")
    named = {(d, "en"): 3.0 for d in "abc"} | {("b", "en"): 0.5, (None, "de"): 2.0}
    every = {(None, "en"): 3.0, ("b", "en"): 0.5} | {(d, "de"): 2.0 for d in "abc"}
    wanted = mixing.allocate(leaves, ["d", "l", "s"], {(d, l): w for d in "abc" for l, w in (("en", 0.5 if d == "b" else 3.0), ("de", 2.0))}, 3000.0, 1.0).collect()
    for weights in (named, every):
        assert sorted(mixing.allocate(leaves, ["d", "l", "s"], weights, 3000.0, 1.0).collect()) == sorted(wanted)


def test_prefixes_fill_the_budgets(spark):
    rng = random.Random(1)
    rows = [(i, "w " * rng.randint(1, 30), rng.choice(["en", "de", None]), rng.choice(["s1"] * 8 + ["s2", "s3"]), "x") for i in range(3000)]
    rows += [(9001, None, "en", "s1", "x"), (None, "w w", "en", None, "x"), (5, rows[5][1], *rows[5][2:])]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, epochs string")
    levels = {"d": F.lit("web"), "l": F.col("lang"), "s": F.col("source")}
    chosen = mixing.mix(df, levels, {("web", "en"): 3.0}, budget=30_000, max_epochs=3, seed=4)
    got = chosen.collect()
    assert len(mixing.expand(chosen, df.columns).collect()) == sum(r.epochs for r in got)
    assert mixing.expand(chosen, df.columns).columns == df.columns
    held = collections.defaultdict(int)
    for _, t, lang, source, _ in rows:
        held["web", lang or "", source or ""] += len((t or "").split())
    budgets = plain_budgets({k: 3 * v for k, v in held.items()}, {("web", "en"): 3.0}, 30_000)
    used = collections.defaultdict(int)
    for r in got:
        used[r.d, r.l, r.s] += r.tokens * r.epochs
    for leaf, b in budgets.items():
        assert used[leaf] <= b + 1e-6 and used[leaf] > b - 60  # a prefix ends within one row (or two equal ones)
    again = mixing.mix(df.repartition(7), levels, {("web", "en"): 3.0}, budget=30_000, max_epochs=3, seed=4).collect()
    assert collections.Counter((r.row.doc_id, r.epochs) for r in again) == collections.Counter((r.row.doc_id, r.epochs) for r in got)
    other = mixing.mix(df, levels, {("web", "en"): 3.0}, budget=30_000, max_epochs=3, seed=5).collect()
    assert {r.row.doc_id for r in other} != {r.row.doc_id for r in got}
    assert mixing.mix(df.limit(0), levels, {}).count() == 0


# ----------------------------------------------------------------- pipeline
def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert [n.split("_")[0] for n in names] == ["toxicity", "simhash", "pii", "mixing", "packing"]
    columns, counts = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.staged(stage(spark, docs, SF), "test-stage")
        counts.append(docs.count())
        if name != "packing":
            assert docs.columns == columns, name
        if name == "pii":
            assert docs.filter("text rlike '[A-Za-z0-9]@[a-z0-9]+[.]'").count() == 0 and docs.filter("n_chars <> length(text)").count() == 0
    assert counts[1] < counts[0] and counts[2] < counts[1] and counts[3] == counts[2]
    per_sequence = docs.groupBy("sequence_id").agg(F.sum("length").alias("n"))
    assert per_sequence.filter("n > 2048").count() == 0


def test_pipeline_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.staged(stage(spark, docs, SF), "test-stage")
        assert docs.count() == 0
