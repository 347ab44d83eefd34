"""Toxicity by a classifier chain.

The categories are predicted one after another (by default low quality, then
toxic). Each is a sparse linear model over the distinct words and
word stems of a text plus the probabilities of the earlier categories. For training, those probabilities are out
of fold: the rows are dealt to folds by a hash of their id, and a row's earlier
probabilities come from models that have not seen its fold, so a later model does
not learn to trust an earlier one's memory of its own training rows. The decision
threshold maximises F1 over the last category's out-of-fold probabilities.

The models are fitted on a bounded sample of labelled rows: about ``MAX_LABELLED``,
drawn by a hash of the id. The vocabulary is all words found in at least ``MIN_DOCS``
rows of the sample. Scoring reads all texts in whole.

Defined cases: a null or empty text has no words and gets the models' bias, but is
never toxic; ids may be null or repeated (one row per input row); a null label
leaves its row out of that category's model only, of repeated labels the larger counts, and
labels of null or empty texts are not used; without labelled rows, or
where one class is missing, a category's probability is the share of positives (zero
without rows); an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakelayer.llm.common import narrow, staged
from lakelayer.llm.linear import Rows, ftrl, logits

MAX_LABELLED = 8_000
MIN_DOCS = 5
FOLDS = 3
STEM = 5
L1, L2 = 2.0, 0.1

#: Category and its positive condition over the label columns, in the chain's order.
CHAIN: dict[str, str] = {"low_quality": "quality = 0", "toxic": "toxic = 1"}

_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> set[str]:
    """Distinct lower-case words, and the stems (first five letters, marked by ~) of
    the longer ones, so that an unseen form of a known word counts as well."""
    words = set(_WORD.findall((text or "").lower()))
    return words | {w[:STEM] + "~" for w in words if len(w) > STEM}


@dataclass
class Chain:
    categories: tuple[str, ...]
    vocabulary: dict[str, int]
    weights: list[np.ndarray]  # per category: words, then earlier categories, then bias; difference of the two classes
    threshold: float
    f1: float

    def probabilities(self, texts: list[str | None]) -> np.ndarray:
        """One row per text, one column per category."""
        find = self.vocabulary.get
        ids = [[i for i in map(find, words_of(t)) if i is not None] for t in texts]
        row = np.repeat(np.arange(len(texts)), [len(i) for i in ids])
        flat = np.fromiter((i for some in ids for i in some), np.int64, len(row))
        out = np.zeros((len(texts), len(self.categories)))
        n = len(self.vocabulary)
        for k, w in enumerate(self.weights):
            x = np.bincount(row, w[flat], minlength=len(texts)) + w[-1] + out[:, :k] @ w[n:n + k]
            out[:, k] = 1 / (1 + np.exp(-np.clip(x, -50, 50)))
        return out


def _best_threshold(p: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Threshold halfway below the score that ends the best F1, and that F1."""
    if not y.any():
        return 2.0, 0.0
    order = np.argsort(-p, kind="stable")
    hits = np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, len(y) + 1) + y.sum())
    f1[:-1][p[order][:-1] == p[order][1:]] = 0  # equal scores go together
    i = int(f1.argmax())
    below = p[order[i + 1]] if i + 1 < len(y) else 0.0
    return float((p[order[i]] + below) / 2), float(f1[i])


def fit_chain(rows: list[np.ndarray], labels: np.ndarray, folds: np.ndarray, vocabulary: dict[str, int], categories: tuple[str, ...]) -> Chain:
    """``rows``: word numbers of each training text; ``labels``: 0/1, NaN where unknown, a
    column per category. A category's models see the rows whose own label is known; its
    probabilities are out of fold for all rows."""
    n, size = len(rows), len(vocabulary)
    earlier = np.zeros((n, 0))
    weights = []
    for k in range(len(categories)):
        known = ~np.isnan(labels[:, k])
        y = np.where(known, labels[:, k], 0).astype(np.int64)
        x = Rows([(np.concatenate([r, np.arange(size, size + k)]).astype(np.int32), np.concatenate([np.ones(len(r)), earlier[i]])) for i, r in enumerate(rows)], size + k)

        def fit(which: np.ndarray, y=y, x=x, k=k) -> np.ndarray:
            if not len(which) or y[which].min() == y[which].max():
                w = np.zeros(size + k + 1)
                share = y[which].mean() if len(which) else 0.0
                w[-1] = np.log(max(share, 1e-9) / max(1 - share, 1e-9))
                return w
            both = ftrl(x, y, 2, which, L1, L2)
            return both[:, 1] - both[:, 0]

        everyone = np.arange(n)
        held = np.zeros(n)
        for f in range(FOLDS):
            out = everyone[folds == f]
            if len(out):
                w = fit(everyone[(folds != f) & known])
                held[out] = 1 / (1 + np.exp(-np.clip(logits(w[:, None], x, out)[:, 0], -50, 50)))
        weights.append(fit(everyone[known]))
        earlier = np.column_stack([earlier, held])
    last = ~np.isnan(labels[:, -1])
    threshold, f1 = _best_threshold(earlier[last, -1], labels[last, -1] > 0) if last.any() else (2.0, 0.0)
    # Words without weight in any category need not be looked up.
    used = np.flatnonzero(np.any([w[:size] != 0 for w in weights], axis=0)) if size else np.empty(0, int)
    words = sorted(vocabulary, key=vocabulary.get)
    kept = {words[j]: i for i, j in enumerate(used)}
    weights = [np.concatenate([w[:size][used], w[size:]]) for w in weights]
    return Chain(categories, kept, weights, threshold, f1)


def train(docs: DataFrame, labels: DataFrame, chain: Mapping[str, str] = CHAIN, max_labelled: int = MAX_LABELLED, id_col: str = "doc_id", text_col: str = "text") -> Chain:
    """Fit the chain on about ``max_labelled`` labelled documents; ``chain`` maps each
    category to its positive condition over the columns of ``labels`` (keyed by doc_id)."""
    names = tuple(chain)
    known = labels.select(F.col("doc_id").cast("long").alias("_id"), *[F.expr(f"int({sql})").alias(f"_y{k}") for k, sql in enumerate(chain.values())])
    ys = [f"_y{k}" for k in range(len(names))]
    known = known.groupBy("_id").agg(*[F.max(y).alias(y) for y in ys]).dropna("all", subset=ys)
    # A text without a character teaches nothing.
    texts = narrow(docs, id_col, text_col).filter("text <> ''")
    n = texts.select(F.col("doc_id").alias("_id")).join(known, "_id", "left_semi").count()
    draw = F.pmod(F.xxhash64(F.lit("sample"), "_id"), F.lit(1_000_000))
    known = known.filter(draw < int(1_000_000 * min(1.0, max_labelled / max(n, 1)))) if n > max_labelled else known
    sample = texts.join(known, F.col("doc_id") == F.col("_id"))

    def split(batches):
        for batch in batches:
            rest = [c for c in batch.schema.names if c != "text"]
            words = pa.array([sorted(words_of(t)) for t in batch.column("text").to_pylist()], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), words], names=[*rest, "words"])

    fold = F.pmod(F.xxhash64(F.lit("fold"), "_id"), F.lit(FOLDS)).cast("long")
    sample = sample.select(fold.alias("fold"), *ys, "text").mapInArrow(split, "fold long, " + ", ".join(f"{y} int" for y in ys) + ", words array<string>")
    sample = staged(sample, "labelled")
    found = sample.select(F.explode("words").alias("w")).groupBy("w").agg(F.count("*").alias("n")).filter(F.col("n") >= MIN_DOCS)
    # Bounded by the sample; as one Arrow column, since a row object per word is several times larger.
    words = found.select("w").toArrow().column("w").to_pylist()
    words.sort()
    vocabulary = {w: i for i, w in enumerate(words)}
    del words
    look = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def number(batches):
        for batch in batches:
            rest = [c for c in batch.schema.names if c != "words"]
            ids = [np.array([i for i in map(look.value.get, words) if i is not None], "<i4").tobytes() for words in batch.column("words").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), pa.array(ids, pa.binary())], names=[*rest, "ids"])

    got = sample.mapInArrow(number, "fold long, " + ", ".join(f"{y} int" for y in ys) + ", ids binary").collect()
    got.sort(key=lambda r: (r["fold"], bytes(r["ids"]), *[-1 if r[y] is None else r[y] for y in ys]))  # the order of arrival must not matter
    rows = [np.sort(np.frombuffer(bytes(r["ids"]), "<i4")) for r in got]
    y = np.array([[np.nan if r[c] is None else r[c] for c in ys] for r in got], float).reshape(-1, len(names))
    return fit_chain(rows, y, np.array([r["fold"] for r in got], np.int64), vocabulary, names)


def score(docs: DataFrame, chain: Chain, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, ``p_<category>`` for each, and ``<last category>`` as a boolean."""
    held = docs.sparkSession.sparkContext.broadcast(chain)
    names = [f"p_{c}" for c in chain.categories]
    last = chain.categories[-1]

    def run(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            p = held.value.probabilities(texts)
            decided = (p[:, -1] > held.value.threshold) & np.array([bool(t) for t in texts], bool)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(p[:, k]) for k in range(len(names))), pa.array(decided)], names=["doc_id", *names, last])

    schema = "doc_id long, " + ", ".join(f"{n} double" for n in names) + f", {last} boolean"
    return narrow(docs, id_col, text_col).mapInArrow(run, schema)


def reject(docs: DataFrame, chain: Chain, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that the chain's last category holds for; all columns pass through."""
    held = docs.sparkSession.sparkContext.broadcast(chain)

    def run(batches):
        for batch in batches:
            texts = [t if t is None else str(t) for t in batch.column(text_col).to_pylist()]
            p = held.value.probabilities(texts)[:, -1]
            yield batch.filter(pa.array([not t or x <= held.value.threshold for t, x in zip(texts, p)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
