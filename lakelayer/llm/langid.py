"""Language identification by multinomial logistic regression on TF-IDF character n-grams.

Features are hashed n-grams (``ORDERS``) of the lower-cased text in which every run
of other characters than letters is one space; the value is ``(1 + log tf) * idf``
with unit length per text. Document frequencies cover all texts that training may
use. The weights are fitted by FTRL-proximal with elastic-net penalties (see
``linear``) on a bounded sample of labelled texts drawn by a hash of the id: about
``MAX_TRAIN`` in proportion, but at least about ``LEAST`` of every language (all, if it
has no more), so that rare languages are learned at every size of the table. A
fifth of each language's sample is set aside to fit the temperature by which the scores
are divided, so that the reported probability is calibrated. The sample grows with
the number of languages only.

Defined cases: a text that is null or has no letter is ``und`` with score 0; rows
without label train nothing; without training rows every text is ``und``; ids may be
null or repeated (one row per input row); an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakelayer.llm.linear import Rows, ftrl, logits, softmax

MAX_TRAIN = 4000
LEAST = 60
BITS = 16
ORDERS = (1, 2, 3)
L1, L2 = 0.02, 0.01
UND = "und"
_OTHER = re.compile(r"[\W\d_]+")
#: Odd multiplier of the n-gram hash (64-bit golden ratio).
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def ngrams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed n-grams and their counts; empty where there is no letter."""
    letters = _OTHER.sub(" ", (text or "").lower()).strip()
    if not letters:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    chars = np.frombuffer(f" {letters} ".encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    total = np.zeros(1 << BITS, np.int64)
    for n in ORDERS:
        if len(chars) < n:
            break
        h = np.full(len(chars) - n + 1, n, np.uint64)
        for i in range(n):
            h = (h ^ chars[i:len(chars) - n + 1 + i]) * _MULTIPLIER
            h ^= h >> np.uint64(29)
        total += np.bincount((h >> np.uint64(64 - BITS)).astype(np.int64), minlength=1 << BITS)
    found = np.flatnonzero(total)
    return found, total[found]


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float

    def features(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        i, n = ngrams(text)
        v = (1 + np.log(n)) * self.idf[i]
        return i, v / max(np.sqrt((v * v).sum()), 1e-12)

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        names, scores = [], np.zeros(len(texts))
        for row, text in enumerate(texts):
            i, v = self.features(text)
            if not len(i) or not self.languages:
                names.append(UND)
                continue
            x = v @ self.weights[i] + self.weights[-1]
            p = softmax(x[None, :] / self.temperature)[0]
            k = int(p.argmax())
            names.append(self.languages[k])
            scores[row] = min(1.0, p[k])
        return names, scores


def _temperature(x: np.ndarray, y: np.ndarray) -> float:
    """Minimises the negative log-likelihood over a geometric grid, refined once."""
    if not len(y):
        return 1.0

    def loss(t):
        return -np.log(softmax(x / t)[np.arange(len(y)), y] + 1e-12).mean()

    best = min(np.geomspace(0.05, 20, 61), key=loss)
    return float(min(best * np.geomspace(0.9, 1.1, 41), key=loss))


def train(docs: DataFrame, allowed: Column, max_train: int = MAX_TRAIN, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Fit on the rows where ``allowed`` holds and the label is not null."""
    spark = docs.sparkSession
    key = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))
    rows = docs.filter(allowed & F.col(f"`{lang_col}`").isNotNull()).select(
        key.alias("key"), F.col(f"`{text_col}`").cast("string").alias("text"), F.col(f"`{lang_col}`").cast("string").alias("lang")
    )

    def frequencies(batches):
        df, n = np.zeros(1 << BITS, np.int64), 0
        for batch in batches:
            for text in batch.column("text").to_pylist():
                df[ngrams(text)[0]] += 1
                n += 1
        found = np.flatnonzero(df)
        yield pa.RecordBatch.from_pydict({"gram": np.concatenate([[-1], found]), "n": np.concatenate([[n], df[found]])})

    counts = rows.select("text").mapInArrow(frequencies, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect()
    df, n = np.zeros(1 << BITS), 0
    for r in counts:  # at most one row per hash value
        if r["gram"] < 0:
            n = r["n"]
        else:
            df[r["gram"]] = r["n"]
    idf = np.log((1 + n) / (1 + df)) + 1
    model = Model([], idf, np.zeros(((1 << BITS) + 1, 0)), 1.0)
    if not n:
        return model

    def vectors(batches):
        for batch in batches:
            pairs = [model.features(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("lang"), pa.array([i.astype("<i4").tobytes() for i, _ in pairs], pa.binary()), pa.array([v.astype("<f4").tobytes() for _, v in pairs], pa.binary())],
                names=["key", "lang", "idx", "val"],
            )

    # One row per language.
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    shares = [(lang, int(1_000_000 * min(1.0, max(max_train / n, LEAST / size))) + 1) for lang, size in sorted(sizes.items())]
    drawn = rows.join(F.broadcast(spark.createDataFrame(shares, "lang string, _share int")), "lang")
    # Not by the key alone: rows of one id are drawn one by one.
    drawn = drawn.filter(F.pmod(F.xxhash64(F.lit("train"), "key", "text"), F.lit(1_000_000)) < F.col("_share"))
    got = drawn.select("key", "text", "lang").mapInArrow(vectors, "key string, lang string, idx binary, val binary").collect()
    got = sorted((r for r in got if r["idx"]), key=lambda r: (r["lang"], r["key"], bytes(r["idx"])))
    model.languages = sorted({r["lang"] for r in got})
    if not got:
        return model
    x = Rows([(np.frombuffer(bytes(r["idx"]), "<i4"), np.frombuffer(bytes(r["val"]), "<f4").astype(float)) for r in got], 1 << BITS)
    y = np.array([model.languages.index(r["lang"]) for r in got])
    # Rows are sorted by language; every fifth of a language is set aside.
    every = np.arange(len(got))
    aside = (every - np.searchsorted(y, y)) % 5 == 4
    model.weights = ftrl(x, y, len(model.languages), every[~aside], L1, L2, alpha=1.0, epochs=4)
    model.temperature = _temperature(logits(model.weights, x, every[aside]), y[aside])
    return model


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, ``lang_pred``, ``score``; reads the text alone."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            names, scores = held.value.predict(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(names, pa.string()), pa.array(scores)], names=["doc_id", "lang_pred", "score"])

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double")
