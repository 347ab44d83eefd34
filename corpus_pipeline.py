"""The training-data pipeline: five stages, each written as Parquet and reread.

All stages but the last return the columns of documents. Each works on every row its
predecessor kept and its decisions take effect: toxic documents go, one document of
each near-duplicate group stays, personal data is replaced, sources are repeated or
thinned out to their target weights, and what is left is packed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakelayer.llm import mixing, pii, queries, simhash, toxicity
from lakelayer.llm.common import staged, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.reject(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs, shingle_words=4, max_bits=4)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts change, so ``n_chars`` is counted anew."""
    changed = pii.redact(docs)
    return changed.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else changed


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A document used in several epochs is repeated."""
    return mixing.expand(queries.mixed(docs, max_epochs=2), docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 2048 tokens, as in the packing query."""
    return queries.packed(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_duplicates", drop_near_duplicates),
    ("pii", replace_personal_data),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: SQL cannot express trained models, XXH64 fingerprints or tokenizers.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
