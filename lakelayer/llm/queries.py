"""Registered queries of the training-data operators and their SQL oracles.

Each ``opN_`` query applies its operator to the whole intended table and derives
the columns of its result contract from the operator's output.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakelayer.llm import langid, mixing, packing, pii, prefixtrie, quality, search, simhash, spelling, substrings, tokenbin, toxicity, urlfilter
from lakelayer.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_token_files(spark, sf_dir):
    folder = tokenbin.write(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return tokenbin.read(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op2_quality_ledger(spark, sf_dir):
    rows = quality.apply_policy(quality.ledger(table(spark, sf_dir, "documents")), quality.STANDARD)
    measured = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return rows.select("doc_id", *measured, quality.fails(quality.BASE).alias("base_failed"), "kept")


ORACLE["op2_quality_ledger"] = quality.ORACLE_SQL


@query
def op5_packing(spark, sf_dir):
    return packed(table(spark, sf_dir, "documents"))


def packed(docs: DataFrame) -> DataFrame:
    """The packing contract's columns, one row per piece."""
    pieces = packing.tokenise(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=1, with_ids=False)
    return packing.place(pieces).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


#: The rule list of the URL contract.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


@query
def op6_url_filter(spark, sf_dir):
    rules = spark.createDataFrame(URL_RULES, "host string, path string, action string")
    return urlfilter.judge(table(spark, sf_dir, "pages"), rules)


ORACLE["op6_url_filter"] = urlfilter.ORACLE_SQL


@query
def op8_pii(spark, sf_dir):
    found = pii.detect(table(spark, sf_dir, "documents"))
    counts = [F.expr(f"cast(size(filter(base, x -> x.kind = '{k.name}')) AS bigint) AS n_{k.name}") for k in pii.KINDS if k.base]
    return found.select("doc_id", *counts, F.sha2(pii.joined("base"), 256).alias("base_sha256"), pii.joined("spans").alias("spans"))


ORACLE["op8_pii"] = pii.ORACLE_SQL


@query
def op3_toxicity_chain(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


#: Target weights of the languages under every domain; other nodes weigh 1.
LANGUAGE_WEIGHTS = {"en": 0.4, "de": 0.2, "fr": 0.2, "es": 0.2}
MIX_SEED = 17


def mixed(docs: DataFrame, max_epochs: float) -> DataFrame:
    """The tree domain (the letters a source's name starts with), language, source."""
    levels = {"domain": F.regexp_extract(F.coalesce(F.col("source"), F.lit("")), "^[A-Za-z]*", 0), "language": F.col("lang"), "leaf_source": F.col("source")}
    weights = {(None, lang): w for lang, w in LANGUAGE_WEIGHTS.items()}
    return mixing.mix(docs, levels, weights, max_epochs=max_epochs, seed=MIX_SEED)


@query
def op4_source_mix(spark, sf_dir):
    chosen = mixed(table(spark, sf_dir, "documents"), max_epochs=4)
    return chosen.select("row.doc_id", "domain", F.col("language").alias("lang"), F.col("leaf_source").alias("source"), F.col("tokens").alias("n_tokens"), "epochs")


@query
def op7_simhash_near_duplicates(spark, sf_dir):
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle_words=4, max_bits=4)
    return found.select("doc_id", simhash.hex_of("fp").alias("fingerprint"), "component_id")


@query
def op9_bm25_top_k(spark, sf_dir):
    return search.search(table(spark, sf_dir, "documents"), F.col("doc_id") % 20 == 0, k=10)


@query
def op10_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 4 == 2
    predicted = langid.predict(docs, langid.train(docs, ~held_out))
    return predicted.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query
def op11_prefix_trie(spark, sf_dir):
    c = F.col("conv_id")
    lent = F.crc32(c.cast("string").cast("binary")) % 6
    turns, convs = prefixtrie.rebuilt(prefixtrie.positions(table(spark, sf_dir, "conversations")), c - c % 100, lent, most=5)
    return prefixtrie.trie(turns, convs).select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


@query
def op12_spelling_variants(spark, sf_dir):
    vocab = spelling.vocabulary(table(spark, sf_dir, "documents"), min_length=5, min_count=3, variant=spelling.misprints)
    return spelling.forms(spelling.near_words(vocab))


@query
def op13_repeated_passages(spark, sf_dir):
    return substrings.remove_repeats(table(spark, sf_dir, "documents"), size=35)


ORACLE["op11_prefix_trie"] = prefixtrie.ORACLE_SQL
ORACLE["op12_spelling_variants"] = spelling.ORACLE_SQL
ORACLE["op13_repeated_passages"] = substrings.ORACLE_SQL
