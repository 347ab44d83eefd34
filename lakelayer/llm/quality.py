"""Quality rules as a bitmask ledger, in DataFrame functions only.

``ledger`` evaluates every rule once per document: the measurements and one
``failed`` bitmask (bit i set: rule i failed). ``apply_policy`` keeps a document
if no bit of the policy's mask is set; a policy is a versioned set of rules, so a
changed policy reads the ledger and never the text. ``ablation`` counts documents
per bitmask (at most two to the number of rules groups) and derives, by bitwise
tests, what each rule of a policy drops alone and what the policy would keep
without it.

Defined cases: a null or empty text has zero for every measurement and fails
``few_words``; ids may be null or repeated (one row per input row); an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakelayer.llm.common import narrow, staged

#: Fixed values of the measurements: white space, symbol characters, window length.
WHITE = "[\\x20\\x09-\\x0D]+"
WHITE_CHARS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Rules in bit order; each states its failure over the measurements. Append only.
RULES: dict[str, str] = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "duplicate_lines": "2 * n_dup_lines > n_lines",
    "short_words": "word_chars < 3 * n_words",
    "long_words": "word_chars > 12 * n_words",
    "upper_case": "2 * n_upper > word_chars",
}


@dataclass(frozen=True)
class Policy:
    name: str
    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return mask_of(self.rules)


def mask_of(rules) -> int:
    names = list(RULES)
    return sum(1 << names.index(r) for r in rules)


BASE = Policy("base", 1, ("few_words", "repeated_words"))
STANDARD = Policy("standard", 1, tuple(RULES))


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, n_upper."""
    trimmed = F.btrim(F.coalesce("text", F.lit("")), F.lit(WHITE_CHARS))
    base = narrow(docs, id_col, text_col).select("doc_id", "text", trimmed.alias("_trimmed"))
    words = base.select(
        "doc_id",
        F.expr(f"length(_trimmed) - length(translate(_trimmed, '{SYMBOLS}', ''))").cast("long").alias("n_symbols"),
        F.expr(f"length(_trimmed) - length(translate(_trimmed, '{UPPER}', ''))").cast("long").alias("n_upper"),
        F.when(F.col("_trimmed") == "", F.expr("cast(array() as array<string>)")).otherwise(F.split("_trimmed", WHITE)).alias("_words"),
        # A line without a word is empty once its white space is gone.
        F.expr("filter(split(coalesce(text, ''), '\\n'), x -> x rlike '[^\\\\x20\\\\x09-\\\\x0D]')").alias("_lines"),
    )
    windows = words.select(
        "doc_id", "n_symbols", "n_upper",
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.expr("transform(slice(_words, 1, greatest(size(_words) - 2, 0)), (w, i) -> xxhash64(w, _words[i + 1], _words[i + 2]))").alias("_hashes"),
    )
    # Only documents where some window occurs twice sort their windows.
    ordered = windows.withColumn(
        "_sorted",
        F.expr(
            "CASE WHEN size(array_distinct(_hashes)) < size(_hashes) "
            "THEN sort_array(transform(_hashes, (h, i) -> struct(h AS h, i AS i))) "
            "ELSE cast(array() AS array<struct<h: bigint, i: int>>) END"
        ),
    )
    last = "size(_sorted) - 1"
    again = ordered.withColumn(
        "_again",
        F.expr(
            f"sort_array(transform(filter(_sorted, (x, j) -> (j > 0 AND x.h = _sorted[greatest(j - 1, 0)].h) "
            f"OR (j < {last} AND x.h = _sorted[least(j + 1, {last})].h)), x -> x.i))"
        ),
    )
    # A window covers three words; the next repeated window may start inside it.
    covered = F.expr(
        "aggregate(transform(_again, (p, j) -> CASE WHEN j = size(_again) - 1 THEN 3 "
        "ELSE least(3, _again[least(j + 1, size(_again) - 1)] - p) END), 0, (a, x) -> a + x)"
    )
    return again.select("doc_id", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", covered.cast("long").alias("n_repeat_words"), "n_upper")


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Measurements and the ``failed`` bitmask over all rules, stored once. Stored,
    because a later filter on the bits would else be pushed below the measurements,
    which repeats their expressions."""
    bits = [F.when(F.expr(cond), F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, cond in enumerate(RULES.values())]
    failed = bits[0]
    for b in bits[1:]:
        failed = failed.bitwiseOR(b)
    return staged(measure(docs, id_col, text_col).withColumn("failed", failed), "quality-ledger")


def fails(policy: Policy) -> Column:
    return F.col("failed").bitwiseAND(F.lit(policy.mask)) != 0


def apply_policy(rows: DataFrame, policy: Policy = STANDARD) -> DataFrame:
    """A ledger with ``kept`` under the policy, and the policy's name and version."""
    return rows.withColumn("kept", ~fails(policy)).withColumn("policy", F.lit(f"{policy.name}-v{policy.version}"))


def ablation(rows: DataFrame, policy: Policy = STANDARD) -> DataFrame:
    """Per rule of the policy: documents that fail it, that only it drops, that the
    policy keeps, and that it would keep without the rule."""
    masks = rows.groupBy("failed").agg(F.count("*").alias("n"))
    rules = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(mask_of([r])).cast("long").alias("bit")) for r in policy.rules])
    each = masks.withColumn("r", F.explode(rules)).select("failed", "n", "r.rule", "r.bit")
    in_policy = F.col("failed").bitwiseAND(F.lit(policy.mask))

    def total(cond: Column, name: str) -> Column:
        return F.sum(F.when(cond, F.col("n")).otherwise(F.lit(0))).alias(name)

    return each.groupBy("rule", "bit").agg(
        total(F.col("failed").bitwiseAND(F.col("bit")) != 0, "n_failed"),
        total(in_policy == F.col("bit"), "n_only_this"),
        total(in_policy == 0, "n_kept"),
        total(in_policy.bitwiseAND(F.bitwise_not("bit")) == 0, "n_kept_without"),
    )


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
win AS (
  SELECT doc_id, i, struct_pack(a := w[i], b := w[i + 1], c := w[i + 2]) AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM win) WHERE n > 1),
cov AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM rep) GROUP BY doc_id),
m AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')))::BIGINT AS n_upper,
         len(l)::BIGINT AS n_lines, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(cov.n, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN cov USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words OR 2 * n_dup_lines > n_lines OR word_chars < 3 * n_words
            OR word_chars > 12 * n_words OR 2 * n_upper > word_chars) AS kept
FROM b
"""
