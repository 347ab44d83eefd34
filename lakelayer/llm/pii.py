"""Personal data: patterns propose spans, checksums confirm, context words adjust the score.

DataFrame functions only. Per kind a regular expression proposes matches; the
positions follow from the lengths of the matches and of the text between them.
Validators drop what cannot be of the kind: octets above 255, wrong digit counts,
numbers that fail Luhn (cards) or mod-97 (IBANs). A confirmed span starts from
its kind's score; a context word of the kind within 40 characters before or 20
after adds 0.25. Spans of the four base kinds stay whatever their score; the added
kinds need ``THRESHOLD``.

An IBAN has no end of its own: letters and digits may follow it after a space. So
every word end from 15 to 34 characters on is tested by mod-97 (``_ibans``); the
length that the IBAN registry gives the country goes first, then the longest. The
next search begins after a confirmed end, or at the next word where none is.

The patterns use possessive runs and start only where a run of their first
characters starts or the previous match ended. They match what the plain
patterns match and take time linear in the length of a run.

Defined cases: null and empty texts have no span; ids may be null or repeated (one
row per input row); an empty table gives no rows; other columns are not read.
Positions count code points, the end is exclusive.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakelayer.llm.common import narrow, staged

THRESHOLD = 0.6
CONTEXT_SCORE = 0.25

_DIGITS = "regexp_replace(m, '[^0-9]', '')"


def _luhn(digits: str) -> str:
    d = f"cast(substring({digits}, length({digits}) - i, 1) AS int)"
    return f"aggregate(sequence(0, length({digits}) - 1), 0, (a, i) -> a + CASE WHEN i % 2 = 0 THEN {d} WHEN {d} > 4 THEN 2 * {d} - 9 ELSE 2 * {d} END) % 10 = 0"


def _card(low: int, high: int) -> str:
    return f"length({_DIGITS}) BETWEEN {low} AND {high} AND {_luhn(_DIGITS)}"


_IBAN = "replace(m, ' ', '')"
_IBAN_TURNED = f"concat(substring({_IBAN}, 5), left({_IBAN}, 4))"
#: Letters count 10 to 35 and take two digits.
_MOD97 = (
    f"aggregate(transform(sequence(1, length({_IBAN_TURNED})), i -> ascii(substring({_IBAN_TURNED}, i, 1))), 0, "
    "(a, c) -> CASE WHEN c >= 65 THEN (a * 100 + c - 55) % 97 ELSE (a * 10 + c - 48) % 97 END) = 1"
)


#: Characters of a country's IBANs (IBAN registry).
IBAN_LENGTHS = (
    "AD:24,AE:23,AL:28,AT:20,AZ:28,BA:20,BE:16,BG:22,BH:22,BI:27,BR:29,BY:28,CH:21,CR:22,CY:28,CZ:24,DE:22,DJ:27,DK:18,DO:28,EE:20,EG:29,ES:24,FI:18,FK:18,FO:18,"
    "FR:27,GB:22,GE:22,GI:23,GL:18,GR:27,GT:28,HN:28,HR:21,HU:28,IE:22,IL:23,IQ:23,IS:26,IT:27,JO:30,KW:30,KZ:20,LB:28,LC:32,LI:21,LT:20,LU:20,LV:21,LY:25,"
    "MC:27,MD:24,ME:22,MK:19,MN:20,MR:27,MT:31,MU:30,NI:28,NL:18,NO:15,OM:23,PK:24,PL:28,PS:29,PT:25,QA:29,RO:24,RS:22,RU:33,SA:24,SC:31,SD:18,SE:24,SI:19,"
    "SK:24,SM:27,SO:23,ST:25,SV:28,TL:23,TN:24,TR:26,UA:29,VA:22,VG:24,XK:20,YE:30"
)
#: The first letter of whatever may be an IBAN; the words after it are judged one by one.
_IBAN_START = r"(?<![A-Za-z0-9])[A-Z](?=[A-Z][0-9]{2}(?:\x20?[A-Z0-9]){11})"
_IBAN_MOST = r"^[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}"


@dataclass(frozen=True)
class Kind:
    name: str
    source: str  # the pattern whose matches it judges
    valid: str  # SQL over m, the match, and g_<source>[i], g_<source>[i + 1], the text before and after it
    score: float
    context: str
    base: bool = True


#: Pattern and a cheap test that a text can match it.
PATTERNS: dict[str, tuple[str, str]] = {
    "email": (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "contains(text, '@')"),
    "ip": (r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", "text rlike '[0-9]\\\\.[0-9]'"),
    "card": (r"[0-9](?:[\x20-]?[0-9])++", "text rlike '[0-9][\\\\x20-]?[0-9]'"),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", "contains(text, '+')"),
    "iban": (_IBAN_START, "text rlike '[A-Z][A-Z][0-9][0-9]'"),
}

_PART = "cast(trim(LEADING '0' FROM p) AS string)"
#: In the order of the result: the base kinds, then the added ones.
KINDS = (
    Kind("email", "email", "true", 0.8, "mail|contact|write|kontakt|correo|courriel"),
    Kind("ip", "ip", f"forall(split(m, '[.]'), p -> length({_PART}) <= 3 AND coalesce(try_cast({_PART} AS int), 0) <= 255)", 0.5, "ip|address|host|server|login"),
    Kind("card", "card", _card(16, 19), 0.8, "card|visa|credit|karte|tarjeta|carte"),
    Kind("phone", "phone", f"length({_DIGITS}) BETWEEN 8 AND 15", 0.6, "phone|call|tel|mobile|fax|ruf"),
    Kind("iban", "iban", "true", 0.8, "iban|account|bank|konto|cuenta|compte", base=False),
    Kind("card_short", "card", _card(13, 15), 0.4, "card|visa|credit|amex|karte|tarjeta|carte", base=False),
)
SPAN = "struct<kind: string, start: int, end: int, score: double>"


#: Code points of a piece of text that is cut by position.
_PIECE = 1024
_NO_INTS = "cast(array() AS array<int>)"


def _running(values: str, fold: str) -> str:
    """For each of the integers ``values`` the fold (SQL over a and v, from 0) of those before
    it. An array that grows by one is copied as a whole, so it grows by blocks of the
    square root of their number."""
    b = "cast(ceil(sqrt(size(d))) AS int)"
    ks = f"sequence(0, (size(d) - 1) div {b})"
    block = f"slice(d, k * {b} + 1, {b})"
    step = f"(s, v) -> named_struct('a', transform(array(s.a), a -> {fold})[0], 'o', concat(s.o, array(s.a))), s -> s.o"
    bases = f"aggregate(transform({ks}, k -> aggregate({block}, 0, (a, v) -> {fold})), named_struct('a', 0, 'o', {_NO_INTS}), {step})"
    within = f"transform({ks}, k -> aggregate({block}, named_struct('a', bs[k], 'o', {_NO_INTS}), {step}))"
    # A lambda over one element names a value that is used more than once.
    return f"transform(array({values}), d -> CASE WHEN size(d) = 0 THEN {_NO_INTS} ELSE transform(array({bases}), bs -> flatten({within}))[0] END)[0]"


def _cut(pieces: str, at: str, n: str) -> str:
    """``n`` code points from ``at`` on (from 0) of a text held as ``pieces``; takes time by ``n``."""
    return f"substring(array_join(slice({pieces}, {at} div {_PIECE} + 1, ({at} + {n}) div {_PIECE} - {at} div {_PIECE} + 1), ''), {at} % {_PIECE} + 1, {n})"


def _pieces(text: str) -> str:
    return f"regexp_extract_all({text}, '(?s).{{1,{_PIECE}}}', 0)"


def _literal(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _ibans() -> str:
    """The confirmed IBANs as a struct of m, the matches, and g, the text around them,
    from s_iban, the places where one may start."""
    here = _cut("ps", "s", "64")
    words = f"split(regexp_extract({here}, {_literal(_IBAN_MOST)}, 0), ' ')"
    ends = "transform(sequence(1, size(w)), n -> array_join(slice(w, 1, n), ' '))"
    follows = _cut("ps", "(s + length(m))", "1")
    passed = f"filter({ends}, m -> length({_IBAN}) >= 15 AND NOT {follows} rlike '[A-Za-z0-9]' AND {_MOD97})"
    registered = f"get(filter(ms, m -> length({_IBAN}) = cast(try_element_at(str_to_map('{IBAN_LENGTHS}', ',', ':'), left(m, 2)) AS int)), 0)"
    # A lambda over one element names a value that is used more than once.
    passed = f"transform(array({words}), w -> {passed})[0]"
    best = f"transform(array({passed}), ms -> coalesce({registered}, try_element_at(ms, -1)))[0]"
    found = f"filter(transform(s_iban, s -> named_struct('s', s, 'm', {best})), x -> x.m IS NOT NULL)"
    # Starts inside an earlier IBAN are none. As above, the result grows by blocks.
    none = "cast(array() AS array<struct<s: int, m: string>>)"
    b = "cast(ceil(sqrt(size(f))) AS int)"
    inner = (
        f"aggregate(slice(f, k * {b} + 1, {b}), named_struct('at', o.at, 'o', {none}), (a, x) -> CASE WHEN x.s >= a.at THEN "
        "named_struct('at', x.s + length(x.m), 'o', concat(a.o, array(x))) ELSE a END)"
    )
    kept = (
        f"aggregate(sequence(0, (size(f) - 1) div {b}), named_struct('at', 0, 'o', cast(array() AS array<array<struct<s: int, m: string>>>)), "
        f"(o, k) -> transform(array({inner}), r -> named_struct('at', r.at, 'o', concat(o.o, array(r.o))))[0], o -> flatten(o.o))"
    )
    kept = f"transform(array({found}), f -> CASE WHEN size(f) = 0 THEN {none} ELSE {kept} END)[0]"
    before = "CASE WHEN i = 0 THEN 0 ELSE ks[i - 1].s + length(ks[i - 1].m) END"
    end = "CASE WHEN size(ks) = 0 THEN 0 ELSE ks[size(ks) - 1].s + length(ks[size(ks) - 1].m) END"
    gap = f"transform(array({before}), at -> {_cut('ps', 'at', '(x.s - at)')})[0]"
    tail = f"transform(array({end}), at -> {_cut('ps', 'at', '(length(text) - at)')})[0]"
    gaps = f"concat(transform(ks, (x, i) -> {gap}), array({tail}))"
    made = f"transform(array({kept}), ks -> named_struct('m', transform(ks, x -> x.m), 'g', {gaps}))[0]"
    return f"transform(array({_pieces('text')}), ps -> {made})[0]"


def _spans(kind: Kind) -> str:
    """The kind's confirmed spans from the columns m_, g_ and s_ of its pattern."""
    m, g, s = (f"{x}_{kind.source}" for x in "mgs")
    near = f"lower(concat(right({g}[i], 40), ' ', left({g}[i + 1], 20))) rlike '(?:^|[^a-z])(?:{kind.context})'"
    made = (
        f"transform({m}, (m, i) -> named_struct('kind', '{kind.name}', 'start', {s}[i], 'end', {s}[i] + length(m), "
        f"'score', least(1D, {kind.score}D + CASE WHEN {near} THEN {CONTEXT_SCORE}D ELSE 0D END), 'ok', {kind.valid}))"
    )
    ok = "x.ok" if kind.base else f"x.ok AND x.score >= {THRESHOLD}D"
    return f"transform(filter({made}, x -> {ok}), x -> named_struct('kind', x.kind, 'start', x.start, 'end', x.end, 'score', x.score))"


def _with_spans(df: DataFrame) -> DataFrame:
    """``df`` (with a non-null ``text``) and one array of spans per kind, as ``spans_<kind>``."""
    keep = [f"`{c}`" for c in df.columns]
    none = "cast(array() AS array<string>)"
    df = df.selectExpr(*keep, *[f"CASE WHEN {test} THEN regexp_extract_all(text, {_literal(rx)}, 0) ELSE {none} END AS m_{k}" for k, (rx, test) in PATTERNS.items()])
    m = [f"m_{k}" for k in PATTERNS]
    df = df.selectExpr(*keep, *m, *[f"CASE WHEN size(m_{k}) > 0 THEN split(text, {_literal(rx)}, -1) ELSE {none} END AS g_{k}" for k, (rx, _) in PATTERNS.items()])
    g = [f"g_{k}" for k in PATTERNS]
    def starts(k: str) -> str:
        moved = _running(f"transform(m_{k}, (m, i) -> length(g_{k}[i]) + length(m))", "a + v")
        return f"transform({moved}, (at, i) -> at + length(g_{k}[i])) AS s_{k}"

    df = df.selectExpr(*keep, *m, *g, *[starts(k) for k in PATTERNS])
    # Of the IBANs only the starts are known so far.
    others = [c for c in m + g + [f"s_{k}" for k in PATTERNS] if not c.endswith("_iban")]
    df = df.selectExpr(*keep, *others, f"CASE WHEN size(m_iban) > 0 THEN {_ibans()} END AS _iban")
    df = df.selectExpr(*keep, *others, f"coalesce(_iban.m, {none}) AS m_iban", f"coalesce(_iban.g, {none}) AS g_iban")
    df = df.selectExpr(*keep, *others, "m_iban", "g_iban", starts("iban"))
    empty = f"cast(array() AS array<{SPAN}>)"
    return df.selectExpr(*keep, *[f"CASE WHEN size(m_{k.source}) > 0 THEN {_spans(k)} ELSE {empty} END AS spans_{k.name}" for k in KINDS])


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``base`` and ``spans`` (arrays of kind,
    start, end, score; by kind in the order of ``KINDS``, then by start). Stored once,
    so that filters on spans do not repeat the search."""
    rows = narrow(docs, id_col, text_col).withColumn("text", F.coalesce("text", F.lit("")))
    base = ", ".join(f"spans_{k.name}" for k in KINDS if k.base)
    every = ", ".join(f"spans_{k.name}" for k in KINDS)
    return staged(_with_spans(rows).selectExpr("doc_id", f"concat({base}) AS base", f"concat({every}) AS spans"), "pii-spans")


def joined(spans: str) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    return F.expr(f"array_join(transform({spans}, x -> concat(x.kind, ':', x.start, ':', x.end)), ',')")


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every span of the text replaced by its kind in brackets, as
    ``[EMAIL]``. Where spans overlap, the one that starts first names the
    replacement and the rest is covered too. A text without spans (null included)
    is unchanged; all other columns pass through."""
    columns = docs.columns
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_row"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    found = _with_spans(held).selectExpr("_row", "text", "sort_array(transform(concat(" + ", ".join(f"spans_{k.name}" for k in KINDS) + "), x -> struct(x.start AS s, x.end AS e, x.kind AS kind))) AS _spans")
    # How far the spans before each one reach.
    reached = _running("transform(_spans, x -> x.e)", "greatest(a, v)")
    piece = f"concat({_cut('ps', 'at[i]', '(x.s - at[i])')}, '[', upper(x.kind), ']')"
    tail = f"transform(array(array_max(transform(_spans, x -> x.e))), e -> {_cut('ps', 'e', '(length(text) - e)')})[0]"
    named = f"array_join(transform(_spans, (x, i) -> CASE WHEN x.s >= at[i] THEN {piece} ELSE '' END), '')"
    parts = f"transform(array({_pieces('text')}), ps -> transform(array({reached}), at -> concat({named}, {tail}))[0])[0]"
    out = found.select("_row", F.expr(f"CASE WHEN size(_spans) = 0 THEN _row.`{text_col}` ELSE {parts} END").alias("_text"))
    return out.select(*[F.col("_text").alias(c) if c == text_col else F.col(f"_row.`{c}`").alias(c) for c in columns])


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
rx(source, p) AS (VALUES
  ('email', '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+'), ('ip', '[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+'),
  ('card', '[0-9](?:[\x20-]?[0-9])+'), ('phone', '\+[0-9][\x20().0-9-]+[0-9]'), ('iban', '[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}')),
kinds(k, kind, source, words) AS (VALUES
  (1, 'email', 'email', NULL), (2, 'ip', 'ip', NULL), (3, 'card', 'card', NULL), (4, 'phone', 'phone', NULL), (5, 'iban', 'iban', NULL),
  (6, 'card_short', 'card', '(?:^|[^a-z])(?:card|visa|credit|amex|karte|tarjeta|carte)')),
cut AS (
  SELECT doc_id, source, m, CASE WHEN len(m) > 0 THEN string_split_regex(t, p) END AS g FROM (
    SELECT doc_id, t, source, p, regexp_extract_all(t, p) AS m FROM d, rx)),
each AS (
  SELECT doc_id, k, kind, words, m[i] AS m, g[i] AS before, g[i + 1] AS after,
         list_sum(list_transform(g[1:i], lambda x: length(x)))::BIGINT + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0)::BIGINT AS s,
         regexp_replace(m[i], '[^0-9]', '', 'g') AS dig, replace(m[i], ' ', '') AS packed
  FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM cut WHERE len(m) > 0) JOIN kinds USING (source)),
tested AS (
  SELECT *, list_sum(list_transform(range(0, length(dig)), lambda i: CASE WHEN i % 2 = 0 THEN substr(dig, length(dig) - i, 1)::INT
         WHEN substr(dig, length(dig) - i, 1)::INT > 4 THEN 2 * substr(dig, length(dig) - i, 1)::INT - 9
         ELSE 2 * substr(dig, length(dig) - i, 1)::INT END)) % 10 = 0 AS luhn,
    CASE WHEN kind = 'iban' THEN array_to_string(list_transform(string_split(packed[5:] || packed[:4], ''),
      lambda c: CASE WHEN c BETWEEN 'A' AND 'Z' THEN (ascii(c) - 55)::VARCHAR ELSE c END), '') END AS number
  FROM each),
found AS (
  SELECT doc_id, k, kind, s, s + length(m) AS e FROM tested WHERE
    kind = 'email'
    OR kind = 'ip' AND len(list_filter(string_split(m, '.'), lambda x: length(ltrim(x, '0')) > 3 OR coalesce(try_cast(ltrim(x, '0') AS INT), 0) > 255)) = 0
    OR kind = 'card' AND length(dig) BETWEEN 16 AND 19 AND luhn
    OR kind = 'phone' AND length(dig) BETWEEN 8 AND 15
    OR kind = 'iban' AND NOT regexp_matches(before, '[A-Za-z0-9]$') AND NOT regexp_matches(after, '^[A-Za-z0-9]')
       AND list_reduce(list_prepend(0, list_transform(string_split(number, ''), lambda c: c::INT)), lambda a, c: (a * 10 + c) % 97) = 1
    OR kind = 'card_short' AND length(dig) BETWEEN 13 AND 15 AND luhn AND regexp_matches(lower(right(before, 40) || ' ' || left(after, 20)), words)),
agg AS (
  SELECT doc_id, count(*) FILTER (kind = 'email') AS n_email, count(*) FILTER (kind = 'ip') AS n_ip, count(*) FILTER (kind = 'card') AS n_card,
         count(*) FILTER (kind = 'phone') AS n_phone, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY k, s) FILTER (k <= 4) AS base,
         string_agg(kind || ':' || s || ':' || e, ',' ORDER BY k, s) AS spans
  FROM found GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_email, 0)::BIGINT AS n_email, coalesce(n_ip, 0)::BIGINT AS n_ip, coalesce(n_card, 0)::BIGINT AS n_card,
       coalesce(n_phone, 0)::BIGINT AS n_phone, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN agg USING (doc_id)
"""
