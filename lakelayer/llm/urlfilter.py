"""URL filter: host and path rules, propagated over redirects and canonical links.

A rule (host, path, action) fits a URL of its host or a subdomain whose path
starts with the rule's; the longest rule wins. URLs joined by a redirect (an HTML
refresh, or a row of a given redirect table) or a canonical link name the same
page, so a decision holds for the whole connected component: a URL without a rule
is allowed if a member has an explicit allow, else blocked if a member is blocked,
else allowed. A URL's own rule always comes first.

Graph nodes are URLs without fragment, dot segments and the scheme's default port and with
scheme and host in lower case. Tags in HTML comments are none, and character references in links
(``&amp;``, ``&#38;`` ...) are decoded. Relative links are resolved against the page's URL, or its first
``<base href>``, as in RFC 3986; links of a scheme without ``//`` (mailto) are none.
Link targets that are no row of the table take part with their own rules.

Defined cases: a null URL, or one without ``://``, has empty host and path and no
rule and is allowed; a null or empty text has no links; one row per input row,
repeated ids and URLs included; an empty table gives no rows; other columns are
not read. All canonical links and refreshes of a text count.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakelayer.llm.common import staged
from lakelayer.llm.components import connected_components

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Tags, and what one must hold to count; ``rel`` is a list of words.
LINK, META, BASE = "(?is)<link\\b[^>]*>", "(?is)<meta\\b[^>]*>", "(?is)<base\\b[^>]*>"
CANONICAL = "(?is)\\brel\\s*=\\s*(?:\"[^\"]*(?<![^\\s\"])canonical(?![^\\s\"])|'[^']*(?<![^\\s'])canonical(?![^\\s'])|canonical\\b)"
REFRESH = "(?is)\\bhttp-equiv\\s*=\\s*[\"']?\\s*refresh\\b"
HREF = "(?is)\\bhref\\s*=\\s*[\"']?([^\"'\\s>]+)"
GOAL = "(?is)\\burl\\s*=\\s*[\"']?([^\"'\\s>]+)"


def host_and_path(url: Column) -> tuple[Column, Column]:
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def without_dots(path: Column) -> Column:
    """The path with ``.`` and ``..`` segments resolved."""
    parts = F.split(path, "/")
    last = F.element_at(parts, -1)
    kept = F.aggregate(
        F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))),
        F.array().cast("array<string>"),
        lambda a, x: F.when(x == ".", a).when(x == "..", F.slice(a, 1, F.greatest(F.size(a) - 1, F.lit(0)))).otherwise(F.concat(a, F.array(x))),
    )
    plain = F.concat(F.lit("/"), F.array_join(kept, "/"), F.when(last.isin(".", "..") & (F.size(kept) > 0), F.lit("/")).otherwise(F.lit("")))
    return F.when(path.rlike("^/(?:.*/)?\\.\\.?(?:/|$)"), plain).otherwise(path)


def node(url: Column) -> Column:
    """The URL as a graph node; null where there is no ``://``."""
    host, path = host_and_path(url)
    at = F.instr(url, "://")
    scheme = F.lower(F.substring(url, F.lit(1), at - 1))
    query = F.regexp_extract(F.substring(url, at + 3, F.length(url)), "^[^?#]*(\\?[^#]*)", 1)
    port = F.when(scheme == "http", F.lit(":(80)?$")).when(scheme == "https", F.lit(":(443)?$")).otherwise(F.lit(":$"))
    return F.when(at > 0, F.concat(scheme, F.lit("://"), F.regexp_replace(host, port, F.lit("")), without_dots(path), query))


#: Named character references that occur in links.
NAMED = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": "\u00a0", "colon": ":", "sol": "/", "quest": "?", "equals": "=", "num": "#"}
REFERENCE = "&(?:" + "|".join(NAMED) + "|#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6});"


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` written, and computed, once however often it is used:
    a lambda over one element names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def decoded(value: Column) -> Column:
    """Character references decoded once; unknown code points stay as written."""
    names = F.create_map(*[F.lit(x) for pair in NAMED.items() for x in pair])

    def char(code: Column) -> Column:
        real = (code > 0) & (code < 0x110000) & ~code.between(0xD800, 0xDFFF)
        return F.when(real, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))

    def one(ref: Column) -> Column:
        digits = F.when(ref.rlike("^&#[xX]"), F.conv(F.substring(ref, F.lit(4), F.length(ref) - 4), 16, 10)).otherwise(F.substring(ref, F.lit(3), F.length(ref) - 3))
        name = F.try_element_at(names, F.substring(ref, F.lit(2), F.length(ref) - 2))
        return F.coalesce(F.when(ref.startswith("&#"), once(digits.try_cast("int"), char)).otherwise(name), ref)

    def every(text: Column) -> Column:
        refs = F.transform(F.regexp_extract_all(text, F.lit(REFERENCE), F.lit(0)), one)
        joined = once(refs, lambda r: F.array_join(F.transform(F.split(text, REFERENCE, -1), lambda p, i: F.concat(p, F.coalesce(F.get(r, i), F.lit("")))), ""))
        return F.when(F.contains(text, F.lit("&")), joined).otherwise(text)

    return once(value, every)


def resolved(link: Column, base: Column) -> Column:
    """``link``, relative or not, as an absolute URL (dot segments kept); null for a
    scheme without ``//``."""
    origin = F.regexp_extract(base, "^(.*?://[^/?#]*)", 1)
    path = F.regexp_extract(base, "^.*?://[^/?#]*([^?#]*)", 1)
    folder = F.when(path == "", F.lit("/")).otherwise(F.regexp_extract(path, "^(.*/)", 1))
    return (
        F.when(link.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), link)
        .when(link.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None))
        .when(link.startswith("//"), F.concat(F.regexp_extract(base, "^(.*?:)//", 1), link))
        .when(link.startswith("/"), F.concat(origin, link))
        .when(link.startswith("?"), F.concat(origin, path, link))
        .when(link.startswith("#"), F.concat(F.regexp_extract(base, "^([^#]*)", 1), link))
        .otherwise(F.concat(origin, folder, link))
    )


def html_links(pages: DataFrame) -> DataFrame:
    """(a, b) nodes from the canonical links and the refreshes of each page."""
    pages = pages.filter(F.col("url").contains("://") & F.col("html").rlike("(?i)canonical|http-equiv"))
    pages = pages.withColumn("html", F.regexp_replace("html", "(?s)<!--.*?(?:-->|$)", " "))

    def targets(tag: str, holds: str, value: str) -> Column:
        tags = F.filter(F.regexp_extract_all("html", F.lit(tag), F.lit(0)), lambda t: t.rlike(holds))
        return F.transform(tags, lambda t: decoded(F.regexp_extract(t, value, 1)))

    links = F.concat(targets(LINK, CANONICAL, HREF), targets(META, REFRESH, GOAL))
    base = decoded(F.regexp_extract(F.regexp_extract("html", BASE, 0), HREF, 1))
    target = pages.select("url", base.alias("base"), F.explode(F.array_distinct(links)).alias("t")).filter("t <> ''")
    page = F.col("url")
    base = once(F.col("base"), lambda b: F.when(b == "", page).otherwise(F.coalesce(resolved(b, page), page)))
    goal = once(base, lambda b: resolved(F.col("t"), b))
    return target.select(node(page).alias("a"), once(goal, node).alias("b")).filter("a IS NOT NULL AND b IS NOT NULL")


def longest_rule(urls: DataFrame, key: str, rules: DataFrame) -> DataFrame:
    """(key, host, path, rule, action) for distinct ``key`` URLs; rule is null where none fits.

    A URL meets only rules of its host suffixes, by an equi-join. Suffixes longer
    than the longest rule host are not built."""
    rules = rules.select(F.col("host").alias("_host"), F.col("path").alias("_path"), "action")
    most = rules.agg(F.max(F.size(F.split("_host", "\\.")))).first()[0] or 0
    host, path = host_and_path(F.col(key))
    parsed = urls.select(key, host.alias("host"), path.alias("path"))
    labels = F.split("host", "\\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.least(F.size("_labels"), F.lit(max(most, 1)))), lambda n: F.array_join(F.slice("_labels", -n, n), "."))
    fits = (
        parsed.withColumn("_labels", labels).withColumn("_host", F.explode(suffixes)).drop("_labels")
        .join(rules, "_host", "left").withColumn("_fits", F.col("path").startswith(F.col("_path")))
    )
    rule = F.concat("_host", "_path")
    best = F.max(F.when(F.col("_fits"), F.struct(F.length(rule).alias("n"), (F.col("action") == "allow").alias("allow"), rule.alias("rule"), F.col("action").alias("action"))))
    return fits.groupBy(key, "host", "path").agg(best.alias("_best")).select(key, "host", "path", "_best.rule", "_best.action")


def judge(pages: DataFrame, rules: DataFrame, redirects: DataFrame | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: ``page_id``, ``host``, ``path``, ``rule``, ``verdict``.

    ``rules`` has host, path and action (allow or block); ``redirects``, if given, (a, b) URLs."""
    pages = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    links = html_links(pages)
    if redirects is not None:
        links = links.union(redirects.select(node(F.col("a")).alias("a"), node(F.col("b")).alias("b")).filter("a IS NOT NULL AND b IS NOT NULL"))
    roots = staged(connected_components(links), "url-roots")
    members = longest_rule(roots.select("node"), "node", rules).join(roots, "node")
    decisions = members.groupBy("root").agg(F.bool_or(F.col("action") == "allow").alias("allow"), F.bool_or(F.col("action") == "block").alias("block"))
    blocked = decisions.filter("block AND NOT coalesce(allow, false)").select("root")
    aliases = staged(roots.join(blocked, "root", "left_semi").select("node"), "blocked-aliases")

    urls = longest_rule(pages.filter("url IS NOT NULL").select("url").distinct(), "url", rules)
    urls = urls.withColumn("_node", node(F.col("url"))).join(aliases.select(F.col("node").alias("_node"), F.lit(True).alias("_alias")), "_node", "left")
    inherited = F.when(F.col("_alias"), F.lit("block")).otherwise(F.lit("allow"))
    urls = staged(urls.select("url", "host", "path", "rule", F.coalesce("action", inherited).alias("verdict")), "url-verdicts")
    return pages.select("page_id", "url").join(urls, "url", "left").select(
        "page_id", F.coalesce("host", F.lit("")).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "rule", F.coalesce("verdict", F.lit("allow")).alias("verdict")
    )


ORACLE_SQL = r"""
WITH RECURSIVE
rules(rhost, rpath, action) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
raw AS (
  SELECT page_id, url, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest, html FROM pages),
links AS (
  SELECT a, b FROM (
    SELECT url AS a, unnest([regexp_extract(regexp_extract(html, '(?is)<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*>'), '(?is)\bhref\s*=\s*["'']?([^"''\s>]+)', 1),
                             regexp_extract(regexp_extract(html, '(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b[^>]*>'), '(?is)\burl\s*=\s*["'']?([^"''\s>;]+)', 1)]) AS t,
           CASE WHEN contains(t, '://') THEN t
                WHEN t LIKE '//%' THEN regexp_extract(url, '^(.*?:)//', 1) || t
                WHEN t LIKE '/%' THEN regexp_extract(url, '^(.*?://[^/?#]*)', 1) || t END AS b
    FROM pages WHERE contains(url, '://'))
  WHERE contains(b, '://')),
urls AS (SELECT DISTINCT u FROM (SELECT url AS u FROM pages WHERE url IS NOT NULL UNION ALL SELECT a FROM links UNION ALL SELECT b FROM links)),
parsed AS (
  SELECT u, lower(regexp_extract(rest, '^[^/?#]*')) AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, rest,
         CASE WHEN contains(u, '://') THEN lower(split_part(u, '://', 1)) || '://' || lower(regexp_extract(rest, '^[^/?#]*')) || regexp_extract(rest, '^[^/?#]*([^#]*)', 1) END AS node
  FROM (SELECT u, CASE WHEN contains(u, '://') THEN substr(u, strpos(u, '://') + 3) ELSE '' END AS rest FROM urls)),
ruled AS (
  SELECT u, node, host, path, arg_max(rhost || rpath, length(rhost || rpath)) AS rule, arg_max(action, length(rhost || rpath)) AS action
  FROM parsed LEFT JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  GROUP BY u, node, host, path),
edges AS (
  SELECT x.node AS a, y.node AS b FROM links JOIN parsed x ON x.u = links.a JOIN parsed y ON y.u = links.b
  UNION SELECT y.node, x.node FROM links JOIN parsed x ON x.u = links.a JOIN parsed y ON y.u = links.b),
reach(a, b) AS (SELECT a, b FROM edges UNION SELECT reach.a, edges.b FROM reach JOIN edges ON reach.b = edges.a),
inherited AS (
  SELECT reach.a AS node, bool_or(action = 'allow') AS allowed, bool_or(action = 'block') AS blocked
  FROM reach JOIN ruled ON ruled.node = reach.b GROUP BY 1)
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule,
       coalesce(action, CASE WHEN blocked AND NOT coalesce(allowed, false) THEN 'block' END, 'allow') AS verdict
FROM pages LEFT JOIN ruled ON ruled.u = pages.url LEFT JOIN inherited ON inherited.node = ruled.node
"""
