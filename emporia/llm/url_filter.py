"""URL filters: host and path rules, and blocks passed on to redirect and canonical aliases.

A page's own rule decides it: the longest rule whose host is the page's host or
a parent domain, and whose path starts the page's path. A page without a rule
takes the method's verdict: pages and link targets that name each other as
canonical or redirect to each other are the same resource; they form connected
components, and a component holding any URL that a rule blocks is blocked.
Explicit allow goes first: a page that an allow rule fits stays allowed in a
blocked component.

Links are read from the pages' HTML: ``<link rel=canonical href=...>`` and
``<meta http-equiv=refresh content="...url=...">``; character references in them
are decoded (the five names, and numbers), and they are resolved against the
page's URL as browsers do (relative to its folder, ``.`` and ``..`` taken out). A
URL's identity is its host, path and query; scheme and fragment do not count.
Components come from alternating star steps over written edge tables. Built-in
expressions only. The given ``pages`` tables hold no such links: there the method
finds no alias, and the tests run it on invented pages.

Defined cases: a null URL, or one without ``://``, has an empty host and path,
fits no rule and has no aliases; an empty table gives an empty result; repeated
pages give repeated rows; links that are empty, point to the page itself or have
no host (``mailto:``) are ignored; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emporia.llm.common import require, written
from emporia.llm.components import connected_components

# The rules of the registered query.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
# The named character references that HTML needs in attributes.
NAMED = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&"))
SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

HOST = r"://([^/?#]*)"
PATH = r"://[^/?#]*([^?#]*)"
QUERY = r"://[^?#]*(\?[^#]*)"
CANONICAL = r"(?is)<link\b[^>]*\brel\s*=\s*[\"']?canonical\b[^>]*>"
REFRESH = r"(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>"
HREF = r"(?is)\bhref\s*=\s*[\"']?\s*([^\"'\s>]+)"
REFRESH_URL = r"(?is)\burl\s*=\s*[\"']?\s*([^\"'\s>]+)"


def host_of(url: Column) -> Column:
    host = F.coalesce(F.regexp_extract(url, HOST, 1), F.lit(""))
    return F.translate(host, UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PATH, 1), F.lit(""))


def key_of(url: Column) -> Column:
    """A URL's identity (empty: none)."""
    return F.concat(host_of(url), path_of(url), F.coalesce(F.regexp_extract(url, QUERY, 1), F.lit("")))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """The longest fitting rule as (length, rule, verdict), null if none fits; of
    two rules written alike, allow. Rules are configuration held in the plan."""
    listed = F.array(
        *[
            F.struct(F.lit(h).alias("h"), F.lit(p).alias("p"), F.lit(v).alias("v"))
            for v, h, p in rules
        ]
    )
    fitting = F.filter(
        listed,
        lambda r: ((host == r["h"]) | F.endswith(host, F.concat(F.lit("."), r["h"]))) & F.startswith(path, r["p"]),
    )
    best = F.sort_array(
        F.transform(
            fitting,
            lambda r: F.struct(
                (F.length(r["h"]) + F.length(r["p"])).alias("length"),
                (r["v"] == "allow").alias("allow"),
                F.concat(r["h"], r["p"]).alias("rule"),
                r["v"].alias("verdict"),
            ),
        ),
        asc=False,
    )
    return F.get(best, F.lit(0))


def _character(code: Column) -> Column:
    """The character of a code point (1 and up), by its UTF-8 bytes."""

    def tail(shift: int) -> Column:
        return F.shiftright(code, shift).bitwiseAND(F.lit(0x3F)) + 0x80

    def text(*parts: Column) -> Column:
        number = parts[0]
        for part in parts[1:]:
            number = number * 256 + part
        return F.unhex(F.hex(number)).cast("string")

    return (
        F.when(code < 0x80, F.char(code))
        .when(code < 0x800, text(F.shiftright(code, 6) + 0xC0, tail(0)))
        .when(code < 0x10000, text(F.shiftright(code, 12) + 0xE0, tail(6), tail(0)))
        .otherwise(text(F.shiftright(code, 18) + 0xF0, tail(12), tail(6), tail(0)))
    )


def _decoded(link: Column) -> Column:
    """Character references replaced: numbers of code points, then the names, ``&amp;`` last."""

    def numbered(part: Column, i: Column) -> Column:
        digits = F.regexp_extract(part, r"^0*([0-9]{1,7});", 1)
        hexed = F.regexp_extract(part, r"^[xX]0*([0-9a-fA-F]{1,6});", 1)
        code = F.when(digits != "", digits.cast("long")).when(hexed != "", F.conv(hexed, 16, 10).cast("long"))
        rest = F.regexp_replace(part, r"^[xX]?[0-9a-fA-F]+;", "")

        def plain(c: Column) -> Column:
            valid = c.between(1, 0xD7FF) | c.between(0xE000, 0x10FFFF)
            return F.when(valid, F.concat(_character(c), rest)).otherwise(F.concat(F.lit("&#"), part))

        return F.when(i == 0, part).otherwise(F.get(F.transform(F.array(code), plain), F.lit(0)))

    text = F.array_join(F.transform(F.split(link, "&#"), numbered), "")
    for name, char in NAMED:
        text = F.replace(text, F.lit(name), F.lit(char))
    return text


def _without_dots(path: Column) -> Column:
    """An absolute path without ``.`` and ``..`` segments."""
    segments = F.split(path, "/")

    def step(kept: Column, segment: Column) -> Column:
        parent = F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(1)))
        return F.when(segment == ".", kept).when(segment == "..", parent).otherwise(F.concat(kept, F.array(segment)))

    kept = F.aggregate(segments, F.array().cast("array<string>"), step)
    folder = F.element_at(segments, -1).isin(".", "..")
    return F.array_join(F.when(folder, F.concat(kept, F.array(F.lit("")))).otherwise(kept), "/")


def _joined(link: Column, url: Column) -> Column:
    """A link as an absolute URL, dots left in (null if it has no host)."""
    scheme = F.regexp_extract(url, r"^(.*?)://", 1)
    root = F.concat(scheme, F.lit("://"), host_of(url))
    path = F.when(path_of(url) == "", F.lit("/")).otherwise(path_of(url))
    folder = F.regexp_extract(path, r"^(.*/)", 1)
    return (
        F.when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
        .when(link.startswith("/"), F.concat(root, link))
        .when(link.rlike(SCHEME), F.when(link.rlike(SCHEME + "//"), link))
        .when(link.startswith("?"), F.concat(root, path, link))
        .when((link != "") & ~link.startswith("#"), F.concat(root, folder, link))
    )


def alias_edges(pages: DataFrame) -> DataFrame:
    """(u, v): identities of a page and of a URL that it names as canonical or redirects to."""
    html, url = F.coalesce(F.col("html"), F.lit("")), F.col("url")
    links = F.concat(
        F.transform(
            F.regexp_extract_all(html, F.lit(CANONICAL), F.lit(0)), lambda t: F.regexp_extract(t, HREF, 1)
        ),
        F.transform(
            F.regexp_extract_all(html, F.lit(REFRESH), F.lit(0)), lambda t: F.regexp_extract(t, REFRESH_URL, 1)
        ),
    )
    marked = pages.where(html.rlike(r"(?i)\bcanonical\b|\bhttp-equiv\b"))
    named = marked.select(url.alias("url"), F.explode(links).alias("link"))
    # One step a select: each uses the one before several times.
    read = named.select("url", _decoded(F.col("link")).alias("link"))
    joined = read.select("url", _joined(F.col("link"), url).alias("to"))
    parts = joined.select(
        "url",
        F.regexp_extract("to", r"^(.*?://[^/?#]*)", 1).alias("before"),
        path_of(F.col("to")).alias("path"),
        F.regexp_extract("to", r"^.*?://[^?#]*(.*)$", 1).alias("after"),
    ).where(F.col("before").isNotNull())
    target = parts.select("url", F.concat("before", _without_dots(F.col("path")), "after").alias("to"))
    ends = target.select(key_of(url).alias("u"), key_of(F.col("to")).alias("v"))
    return ends.where("u <> '' and v <> '' and u <> v").distinct()


def _judged(key: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """The rule of a URL identity."""
    url = F.concat(F.lit("x://"), key)
    return rule_of(host_of(url), path_of(url), rules)


def blocked_aliases(edges: DataFrame, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Identities in components of which some URL is blocked by a rule."""
    members = written(connected_components(edges), "url-components")
    blocked = (
        members.where(_judged(F.col("node"), rules)["verdict"] == "block").select("component").distinct()
    )
    return members.join(blocked, "component", "left_semi").select("node")


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """Per row of ``pages`` (page_id, url, html): page_id, host, path, rule (null if
    none fits), verdict (allow or block), by_alias (the block came from an alias)."""
    require(pages, ("page_id", "url", "html"))
    url = F.col("url")
    edges = written(alias_edges(pages), "url-edges")
    own = pages.select(
        "page_id", host_of(url).alias("host"), path_of(url).alias("path"), key_of(url).alias("key")
    ).withColumn("own", rule_of(F.col("host"), F.col("path"), rules))
    if edges.isEmpty():
        met = own.withColumn("node", F.lit(None).cast("string"))
    else:
        aliases = written(blocked_aliases(edges, rules), "url-blocked")
        met = own.join(aliases, F.col("key") == F.col("node"), "left")
    by_alias = F.col("own").isNull() & F.col("node").isNotNull()
    return met.select(
        "page_id",
        "host",
        "path",
        F.col("own.rule").alias("rule"),
        F.coalesce(F.col("own.verdict"), F.when(by_alias, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
        by_alias.alias("by_alias"),
    )


def _sql_host(url: str) -> str:
    return f"translate(regexp_extract(coalesce({url}, ''), '://([^/?#]*)', 1), '{UPPER}', '{LOWER}')"


def _sql_path(url: str) -> str:
    return f"regexp_extract(coalesce({url}, ''), '://[^/?#]*([^?#]*)', 1)"


def _sql_key(url: str) -> str:
    return f"{_sql_host(url)} || {_sql_path(url)} || regexp_extract(coalesce({url}, ''), '://[^?#]*(\\?[^#]*)', 1)"


def oracle(rules: Sequence[tuple[str, str, str]] = RULES) -> str:
    """The same judgement in DuckDB SQL, components by recursion."""
    listed = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in rules)
    tags = "'(?is)<link\\b[^>]*\\brel\\s*=\\s*[\"'']?canonical\\b[^>]*>'", "'(?is)<meta\\b[^>]*\\bhttp-equiv\\s*=\\s*[\"'']?refresh\\b[^>]*>'"
    inner = "'(?is)\\bhref\\s*=\\s*[\"'']?\\s*([^\"''\\s>]+)'", "'(?is)\\burl\\s*=\\s*[\"'']?\\s*([^\"''\\s>]+)'"
    links = " UNION ALL ".join(
        f"SELECT url, regexp_extract(t, {i}, 1) AS link FROM (SELECT url, unnest(regexp_extract_all(coalesce(html, ''), {g})) AS t FROM pages)"
        for g, i in zip(tags, inner, strict=True)
    )
    named = "link"
    for name, char in NAMED:
        named = f"replace({named}, '{name}', '{char.replace(chr(39), chr(39) * 2)}')"
    decimal, hexed = "'^0*([0-9]{1,7});'", "'^[xX]0*([0-9a-fA-F]{1,6});'"
    code = f"""CASE WHEN regexp_matches(part, {decimal}) THEN regexp_extract(part, {decimal}, 1)::BIGINT
                    WHEN regexp_matches(part, {hexed}) THEN ('0x' || regexp_extract(part, {hexed}, 1))::BIGINT END"""
    numbered = f"""array_to_string(list_transform(string_split(link, '&#'), lambda part, i: CASE
        WHEN i > 1 AND ({code} BETWEEN 1 AND 55295 OR {code} BETWEEN 57344 AND 1114111)
          THEN chr(({code})::INT) || regexp_replace(part, '^[xX]?[0-9a-fA-F]+;', '')
        WHEN i > 1 THEN '&#' || part ELSE part END), '')"""
    root = f"regexp_extract(url, '^(.*?)://', 1) || '://' || {_sql_host('url')}"
    path = f"(CASE WHEN {_sql_path('url')} = '' THEN '/' ELSE {_sql_path('url')} END)"
    dots = """list_reduce(list_transform(string_split(p, '/'), lambda x: [x]), lambda kept, x: CASE
        WHEN x[1] = '.' THEN kept WHEN x[1] = '..' THEN kept[:greatest(len(kept) - 1, 1)] ELSE kept || x END)"""
    return f"""
WITH RECURSIVE rules(v, h, p) AS (VALUES {listed}),
links AS (SELECT url, {named} AS link FROM (SELECT url, {numbered} AS link FROM ({links}))),
joined AS (
  SELECT url, CASE WHEN starts_with(link, '//') THEN regexp_extract(url, '^(.*?)://', 1) || ':' || link
                   WHEN starts_with(link, '/') THEN {root} || link
                   WHEN regexp_matches(link, '{SCHEME}') THEN CASE WHEN regexp_matches(link, '{SCHEME}//') THEN link END
                   WHEN starts_with(link, '?') THEN {root} || {path} || link
                   WHEN link <> '' AND NOT starts_with(link, '#') THEN {root} || regexp_extract({path}, '^(.*/)', 1) || link
              END AS target FROM links WHERE contains(url, '://')),
cut AS (SELECT url, target, {_sql_path('target')} AS p FROM joined),
absolute AS (
  SELECT url, regexp_extract(target, '^(.*?://[^/?#]*)', 1)
              || array_to_string(CASE WHEN string_split(p, '/')[-1] IN ('.', '..') THEN {dots} || [''] ELSE {dots} END, '/')
              || regexp_extract(target, '^.*?://[^?#]*(.*)$', 1) AS target FROM cut WHERE target IS NOT NULL),
ends AS (SELECT {_sql_key('url')} AS u, {_sql_key('target')} AS v FROM absolute),
edges AS (SELECT u, v FROM ends WHERE u <> '' AND v <> '' AND u <> v UNION SELECT v, u FROM ends WHERE u <> '' AND v <> '' AND u <> v),
reach(a, b) AS (SELECT u, u FROM edges UNION SELECT a, v FROM reach JOIN edges ON b = u),
fits AS (
  SELECT k, max(struct_pack(l := length(h) + length(p), a := v = 'allow', rule := h || p, verdict := v)) AS f
  FROM (SELECT DISTINCT u AS k FROM edges UNION SELECT {_sql_key('url')} FROM pages) x
  JOIN rules ON (regexp_extract(k, '^[^/?#]*') = h OR suffix(regexp_extract(k, '^[^/?#]*'), '.' || h))
       AND starts_with(regexp_extract(k, '^[^/?#]*([^?#]*)', 1), p)
  GROUP BY k),
blocked AS (SELECT DISTINCT a FROM reach JOIN fits ON b = k WHERE f.verdict = 'block')
SELECT page_id,
       translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
       regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path,
       f.rule AS rule,
       coalesce(f.verdict, CASE WHEN a IS NULL THEN 'allow' ELSE 'block' END) AS verdict,
       f IS NULL AND a IS NOT NULL AS by_alias
FROM pages LEFT JOIN fits ON k = {_sql_key('url')} LEFT JOIN blocked ON a = {_sql_key('url')}
"""
