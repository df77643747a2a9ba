"""URL rules with redirect equivalence, in DataFrame functions alone.

Pages that redirect to each other or name a common canonical address are one resource under several addresses. The
rules judge what they fit; connected components over the alias edges carry block decisions to the other addresses."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framelake.llm.common import connected, unused, written
from framelake.llm.quality import bound_to

#: (verdict, host, path). A rule fits its host and all subdomains where the path starts with the rule's path.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))

_CANONICAL = r"(?i)<link\b(?=[^>]*\brel\s*=\s*[\"']?canonical\b)[^>]*?\bhref\s*=\s*[\"']?([^\"'\s>]+)"
_BASE = r"(?i)<base\b[^>]*?\bhref\s*=\s*[\"']?([^\"'\s>]+)"
_REFRESH = r"(?i)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b)[^>]*?\burl\s*=\s*[\"']?([^\"'\s>]+)"


def host_of(url: Column) -> Column:
    """What follows the first :// up to /, ?, # or the end, A-Z lower-cased; '' for null or without ://."""
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, F.translate(F.regexp_extract(F.substr(url, at + 3), "^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase)), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ?, # or the end; '' for null or without ://."""
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, F.regexp_extract(F.substr(url, at + 3), "^[^/?#]*([^?#]*)", 1)), F.lit(""))


def rule_for(host: Column, path: Column, rules=RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits (ties: the first named), or null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def node_of(url: Column) -> Column:
    """The address an alias edge names: the url without its fragment, scheme and host lower-cased; null without ://."""
    at = F.instr(url, "://")
    rest = F.substr(url, at + 3)
    return F.when(at > 0, F.concat(F.lower(F.substr(url, F.lit(1), at - 1)), F.lit("://"), host_of(url), F.regexp_extract(rest, "^[^/?#]*([^#]*)", 1)))


def _without_dots(path: Column) -> Column:
    """A path that starts with / without its segments . and .. (RFC 3986, 5.2.4)."""
    none = F.array().cast("array<string>")

    def joined(parts: Column, kept: Column) -> Column:
        folder = F.element_at(parts, -1).isin(".", "..") & (F.size(kept) > 0)
        return F.concat(F.lit("/"), F.array_join(kept, "/"), F.when(folder, F.lit("/")).otherwise(F.lit("")))

    def walked(parts: Column) -> Column:
        kept = F.aggregate(
            parts, none, lambda acc, x: F.when(x == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0)))).when(x == ".", acc).otherwise(F.concat(acc, F.array(x)))
        )
        return bound_to(kept, lambda k: joined(parts, k))

    return F.when(path.contains("/."), bound_to(F.split(F.substr(path, F.lit(2)), "/", -1), walked)).otherwise(path)


def resolved(to: Column, base: Column, path: Column) -> Column:
    """The address that a target names on a page of that base (scheme://host) and path; its fragment is dropped. Null for
    an empty target. Addresses with a scheme or host are taken as they are."""

    def made(to: Column) -> Column:
        place, query = F.regexp_extract(to, r"^[^?]*", 0), F.regexp_extract(to, r"\?.*$", 0)
        folder = F.coalesce(F.nullif(F.regexp_extract(path, "^.*/", 0), F.lit("")), F.lit("/"))
        return (
            F.when(to == "", F.lit(None).cast("string"))
            .when(to.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), to)
            .when(to.startswith("//"), F.concat(F.regexp_extract(base, "^[^:]*:", 0), to))
            .when(to.startswith("?"), F.concat(base, path, query))
            .when(to.startswith("/"), F.concat(base, bound_to(place, _without_dots), query))
            .otherwise(F.concat(base, bound_to(F.concat(folder, place), _without_dots), query))
        )

    return bound_to(F.regexp_replace(to, "#.*$", ""), made)


def decoded(value: Column) -> Column:
    """An attribute's value with its character references replaced: numbers up to U+FFFF, and amp, lt, gt, quot and apos. Each is read once: what a reference gives begins no other."""
    numbers = F.array_distinct(F.regexp_extract_all(value, F.lit("&#([xX][0-9a-fA-F]{1,4}|[0-9]{1,5});"), F.lit(1)))

    def put(text: Column, n: Column) -> Column:
        code = F.when(n.startswith("x") | n.startswith("X"), F.conv(F.substr(n, F.lit(2)), 16, 10)).otherwise(n).cast("int")
        char = F.decode(F.unhex(F.lpad(F.hex(code), 4, "0")), "UTF-16BE")
        # An ampersand is left for the last step, which replaces no other one.
        return F.when(code > 0xFFFF, text).otherwise(F.replace(text, F.concat(F.lit("&#"), n, F.lit(";")), F.when(code == 38, F.lit("&amp;")).otherwise(char)))

    plain = F.aggregate(numbers, value, put)
    for name, char in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("apos", "'"), ("amp", "&")):
        plain = F.replace(plain, F.lit(f"&{name};"), F.lit(char))
    return plain


def _place(url: Column) -> tuple[Column, Column]:
    """(scheme://host, path) of an address."""
    return F.concat(F.regexp_extract(url, "^[^:]*://", 0), host_of(url)), path_of(url)


def alias_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(src, dst) from all canonical links and meta refreshes of a page, character references in them replaced. Relative targets are resolved against
    the page's first base element, if it has one, itself resolved against the page's url, else against the url. A null url or html gives none."""
    targets = F.concat(*(F.regexp_extract_all(html, F.lit(p), F.lit(1)) for p in (_CANONICAL, _REFRESH)))

    def named(own: Column) -> Column:
        """The addresses of all targets on a page whose base is own."""
        place = F.struct(*(c.alias(n) for c, n in zip(_place(own), ("base", "path"), strict=True)))
        return bound_to(place, lambda p: F.transform(targets, lambda t: bound_to(resolved(decoded(t), p["base"], p["path"]), node_of)))

    def page(u: Column) -> Column:
        place = F.struct(*(c.alias(n) for c, n in zip(_place(u), ("base", "path"), strict=True)))
        own = bound_to(place, lambda p: F.coalesce(resolved(decoded(F.regexp_extract(html, _BASE, 1)), p["base"], p["path"]), u))
        return bound_to(own, named)

    # Each step is evaluated once a page; the addresses are told apart only once they are rows.
    some = pages.where(F.col(html).rlike("(?i)canonical|http-equiv") & F.col(url).contains("://"))
    found = some.select(node_of(F.col(url)).alias("src"), F.explode(bound_to(F.col(url), page)).alias("dst"))
    return found.where("src IS NOT NULL AND dst IS NOT NULL AND src != dst").distinct()


def judge(pages: DataFrame, edges: DataFrame, url: str = "url", rules=RULES) -> DataFrame:
    """pages with host, path, rule, verdict.

    An address's own rule decides. Otherwise it is blocked if its component (over edges (src, dst)) holds an address
    that a rule blocks, else allowed: an explicit allow shields the addresses it fits, and only those, from a block
    that reaches them over aliases. Null urls, and those without ://, have no rule and no alias: allow. Repeated urls get equal verdicts.
    Other columns stay; one that has the name of a result is replaced."""
    rule_of = rule_for(F.col("host"), F.col("path"), rules)
    own, node, alias = (unused(n, [*pages.columns, "host", "path", "rule", "verdict"]) for n in ("_own", "_node", "_alias"))
    judged = pages.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))}).withColumn(own, rule_of).withColumn(node, node_of(F.col(url)))
    parts = written(connected(edges, "src", "dst", "url-alias"), "url-parts")
    nodes = parts.withColumns({"host": host_of(F.col("node")), "path": path_of(F.col("node"))})
    blocked = nodes.where(rule_of["verdict"] == "block").select("component").distinct()
    tainted = written(parts.join(blocked, "component").select(F.col("node").alias(node), F.lit(True).alias(alias)).distinct(), "url-tainted")
    # Pages that a rule judges, and those that no alias can reach, don't meet the aliases: so no one key holds all pages without an address.
    open_ = F.col(own).isNull() & F.col(node).isNotNull()
    told = judged.where(open_).join(tainted, node, "left").unionByName(judged.where(~open_).withColumn(alias, F.lit(None).cast("boolean")))
    return told.withColumns({"rule": F.col(own)["rule"], "verdict": F.coalesce(F.col(own)["verdict"], F.when(F.col(alias), F.lit("block")), F.lit("allow"))}).drop(own, node, alias)


def query(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return judge(pages.select("page_id", "url"), alias_edges(pages)).select("page_id", "host", "path", "rule", "verdict")


def _rule_sql() -> str:
    cases = "".join(
        f" WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{v} {h}{p}'" for v, h, p in sorted(RULES, key=lambda r: -len(r[1] + r[2]))
    )
    return f"CASE{cases} END"


_HOST = "CASE WHEN instr({0}, '://') > 0 THEN translate(regexp_extract(substr({0}, instr({0}, '://') + 3), '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END"
_PATH = "CASE WHEN instr({0}, '://') > 0 THEN regexp_extract(substr({0}, instr({0}, '://') + 3), '^[^/?#]*([^?#]*)', 1) ELSE '' END"
_NODE = "CASE WHEN instr({0}, '://') > 0 THEN lower(substr({0}, 1, instr({0}, '://') - 1)) || '://' || " + _HOST + " || regexp_extract(substr({0}, instr({0}, '://') + 3), '^[^/?#]*([^#]*)', 1) END"
# A target t on a page whose place is base (scheme://host) and path at: as resolved() has it.
_PARTS = "string_split(substr({0}, 2), '/')"
_UNDOTTED = (
    "'/' || array_to_string(list_reduce(list_concat([[]::VARCHAR[]], list_transform({p}, lambda s: [s])), lambda a, s: CASE WHEN s[1] = '..' THEN a[1:greatest(len(a) - 1, 0)] WHEN s[1] = '.' THEN a ELSE list_concat(a, s) END), '/')"
    " || CASE WHEN {p}[-1] IN ('.', '..') AND len(list_reduce(list_concat([[]::VARCHAR[]], list_transform({p}, lambda s: [s])), lambda a, s: CASE WHEN s[1] = '..' THEN a[1:greatest(len(a) - 1, 0)] WHEN s[1] = '.' THEN a ELSE list_concat(a, s) END)) > 0 THEN '/' ELSE '' END"
)
_CUT = "regexp_replace({t}, '#.*$', '')"


def _resolved_sql(t: str, base: str, at: str) -> str:
    t = _CUT.format(t=t)
    place, query = f"regexp_extract({t}, '^[^?]*')", f"regexp_extract({t}, '[?].*$')"
    folder = f"coalesce(nullif(regexp_extract({at}, '^.*/'), ''), '/')"
    undotted = lambda x: _UNDOTTED.format(p=_PARTS.format(f"({x})"))
    return f"""CASE WHEN {t} = '' THEN NULL WHEN regexp_matches({t}, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN {t} WHEN starts_with({t}, '//') THEN regexp_extract({base}, '^[^:]*:') || {t}
      WHEN {place} = '' THEN {base} || {at} || {query} WHEN starts_with({t}, '/') THEN {base} || {undotted(place)} || {query} ELSE {base} || {undotted(folder + " || " + place)} || {query} END"""


def _decoded_sql(v: str) -> str:
    """Character references replaced as decoded() does it."""
    code = "CASE WHEN lower(n[1]) = 'x' THEN CAST('0x' || n[2:] AS INT) ELSE CAST(n AS INT) END"
    numbers = f"list_distinct(regexp_extract_all({v}, '&#([xX][0-9a-fA-F]{{1,4}}|[0-9]{{1,5}});', 1))"
    out = f"list_reduce(list_concat([{v}], {numbers}), lambda s, n: CASE WHEN {code} > 65535 THEN s ELSE replace(s, '&#' || n || ';', CASE WHEN {code} = 38 THEN '&amp;' ELSE chr({code}) END) END)"
    for name, char in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("apos", "''"), ("amp", "&")):
        out = f"replace({out}, '&{name};', '{char}')"
    return out


_SCHEME = "regexp_extract({0}, '^[^:]*://') || " + _HOST
SQL = rf"""
WITH RECURSIVE p AS (SELECT page_id, {_HOST.format("url")} AS host, {_PATH.format("url")} AS path, {_NODE.format("url")} AS node, url, html FROM pages),
tags AS (SELECT url, node, regexp_extract(html, '(?i)<base\b[^>]*?\bhref\s*=\s*["'']?([^"''\s>]+)', 1) AS b,
    unnest(list_concat(list_transform(list_filter(regexp_extract_all(html, '(?i)<link\b[^>]*'), lambda x: regexp_matches(x, '(?i)\brel\s*=\s*["'']?canonical\b')), lambda x: regexp_extract(x, '(?i)\bhref\s*=\s*["'']?([^"''\s>]+)', 1)),
      list_transform(list_filter(regexp_extract_all(html, '(?i)<meta\b[^>]*'), lambda x: regexp_matches(x, '(?i)\bhttp-equiv\s*=\s*["'']?refresh\b')), lambda x: regexp_extract(x, '(?i)\burl\s*=\s*["'']?([^"''\s>]+)', 1)))) AS t FROM p),
raw AS (SELECT url, node, {_decoded_sql("b")} AS b, {_decoded_sql("t")} AS t FROM tags WHERE t <> ''),
own AS (SELECT node, t, coalesce({_resolved_sql("b", "(" + _SCHEME.format("url") + ")", "(" + _PATH.format("url") + ")")}, url) AS f FROM raw),
tgt AS (SELECT node AS src, {_resolved_sql("t", "base", "pt")} AS t FROM (SELECT node, t, {_SCHEME.format("f")} AS base, {_PATH.format("f")} AS pt FROM own) o),
e0 AS (SELECT DISTINCT src, {_NODE.format("t")} AS dst FROM tgt WHERE src IS NOT NULL),
e AS (SELECT src, dst FROM e0 WHERE dst IS NOT NULL AND src <> dst UNION SELECT dst, src FROM e0 WHERE dst IS NOT NULL AND src <> dst),
n AS (SELECT node, {_HOST.format("node")} AS host, {_PATH.format("node")} AS path FROM (SELECT DISTINCT src AS node FROM e)),
bad AS (SELECT node FROM n WHERE starts_with({_rule_sql()}, 'block')
        UNION SELECT e.dst FROM bad JOIN e ON e.src = bad.node),
j AS (SELECT page_id, host, path, node, {_rule_sql()} AS own FROM p)
SELECT page_id, host, path, split_part(own, ' ', 2) AS rule,
       CASE WHEN own IS NOT NULL THEN split_part(own, ' ', 1) WHEN node IN (SELECT node FROM bad) THEN 'block' ELSE 'allow' END AS verdict FROM j
"""
