"""URL rules, carried over redirect and canonical links to equivalent addresses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..store import written
from .components import beside, connected_components

#: (verdict, host and path).
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
#: Rules stand in the plan as literals; more than so many are refused.
MOST_RULES = 10_000

TAG = "(?is)<(?:link|meta)\\b[^>]*>"
CANONICAL = "(?is)\\brel\\s*=\\s*[\"']?canonical\\b"
HREF = "(?is)\\bhref\\s*=\\s*[\"']?([^\"'\\s>]+)"
REFRESH = "(?is)\\bhttp-equiv\\s*=\\s*[\"']?refresh\\b"
REFRESH_URL = "(?is)\\burl\\s*=\\s*[\"']?([^\"'\\s>;]+)"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def after_scheme(url: Column) -> Column:
    """What follows the first ``://``; empty for null or without one."""
    return F.coalesce(F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + F.lit(3))), F.lit(""))


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(after_scheme(url), "^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(after_scheme(url), "^[^/?#]*([^?#]*)", 1)


def key_of(url: Column) -> Column:
    """Host, path and query: the scheme and the fragment do not tell pages apart. Null without ``://``."""
    return F.when(F.instr(url, "://") > 0, F.concat(host_of(url), F.regexp_extract(after_scheme(url), "(?s)^[^/?#]*([^#]*)", 1)))


def best_rule(host: Column, path: Column, rules: tuple[tuple[str, str], ...] = RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits, by code points, the lesser text and then allow first; else null.

    A host's suffixes at its dots are looked up in a literal map, so the cost of a row does not grow with the rules.
    """
    if len(rules) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules")
    by_host: dict[str, list[tuple[str, str, str]]] = {}
    for verdict, text in rules:
        name, slash, path_start = text.partition("/")
        by_host.setdefault(name, []).append((text, slash + path_start, verdict))
    if not by_host:
        return F.lit(None).cast("struct<rule:string,verdict:string>")
    entries = []
    for name, found in by_host.items():
        ordered = sorted(found, key=lambda r: (-len(r[0]), r[0], r[2]))
        entries += [F.lit(name), F.array(*[F.struct(F.lit(a).alias("rule"), F.lit(b).alias("start"), F.lit(c).alias("verdict")) for a, b, c in ordered])]
    table = F.create_map(*entries)
    parts = F.split(host, "\\.", -1)
    suffixes = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    fits = F.filter(
        F.flatten(F.filter(F.transform(suffixes, lambda s: F.try_element_at(table, s)), lambda x: x.isNotNull())),
        lambda r: F.startswith(path, r["start"]),
    )
    ordered = F.array_sort(F.transform(fits, lambda r: F.struct((-F.length(r["rule"])).alias("n"), r["rule"].alias("rule"), r["verdict"].alias("verdict"))))
    first = F.try_element_at(ordered, F.lit(1))
    return F.when(first.isNotNull(), F.struct(first["rule"].alias("rule"), first["verdict"].alias("verdict")))


def page_links(pages: DataFrame) -> DataFrame:
    """(source, target): keys of pages and of the addresses that their canonical links and refreshes name.

    An address may be absolute, begin with ``//`` or ``/``, or be relative to the page's folder. Pages whose url is null
    or has no ``://`` have no key and no links.
    """
    marked = pages.where(F.col("url").contains("://") & F.col("html").rlike("(?i)canonical|refresh")).select("url", F.explode(F.regexp_extract_all("html", F.lit(TAG), F.lit(0))).alias("tag"))
    link = F.when(F.col("tag").rlike(CANONICAL), F.regexp_extract("tag", HREF, 1)).when(F.col("tag").rlike(REFRESH), F.regexp_extract("tag", REFRESH_URL, 1))
    host = F.concat(F.lit("x://"), host_of(F.col("url")))
    whole = (
        F.when(F.col("link").contains("://"), F.col("link"))
        .when(F.startswith(F.col("link"), F.lit("//")), F.concat(F.lit("x:"), F.col("link")))
        .when(F.startswith(F.col("link"), F.lit("/")), F.concat(host, F.col("link")))
        .otherwise(F.concat(host, F.coalesce(F.nullif(F.regexp_extract(path_of(F.col("url")), "^(.*/)", 1), F.lit("")), F.lit("/")), F.col("link")))
    )
    found = marked.withColumn("link", link).where("link <> ''")
    return found.select(key_of(F.col("url")).alias("source"), key_of(whole).alias("target")).where("source <> target")


def filter_urls(pages: DataFrame, rules: tuple[tuple[str, str], ...] = RULES, links: DataFrame | None = None, default: str = "allow") -> DataFrame:
    """(page_id, host, path, rule, verdict) for each row of ``pages`` (page_id, url, html).

    A rule that fits decides. Otherwise the addresses linked with the page's, directly or over others, decide: if a rule
    allows any of them the page is allowed, else if a rule blocks any it is blocked, else ``default``. ``links`` (source,
    target: urls) adds known redirects to those the pages name. Null urls have an empty host and path, fit no rule and take
    the default. Repeated rows are judged alike; very long urls and pages are read whole; an empty table gives no rows; other
    columns are not read. A group of addresses, and a page that many rows repeat, is dealt over several tasks.
    """
    judged = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")).withColumn("best", best_rule(F.col("host"), F.col("path"), rules))
    edges = page_links(pages)
    if links is not None:
        edges = edges.unionByName(links.select(key_of(F.col("source")).alias("source"), key_of(F.col("target")).alias("target")).where("source <> target"))
    edges = written(edges.distinct(), "url-links")
    same = written(connected_components(edges.select(F.col("source").alias("u"), F.col("target").alias("v"))), "url-groups")
    address = F.concat(F.lit("x://"), F.col("node"))
    explicit = same.withColumn("says", best_rule(host_of(address), path_of(address), rules)["verdict"])
    by_group = explicit.groupBy("component").agg(F.bool_or(F.col("says") == "allow").alias("allows"), F.bool_or(F.col("says") == "block").alias("blocks"))
    decided = by_group.select("component", F.when(F.col("allows"), "allow").when(F.col("blocks"), "block").alias("passed")).where("passed IS NOT NULL")
    passed = written(beside(same, decided, "component", "node").select(F.col("node").alias("key"), "passed"), "url-verdicts")
    joined = judged.withColumn("key", key_of(F.col("url"))).join(passed, "key", "left")
    return joined.select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce(F.col("best.verdict"), F.col("passed"), F.lit(default)).alias("verdict"))


ORACLE = r"""
WITH RECURSIVE parts AS (
  SELECT page_id, url, html, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages),
addresses AS (
  SELECT *, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, regexp_extract(rest, '(?s)^[^/?#]*([^#]*)', 1) AS tail FROM parts),
tags AS (
  SELECT host, path, host || tail AS source, unnest(regexp_extract_all(html, '(?is)<(?:link|meta)\b[^>]*>')) AS tag FROM addresses WHERE position('://' IN url) > 0),
named AS (
  SELECT host, path, source, CASE WHEN regexp_matches(tag, '(?is)\brel\s*=\s*["'']?canonical\b') THEN regexp_extract(tag, '(?is)\bhref\s*=\s*["'']?([^"''\s>]+)', 1)
    WHEN regexp_matches(tag, '(?is)\bhttp-equiv\s*=\s*["'']?refresh\b') THEN regexp_extract(tag, '(?is)\burl\s*=\s*["'']?([^"''\s>;]+)', 1) END AS link FROM tags),
resolved AS (
  SELECT source, CASE WHEN position('://' IN link) > 0 THEN substr(link, position('://' IN link) + 3) WHEN starts_with(link, '//') THEN substr(link, 3)
    WHEN starts_with(link, '/') THEN host || link ELSE host || coalesce(nullif(regexp_extract(path, '^(.*/)', 1), ''), '/') || link END AS rest FROM named WHERE link <> ''),
links AS (
  SELECT source, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') || regexp_extract(rest, '(?s)^[^/?#]*([^#]*)', 1) AS target FROM resolved),
both_ways AS (SELECT source AS a, target AS b FROM links UNION SELECT target, source FROM links),
reach(a, b) AS (SELECT a, a FROM both_ways UNION SELECT r.a, e.b FROM reach r JOIN both_ways e ON r.b = e.a),
rules(verdict, rule, rhost, rpath) AS (VALUES ('block', 'net/', 'net', '/'), ('allow', 'example.net/en/', 'example.net', '/en/'), ('block', 'example.com/de/', 'example.com', '/de/'), ('allow', 'org/fr/', 'org', '/fr/')),
keys AS (SELECT DISTINCT b AS node FROM reach),
node_rules AS (
  SELECT node, arg_max(verdict, length(rule)) AS says FROM keys, rules
  WHERE (regexp_extract(node, '^[^/?#]*') = rhost OR ends_with(regexp_extract(node, '^[^/?#]*'), '.' || rhost)) AND starts_with(regexp_extract(node, '^[^/?#]*([^?#]*)', 1), rpath) GROUP BY node),
passed AS (
  SELECT a AS node, CASE WHEN bool_or(says = 'allow') THEN 'allow' WHEN bool_or(says = 'block') THEN 'block' END AS passed FROM reach LEFT JOIN node_rules ON b = node GROUP BY a),
page_rules AS (
  SELECT host, path, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict FROM (SELECT DISTINCT host, path FROM addresses), rules
  WHERE (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY host, path)
SELECT p.page_id, p.host, p.path, r.rule, coalesce(r.verdict, q.passed, 'allow') AS verdict
FROM addresses p LEFT JOIN page_rules r ON p.host = r.host AND p.path = r.path
LEFT JOIN passed q ON position('://' IN p.url) > 0 AND q.node = p.host || p.tail
"""
