"""URL filter with redirect equivalence.

A url is judged by the longest rule (host, path) that fits: the rule's host or one of
its subdomains, and a path that starts with the rule's.  Urls without a rule take the
decision of their aliases: pages are linked by the redirects (``meta refresh``) and
canonical links in their html, and by further edges if given; distributed connected
components over those edges carry decisions from ruled urls to the others.  An explicit
allow takes precedence: an allowed url stays allowed whatever its aliases, and a
component with an allowed url is not blocked.  Without any decision: allow.

A node is the url without scheme and fragment, with lower-case host and at least ``/``
as path, so it may be a url that was not crawled; such nodes are judged by rules too.

Defined results: a null url, or one without ``://``, has empty host and path, fits no
rule, links to nothing and is allowed; null or empty html has no links; repeated rows
each get their verdict; links are relative to the page's ``base`` element, if any, with dot
segments removed; a link without a target, or to another scheme (``mailto:``), is ignored; of a host and path with two rules, allow wins; an empty table gives an empty
result; further columns are not looked at.
"""

from __future__ import annotations

import html as html_module
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from flowframe.llm.common import stored
from flowframe.llm.components import connected_components

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Spread of a rule's host over join keys: one host may hold a third of all urls.
SALTS = 16

#: The rules of the query: (rule, verdict).
RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"),
         ("com/fr/", "allow"), ("com/de/", "block")]


def _after(url: Column) -> Column:
    return F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.char_length(url)))


def host_of(url: Column) -> Column:
    """Between the first ``://`` and ``/``, ``?``, ``#`` or the end; A-Z in lower case."""
    return F.coalesce(F.translate(F.regexp_extract(_after(url), r"^[^/?#]*", 0), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(_after(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def node_of(url: Column) -> Column:
    """The url's identity among aliases; null if it has no host."""
    path = F.when(path_of(url) == "", F.lit("/")).otherwise(path_of(url))
    query = F.regexp_extract(_after(url), r"^[^?#]*(\?[^#]*)", 1)
    return F.when(host_of(url) != "", F.concat(host_of(url), path, query))


def rules_table(spark: SparkSession, rules: list[tuple[str, str]]) -> DataFrame:
    """(rule, rule_host, rule_path, verdict) from ``host/path`` texts."""
    rows = spark.createDataFrame(rules, "rule string, verdict string")
    return rows.select("rule", F.translate(F.substring_index("rule", "/", 1), UPPER, LOWER).alias("rule_host"),
                       F.expr("substring(rule, char_length(substring_index(rule, '/', 1)) + 1)").alias("rule_path"), "verdict")


def judge(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, rule, verdict) of the distinct (host, path) of ``urls`` that a rule fits.

    The join is on equal keys only: each host suffix, and the prefixes of the path that
    are as long as some rule of that suffix.
    """
    own = urls.select("host", "path").distinct()
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    salt = F.pmod(F.xxhash64("host", "path"), F.lit(SALTS)).cast("int")
    keyed = own.where(F.col("host") != "").select("host", "path", F.explode(suffixes).alias("rule_host"), salt.alias("salt"))
    lengths = rules.groupBy("rule_host").agg(F.collect_set(F.char_length("rule_path")).alias("lengths"))
    lengths = lengths.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    cut = keyed.join(lengths, ["rule_host", "salt"]).withColumn("n", F.explode("lengths")).where(F.col("n") <= F.char_length("path"))
    cut = cut.withColumn("rule_path", F.expr("substring(path, 1, n)")).drop("lengths", "n")
    salted = rules.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    fits = cut.join(salted, ["rule_host", "rule_path", "salt"])
    rank = F.struct(F.char_length("rule").alias("n"), (F.col("verdict") == "allow").alias("allow"), "rule", "verdict")
    return fits.groupBy("host", "path").agg(F.max(rank).alias("best")).select("host", "path", "best.rule", "best.verdict")


@F.pandas_udf(StringType())
def unescaped(text: pd.Series) -> pd.Series:
    """Texts with their character references decoded."""
    return text.map(lambda t: html_module.unescape(t) if t and "&" in t else t).astype(object)


def _attribute(tag: Column, name: str) -> Column:
    """The value of an attribute as written, without quotes."""
    value = F.regexp_extract(tag, rf"(?is)\s{name}\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", 1)
    return F.trim(F.regexp_replace(value, r"^[\"']|[\"']$", ""))


def _computed(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with ``columns`` computed once: later expressions refer to their values,
    where a plain projection would be merged into them and evaluated again and again."""
    row = F.explode(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))).alias("computed")
    return df.select("*", row).select(*df.columns, "computed.*")


@F.pandas_udf(StringType())
def resolve(url: pd.Series, base: pd.Series, href: pd.Series) -> pd.Series:
    """Each href as an absolute http url, null if it names none: relative to the page's ``base``
    element, if any, itself relative to the page's url; dot segments are removed (RFC 3986)."""
    def one(page: str | None, around: str | None, link: str | None) -> str | None:
        if not page or link is None or "://" not in page:
            return None
        try:
            found = urljoin(urljoin(page, around) if around else page, link)
        except ValueError:  # brackets that hold no address
            return None
        return found if found[:7].lower() == "http://" or found[:8].lower() == "https://" else None

    return pd.Series([one(*x) for x in zip(url, base, href)], dtype=object)


def links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Edges (a, b) between nodes from redirects and canonical links in the html."""
    page = pages.select(F.col(f"`{url}`").alias("url"), F.col(f"`{html}`").alias("html"))
    tags = F.regexp_extract_all("html", F.lit(r"(?is)<(?:link|meta)\b[^>]*>"), 0)
    tag = F.col("tag")
    base = _attribute(F.regexp_extract("html", r"(?is)<base\b[^>]*\shref\b[^>]*>", 0), "href")
    found = page.where(F.col("html").rlike(r"(?i)canonical|refresh")).select("url", base.alias("base"), F.explode(tags).alias("tag"))
    found = _computed(found, is_link=tag.rlike(r"(?is)^<link\b"), rel=F.lower(_attribute(tag, "rel")), to=_attribute(tag, "href"),
                      equiv=F.lower(_attribute(tag, "http-equiv")), content=_attribute(tag, "content"))
    canonical = F.when(F.col("is_link") & F.array_contains(F.split("rel", r"\s+"), "canonical"), F.col("to"))
    later = F.regexp_extract(unescaped("content"), r"(?is)^\s*[0-9.]*\s*[;,]\s*(?:url\s*=\s*)?[\"']?([^\"']*)", 1)
    redirect = F.when(~F.col("is_link") & (F.col("equiv") == "refresh"), F.trim(later))
    found = found.select("url", "base", F.nullif(F.coalesce(unescaped(canonical), redirect), F.lit("")).alias("href")).where("href is not null")
    target = found.select("url", resolve("url", unescaped("base"), "href").alias("target"))
    edges = _computed(target, a=node_of(F.col("url")), b=node_of(F.col("target"))).select("a", "b")
    return edges.where("a is not null and b is not null and a <> b").distinct()


def filter_urls(pages: DataFrame, rules: DataFrame, page_id: str = "page_id", url: str = "url",
                html: str = "html", more_edges: DataFrame | None = None) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row of ``pages``.

    ``more_edges`` (a, b) holds further urls that are aliases, such as logged redirects.
    """
    edges = links(pages, url, html)
    if more_edges is not None:
        edges = edges.unionByName(more_edges.select(node_of(F.col("a")).alias("a"), node_of(F.col("b")).alias("b")))
    roots = stored(connected_components(edges))
    named = pages.select(F.col(f"`{page_id}`").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"))
    own = _computed(named, host=host_of(F.col("url")), path=path_of(F.col("url")), node=node_of(F.col("url"))).drop("url")
    node_host = F.regexp_extract("node", r"^[^/]*", 0)
    node_path = F.regexp_extract("node", r"^[^/]*([^?]*)", 1)
    aliases = roots.select("node", "root", node_host.alias("host"), node_path.alias("path"))
    judged = stored(judge(own.select("host", "path").unionByName(aliases.select("host", "path")), rules))
    # a component's decision: its explicit allow before any block
    decided = (aliases.join(judged, ["host", "path"]).groupBy("root")
               .agg(F.min("verdict").alias("passed_on")))  # "allow" < "block"
    passed = aliases.join(decided, "root").select("node", "passed_on")
    out = own.join(judged, ["host", "path"], "left").join(passed, "node", "left")
    return out.select("page_id", "host", "path", "rule", F.coalesce("verdict", "passed_on", F.lit("allow")).alias("verdict"))


ORACLE = r"""
WITH RECURSIVE rules(rule, rh, rp, v) AS (VALUES
  ('org/', 'org', '/', 'allow'), ('example.org/es/', 'example.org', '/es/', 'block'),
  ('example.org/en/1', 'example.org', '/en/1', 'block'), ('com/fr/', 'com', '/fr/', 'allow'),
  ('com/de/', 'com', '/de/', 'block')),
cut AS (
  SELECT page_id, url, html, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
own AS (
  SELECT page_id, url, html,
    coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path,
    coalesce(regexp_extract(rest, '^[^?#]*(\?[^#]*)', 1), '') AS query FROM cut),
noded AS (SELECT *, host || CASE WHEN path = '' THEN '/' ELSE path END || query AS node FROM own),
tags AS (SELECT url, host, node, unnest(regexp_extract_all(html, '(?is)<(?:link|meta)\b[^>]*>')) AS tag FROM noded WHERE host <> ''),
hrefs AS (
  SELECT url, host, node, trim(CASE
    WHEN regexp_matches(tag, '(?is)^<link\b.*\srel\s*=\s*["'']?canonical\b') THEN regexp_extract(tag, '(?is)\shref\s*=\s*["'']?([^"''\s>]*)', 1)
    WHEN regexp_matches(tag, '(?is)^<meta\b.*\shttp-equiv\s*=\s*["'']?refresh\b') THEN regexp_extract(tag, '(?is)url\s*=\s*["'']?([^"''\s>]*)', 1)
    ELSE '' END) AS href FROM tags),
targets AS (
  SELECT node, CASE WHEN regexp_matches(href, '(?i)^https?://') THEN substr(href, strpos(href, '://') + 3)
    WHEN href LIKE '//%' THEN substr(href, 3) WHEN href LIKE '/%' THEN host || href END AS rest FROM hrefs WHERE href <> ''),
edges AS (
  SELECT node AS a, lower(regexp_extract(rest, '^[^/?#]*')) ||
    CASE WHEN regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) = '' THEN '/' ELSE regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) END ||
    regexp_extract(rest, '^[^?#]*(\?[^#]*)', 1) AS b FROM targets WHERE rest IS NOT NULL),
both_ways AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges),
reach AS (
  SELECT a AS node, a AS seen FROM both_ways
  UNION SELECT r.node, e.b FROM reach r JOIN both_ways e ON r.seen = e.a),
fitted AS (
  SELECT host, path, arg_max(rule, length(rule)) AS rule, arg_max(v, length(rule)) AS v
  FROM (SELECT host, path FROM own UNION SELECT regexp_extract(seen, '^[^/]*'), regexp_extract(seen, '^[^/]*([^?]*)', 1) FROM reach)
  JOIN rules ON (host = rh OR host LIKE '%.' || rh) AND starts_with(path, rp) GROUP BY host, path),
passed AS (
  SELECT r.node, min(f.v) AS v FROM reach r JOIN fitted f
    ON f.host = regexp_extract(r.seen, '^[^/]*') AND f.path = regexp_extract(r.seen, '^[^/]*([^?]*)', 1) GROUP BY r.node)
SELECT o.page_id, o.host, o.path, f.rule, coalesce(f.v, p.v, 'allow') AS verdict
FROM noded o LEFT JOIN fitted f ON o.host = f.host AND o.path = f.path LEFT JOIN passed p ON o.node = p.node AND o.host <> ''
"""
