"""URL rules with redirect equivalence.

Rules name a host and a path; a rule fits its host and all subdomains where the path starts with the rule's, and the
longest that fits decides. Pages that redirect to one another, or name one another as canonical, are aliases: connected
components over these edges carry a block decision to all aliases, but an explicit allow comes first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._graph import Scratch, components, shared

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LINK = r"""(?i)<link\b[^>]*?\brel\s*=\s*["']?canonical\b[^>]*>"""
_REFRESH = r"""(?i)<meta\b[^>]*?\bhttp-equiv\s*=\s*["']?refresh\b[^>]*>"""
_HREF = r"""(?i)\bhref\s*=\s*["']?([^"'\s>]+)"""
_TARGET = r"""(?i)\burl\s*=\s*["']?([^"'\s>;]+)"""


def host_of(url: Column) -> Column:
    """From the first :// up to /, ?, # or the end, A-Z lower-cased; empty for null or without ://."""
    return F.translate(F.regexp_extract(_after(url), r"^[^/?#]*", 0), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """From the end of the host up to ?, # or the end; empty for null or without ://."""
    return F.regexp_extract(_after(url), r"^[^/?#]*([^?#]*)", 1)


def _after(url: Column) -> Column:
    url = F.coalesce(url, F.lit(""))
    return F.when(F.contains(url, F.lit("://")), F.substr(url, F.instr(url, "://") + 3, F.length(url))).otherwise(F.lit(""))


def _rule_table(spark: SparkSession, rules: list[tuple[str, str, str]] | DataFrame) -> DataFrame:
    """(rule_host, rule_path, allow), each host and path once; an allow takes a block of the same spelling away."""
    if not isinstance(rules, DataFrame):
        rules = spark.createDataFrame(rules, "host string, path string, verdict string")
    allow = F.col("verdict") == "allow"
    return rules.select(F.col("host").alias("rule_host"), F.col("path").alias("rule_path"), allow.alias("allow")).groupBy("rule_host", "rule_path").agg(F.max("allow").alias("allow"))


def longest_rules(places: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, rule, own) of the distinct (host, path) of `places` that a rule fits, with the longest such rule.

    Every host meets the rules at its own name and those of its parents, so that the number of rules does not matter; a
    host and path then meets the rules of these names at the beginnings of its path, by their lengths.
    """
    distinct = places.select("host", "path").distinct()
    labels = F.split("host", r"\.")
    names = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    lengths = rules.groupBy("rule_host").agg(F.collect_set(F.length("rule_path")).alias("lengths"))
    named = distinct.select("host", "path", F.explode(names).alias("rule_host")).join(lengths, "rule_host")
    begun = named.select("host", "path", "rule_host", F.explode("lengths").alias("k")).where(F.length("path") >= F.col("k"))
    begun = begun.withColumn("rule_path", F.substring("path", F.lit(1), F.col("k")))
    fits = begun.join(rules, ["rule_host", "rule_path"]).withColumn("rule", F.concat("rule_host", "rule_path"))
    best = F.max_by(F.struct("rule", "allow"), F.struct(F.length("rule"), "allow", "rule"))
    found = fits.groupBy("host", "path").agg(best.alias("best"))
    return found.select("host", "path", F.col("best.rule").alias("rule"), F.when(F.col("best.allow"), "allow").otherwise("block").alias("own"))


def _resolved(url: Column, target: Column) -> Column:
    """An absolute target as it is, others relative to the page's url; without fragment."""
    target = F.regexp_replace(F.replace(target, F.lit("&amp;"), F.lit("&")), r"#.*$", "")
    origin = F.regexp_extract(url, r"^[^:/?#]*://[^/?#]*", 0)
    folder = F.regexp_extract(path_of(url), r"^.*/", 0)
    return (
        F.when(F.contains(target, F.lit("://")), target)
        .when(target.startswith("//"), F.concat(F.regexp_extract(url, r"^[^:/?#]*:", 0), target))
        .when(target.startswith("/"), F.concat(origin, target))
        .when(target.startswith("?"), F.concat(origin, path_of(url), target))
        .when(target != "", F.concat(origin, F.when(folder == "", F.lit("/")).otherwise(folder), target))
    )


def page_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(source, target) addresses of the canonical link and the refresh redirect in each page's html."""
    url, html = F.col(url_col).cast("string"), F.col(html_col).cast("string")
    targets = F.array(F.regexp_extract(F.regexp_extract(html, _LINK, 0), _HREF, 1), F.regexp_extract(F.regexp_extract(html, _REFRESH, 0), _TARGET, 1))
    may = html.isNotNull() & (html.rlike(r"(?i)canonical|http-equiv"))
    found = pages.where(may & F.contains(url, F.lit("://"))).select(url.alias("u"), F.explode(F.filter(targets, lambda t: t != "")).alias("t"))
    return found.select(address(F.col("u")).alias("source"), address(_resolved(F.col("u"), F.col("t"))).alias("target")).where("target is not null and source <> target")


def address(url: Column) -> Column:
    """What two spellings of one page share: host, path and query, without scheme and fragment."""
    return F.when(F.contains(url, F.lit("://")), F.concat(host_of(url), F.regexp_extract(_after(url), r"^[^/?#]*([^#]*)", 1)))


def judge_urls(
    pages: DataFrame,
    rules: list[tuple[str, str, str]] | DataFrame,
    redirects: DataFrame | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str | None = "html",
) -> DataFrame:
    """(id, host, path, rule, verdict) of every row.

    rules: (host, path, "allow" or "block"), as a list or a table of any size. rule: the longest that fits, null without
    one; its verdict counts, and an allow before a block of the same spelling. A url without a rule takes the decision of
    its aliases: allow if an alias has an allow rule, else block if one has a block rule. Others are allowed. Aliases are
    connected by canonical links and refresh redirects in html_col (None: not read) and by `redirects` (columns source,
    target: urls). Addresses that are only targets decide too. Urls that are null or have no :// have empty host and path,
    no aliases, and no rule. Rows with one address are aliases of one another only through edges: they have the same rule
    anyhow. Repeated rows each have their row; an empty table gives none.
    """
    spark = pages.sparkSession
    table = _rule_table(spark, rules)
    url = F.col(url_col).cast("string")
    judged = pages.select(F.col(id_col).alias("id"), url.alias("url")).withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    found = longest_rules(judged, table)
    judged = judged.join(found, ["host", "path"], "left")
    verdict = F.col("own")
    edges = page_edges(pages, url_col, html_col) if html_col else None
    if redirects is not None:
        more = redirects.select(address(F.col("source").cast("string")).alias("source"), address(F.col("target").cast("string")).alias("target")).where("source <> target")
        edges = more if edges is None else edges.unionByName(more)
    if edges is not None:
        with Scratch(spark) as scratch:
            edges = scratch.stored(edges.distinct())
            names = edges.select(F.explode(F.array("source", "target")).alias("address")).distinct()
            # The numbers are unique, and fixed as the table is written.
            names = scratch.stored(names.withColumn("node", F.monotonically_increasing_id()))
            ends = edges.join(names.withColumnsRenamed({"address": "source", "node": "a"}), "source").join(names.withColumnsRenamed({"address": "target", "node": "b"}), "target")
            group = components(ends.select("a", "b"))
            target = F.concat(F.lit("x://"), F.col("address"))
            own = names.withColumn("target", target).withColumns({"host": host_of(F.col("target")), "path": path_of(F.col("target"))})
            own = scratch.stored(own.join(longest_rules(own, table), ["host", "path"], "left").select("address", "node", F.col("own").alias("said")).join(group, "node"))
            # "allow" sorts before "block".
            decided = own.groupBy("component").agg(F.min("said").alias("alias_verdict")).where("alias_verdict is not null")
            alias = shared(own.join(decided, "component").select("address", "alias_verdict"))
        judged = judged.withColumn("own_address", address(F.col("url"))).join(alias, F.col("own_address") == F.col("address"), "left")
        verdict = F.coalesce("own", "alias_verdict")
    return judged.select("id", "host", "path", "rule", F.coalesce(verdict, F.lit("allow")).alias("verdict"))
