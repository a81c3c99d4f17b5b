"""URL rules, carried over to aliases: pages that redirect to, or name as canonical, one another.

Rules are (action, host, path). A rule fits its host and all subdomains of it
where the url's path starts with the rule's; the longest fitting rule decides.
A url without a fitting rule takes its decision from its aliases: the connected
component over redirect and canonical links that it belongs to. If a url in it
is explicitly allowed, it is allowed; else if one is explicitly blocked, it is
blocked; else allowed.

A node of that graph is a url without scheme, fragment, tracking parameters and
closing slash. Edges come from ``<link rel=canonical>`` and ``<meta
http-equiv=refresh>`` of a page, and from a table of redirects, if one is given.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from coldshelf.llm.components import components
from coldshelf.llm.shared import written

Rule = tuple[str, str, str]

RULES: tuple[Rule, ...] = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)([^#]*)"
#: Query parameters that say where a visitor came from, not what is shown.
_TRACKING = r"[?&](?:utm_[^&]*|gclid=[^&]*|fbclid=[^&]*)"
_TAG = r"(?is)<(?:link|meta)\b[^>]*>"


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def node_of(url: Column) -> Column:
    """The url as a node of the alias graph; null where it has no host."""
    query = F.regexp_replace(F.regexp_extract(url, _PARTS, 3), _TRACKING, "")
    whole = F.concat(host_of(url), F.regexp_replace(path_of(url), "/+$", ""), F.regexp_replace(query, "^&", "?"))
    return F.when(host_of(url) != "", whole)


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...], part: str = "rule") -> Column:
    """The longest fitting rule as text (``part="rule"``) or its action (``part="action"``); null without one."""
    found = F.lit(None).cast("string")
    for action, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        found = F.when(fits, action if part == "action" else rule_host + rule_path).otherwise(found)
    return found


def _absolute(url: Column, link: Column) -> Column:
    """``link``, found on the page ``url``, with scheme and host."""
    return (
        F.when(link.rlike("(?i)^[a-z][a-z0-9+.-]*://"), link)
        .when(link.startswith("//"), F.concat(F.lit("http:"), link))
        .when(link.startswith("/"), F.concat(F.lit("http://"), host_of(url), link))
        .when(link != "", F.concat(F.lit("http://"), host_of(url), F.regexp_replace(path_of(url), "[^/]*$", ""), link))
    )


def page_links(pages: DataFrame) -> DataFrame:
    """``(from_url, to_url)`` of canonical links and redirects that stand in ``pages(url, html)``."""
    tags = pages.where(F.col("html").rlike(r"(?i)\bcanonical\b|\bhttp-equiv\b")).select(
        "url", F.explode(F.regexp_extract_all("html", F.lit(_TAG), F.lit(0))).alias("tag")
    )
    canonical = F.col("tag").rlike(r"(?is)^<link\b.*\brel\s*=\s*[\"']?canonical\b")
    refresh = F.col("tag").rlike(r"(?is)^<meta\b.*\bhttp-equiv\s*=\s*[\"']?refresh\b")
    href = F.regexp_extract("tag", r"(?is)\bhref\s*=\s*[\"']?\s*([^\"'\s>]+)", 1)
    target = F.regexp_extract("tag", r"(?is)\burl\s*=\s*[\"']?\s*([^\"'\s>]+)", 1)
    link = F.when(canonical, href).when(refresh, target)
    return tags.select(F.col("url").alias("from_url"), _absolute(F.col("url"), link).alias("to_url")).where(
        F.col("to_url").isNotNull()
    )


def alias_verdicts(spark: SparkSession, links: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """``(node, aliased)``: the decision that the component of each linked url has, where it has one."""
    ends = links.select(node_of(F.col("from_url")).alias("a"), node_of(F.col("to_url")).alias("b"))
    ends = written(spark, ends.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").distinct(), "alias-links")
    groups = written(spark, components(spark, ends), "alias-groups")
    # A node begins with its host; its path gets back a closing slash, so that a rule of a folder fits the folder.
    host, rest = F.regexp_extract("node", "^[^/?]*", 0), F.regexp_extract("node", "^[^/?]*([^?]*)", 1)
    action = rule_of(host, F.concat(rest, F.lit("/")), rules, "action")
    verdict = F.when(F.max(action == "allow"), "allow").when(F.max(action == "block"), "block")
    of_group = groups.groupBy("component").agg(verdict.alias("aliased")).where("aliased IS NOT NULL")
    return groups.join(of_group, "component").select("node", "aliased")


def judge(
    spark: SparkSession, pages: DataFrame, rules: tuple[Rule, ...] = RULES, redirects: DataFrame | None = None
) -> DataFrame:
    """``(page_id, host, path, rule, verdict)`` for each row of ``pages(page_id, url, html)``.

    Null urls, and urls without ``://``, have an empty host and path, fit no
    rule, have no aliases and are allowed. ``redirects(from_url, to_url)`` may add edges.
    """
    links = page_links(pages)
    if redirects is not None:
        links = links.union(redirects.select("from_url", "to_url"))
    aliases = alias_verdicts(spark, links, rules)
    urls = pages.select("page_id", F.col("url").cast("string").alias("url"))
    judged = urls.select(
        "page_id",
        host_of(F.col("url")).alias("host"),
        path_of(F.col("url")).alias("path"),
        node_of(F.col("url")).alias("node"),
    ).withColumns(
        {
            "rule": rule_of(F.col("host"), F.col("path"), rules),
            "verdict": rule_of(F.col("host"), F.col("path"), rules, "action"),
        }
    )
    # Only urls without a rule are moved to meet their aliases.
    ruled, open_ = judged.where("rule IS NOT NULL"), judged.where("rule IS NULL")
    settled = open_.join(aliases, "node", "left").withColumn("verdict", F.coalesce("aliased", F.lit("allow")))
    columns = ["page_id", "host", "path", "rule", "verdict"]
    return ruled.select(*columns).unionByName(settled.select(*columns))
