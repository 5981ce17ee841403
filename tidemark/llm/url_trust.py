"""URL filters by rules and, where no rule fits, by trust that flows along links, in DataFrame operations only.

Rules on urls give the seeds: each allowed url of a host is a unit of trust, each blocked one a unit of distrust. Trust
flows along the links between hosts, distrust against them (who links to blocked hosts is not to be trusted). Both
are personalised PageRanks, computed together as the sum of what the seeds send out, step by step: the share of a link is
its part of the links that leave a host (for trust) or enter it (for distrust).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import staged

#: Part of the mass that a host passes on in a step.
DAMPING = 0.85
#: Steps; what is still on its way after them is less than 4 % of the seeds.
STEPS = 20
#: A host is blocked whose distrust is more than so many times its trust.
BLOCK_RATIO = 2.0

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to a slash, question mark or hash, A-Z in lower case; empty without one."""
    return F.translate(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to a question mark or hash; empty without one."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.locate("://", url)
    return F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))


def rule_table(spark: SparkSession, rules: list[tuple[str, str]]) -> DataFrame:
    """``[(verdict, "host/path")]`` -> ``(rule, rule_host, rule_path, verdict)``."""
    rows = F.array(*(F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict")) for verdict, rule in rules))
    table = spark.range(1).select(F.inline(rows))
    at = F.locate("/", F.col("rule"))
    host = F.translate(F.expr("substring_index(rule, '/', 1)"), _UPPER, _LOWER)
    return table.select("rule", host.alias("rule_host"), F.when(at > 0, F.expr("substring(rule, locate('/', rule))")).otherwise("").alias("rule_path"), "verdict")


def host_links(pages: DataFrame) -> DataFrame:
    """``(host, html)`` -> ``(source, target, links)``: links from pages of one host to another."""
    pattern = r"""(?i)<a\s[^>]*?href\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s>]+)"""
    targets = pages.select(F.col("host").alias("source"), F.explode(F.regexp_extract_all("html", F.lit(pattern), F.lit(1))).alias("target"))
    targets = targets.withColumn("target", F.translate("target", _UPPER, _LOWER)).where("source <> '' AND source <> target")
    return targets.groupBy("source", "target").agg(F.count("*").alias("links"))


def propagate(seeds: DataFrame, links: DataFrame) -> DataFrame:
    """``seeds(host, trust, distrust)`` and links -> the same columns with all that reaches each host."""
    out = links.groupBy("source").agg(F.sum("links").alias("all"))
    into = links.groupBy("target").agg(F.sum("links").alias("all"))
    forward = links.join(out, "source").selectExpr("'trust' AS kind", "source AS from", "target AS to", "links / all AS share")
    backward = links.join(into, "target").selectExpr("'distrust' AS kind", "target AS from", "source AS to", "links / all AS share")
    edges = staged(forward.union(backward))
    flow = seeds.selectExpr("host AS from", "inline(array(struct('trust' AS kind, cast(trust AS double) AS mass), struct('distrust' AS kind, cast(distrust AS double) AS mass)))")
    flow = staged(flow.where("mass > 0").select("kind", "from", "mass"))
    flows = [flow]
    for _ in range(STEPS):
        moved = flow.join(edges, ["kind", "from"]).groupBy("kind", F.col("to").alias("from")).agg(F.sum(F.col("mass") * F.col("share") * DAMPING).alias("mass"))
        flow = staged(moved)
        if flow.isEmpty():
            break
        flows.append(flow)
    mass = reduce(DataFrame.union, flows).groupBy(F.col("from").alias("host"))
    return mass.agg(*(F.sum(F.when(F.col("kind") == kind, F.col("mass")).otherwise(0.0)).alias(kind) for kind in ("trust", "distrust")))


def judge_urls(pages: DataFrame, rules: DataFrame, keep: list[str], url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(page, host, path, rule, verdict, trust, distrust)`` of every row of ``pages``; ``page`` has its ``keep`` columns.

    A rule fits its host and the hosts below it if the path starts with the rule's; the longest that fits decides, of
    equally long ones the first in order. Other urls are blocked if the distrust of their host exceeds its trust
    ``BLOCK_RATIO`` times, and allowed otherwise; so are hosts that nothing reaches, and null urls and urls without
    ``://``, whose host and path are empty. Links to the own host do not count; null pages have no links.
    """
    rows = pages.select(F.struct(*keep).alias("page"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    labels = F.split("host", r"\.")
    above = F.expr("transform(sequence(1, size(labels)), i -> array_join(slice(labels, i, size(labels)), '.'))")
    hosts = rows.select("host").distinct().withColumn("labels", labels).select("host", F.explode(above).alias("rule_host"))
    known = hosts.join(rules, "rule_host").groupBy("host").agg(F.collect_list(F.struct((-F.length("rule")).alias("order"), "rule", "rule_path", "verdict")).alias("rules"))
    fitting = F.expr("array_min(filter(rules, r -> startswith(path, r.rule_path)))")
    ruled = staged(rows.join(known, "host", "left").withColumn("fit", fitting).selectExpr("page", "host", "path", "fit.rule", "fit.verdict"))

    seeds = ruled.groupBy("host").agg(F.count_if(F.col("verdict") == "allow").alias("trust"), F.count_if(F.col("verdict") == "block").alias("distrust"))
    links = staged(host_links(pages.select(host_of(F.col(url_col)).alias("host"), F.col(html_col).alias("html"))))
    reached = propagate(seeds, links)
    judged = ruled.join(reached, "host", "left").fillna(0.0, ["trust", "distrust"])
    by_method = F.when(F.col("distrust") > BLOCK_RATIO * F.col("trust"), "block").otherwise("allow")
    return judged.select("page", "host", "path", "rule", F.coalesce("verdict", by_method).alias("verdict"), "trust", "distrust")
