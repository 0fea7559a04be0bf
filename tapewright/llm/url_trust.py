"""URL filter: rules, and trust and distrust propagated over links between hosts (operator 5)."""

from __future__ import annotations

import functools
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapewright.llm.tables import stage

# (verdict, host, path)
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/"))
DAMPING = 0.85
# The share of all weight that may still move when propagation ends; after k rounds it is at most DAMPING ** k.
TOLERANCE = 1e-3
# Distrust of a host in odds, as a multiple of the odds of its share of all pages, from which on it is blocked.
BLOCK_LIFT = 2.0
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def rounds_for(tolerance: float = TOLERANCE, damping: float = DAMPING) -> int:
    return math.ceil(math.log(tolerance) / math.log(damping))


def host_of(url: Column) -> Column:
    host = F.translate(F.regexp_extract(url, "(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER)
    return F.coalesce(host, F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, its verdict) of the longest rule that fits; null without one."""
    ordered = sorted(rules, key=lambda r: -len(r[1] + r[2]))

    def case(value):
        fits = [((host == h) | host.endswith(f".{h}")) & path.startswith(p) for _, h, p in ordered]
        return functools.reduce(lambda c, x: c.when(x[0], value(x[1])) if c is not None else F.when(x[0], value(x[1])),
                                zip(fits, ordered), None)
    return (case(lambda r: F.lit(r[1] + r[2])) if ordered else F.lit(None).cast("string"),
            case(lambda r: F.lit(r[0])) if ordered else F.lit(None).cast("string"))


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, w): absolute and scheme-relative links between different hosts, counted."""
    links = pages.select(host_of(pages["url"]).alias("src"), F.explode(F.regexp_extract_all(
        pages["html"], F.lit("(?i)href\\s*=\\s*[\"']?((?:[a-z][a-z0-9+.-]*:)?//[^\"'>\\s]*)"), 1)).alias("link"))
    full = F.when(F.col("link").startswith("//"), F.concat(F.lit("http:"), "link")).otherwise(F.col("link"))
    return (links.select("src", host_of(full).alias("dst")).filter("src <> '' and dst <> '' and src <> dst")
            .groupBy("src", "dst").agg(F.count("*").alias("w")))


def scores(edges: DataFrame, seeds: DataFrame, tolerance: float = TOLERANCE, damping: float = DAMPING) -> DataFrame:
    """Adds ``trust`` and ``distrust`` to seeds (host, good, bad): shares of trusted and blocked pages.

    Trust follows links, distrust goes against them, both with restarts at their seeds. What has no
    link to leave by stays at its host, so a host without links keeps its seed, however many links
    others have. Hosts that only links name take part with no seed. Each round is one pass over the
    edges; they go on until no more than ``tolerance`` of the weight can still move.
    """
    edges = stage(edges, "host-edges")
    out_sum = edges.groupBy("src").agg(F.sum("w").alias("out"))
    in_sum = edges.groupBy("dst").agg(F.sum("w").alias("into"))
    ends = (out_sum.withColumnRenamed("src", "host").join(in_sum.withColumnRenamed("dst", "host"), "host", "full")
            .join(seeds, "host", "full"))
    state = stage(ends.select(
        "host", F.coalesce("good", F.lit(0.0)).alias("good"), F.coalesce("bad", F.lit(0.0)).alias("bad"),
        F.col("out").isNull().alias("no_out"), F.col("into").isNull().alias("no_in"))
        .withColumns({"trust": F.col("good"), "distrust": F.col("bad")}), "hosts")
    if edges.isEmpty():  # every round gives the seeds again
        return state
    shares = stage(edges.join(out_sum, "src").join(in_sum, "dst").select(
        "src", "dst", (F.col("w") / F.col("out")).alias("ahead"), (F.col("w") / F.col("into")).alias("back")), "host-shares")

    def stays(end: str, score: str) -> Column:
        return F.when(F.col(end), F.col(score)).otherwise(0.0)
    for _ in range(rounds_for(tolerance, damping)):
        ahead = shares.join(state, shares["src"] == state["host"]).select(
            F.col("dst").alias("host"), (F.col("trust") * F.col("ahead")).alias("t"), F.lit(0.0).alias("d"))
        back = shares.join(state, shares["dst"] == state["host"]).select(
            F.col("src").alias("host"), F.lit(0.0).alias("t"), (F.col("distrust") * F.col("back")).alias("d"))
        moved = ahead.union(back).groupBy("host").agg(F.sum("t").alias("t"), F.sum("d").alias("d"))
        state = stage(state.join(moved, "host", "left").select(
            "host", "good", "bad", "no_out", "no_in",
            ((1 - damping) * F.col("good") + damping * (F.coalesce("t", F.lit(0.0)) + stays("no_out", "trust"))).alias("trust"),
            ((1 - damping) * F.col("bad") + damping * (F.coalesce("d", F.lit(0.0)) + stays("no_in", "distrust"))).alias("distrust")),
            "host-scores")
    return state


def judge(pages: DataFrame, rules=RULES, tolerance: float = TOLERANCE, lift: float = BLOCK_LIFT) -> DataFrame:
    """page_id, host, path, rule, verdict, trust and distrust of every page.

    A rule decides where one fits. Else the host does: it is blocked when its distrust is above
    its trust and, in odds, at least ``lift`` times its share of all pages, otherwise allowed; so
    distrust, of which restarts keep 1 - damping at the seeds, can block a host of up to about
    three quarters of all pages. Of rules of equal length that fit, the first counts. Null urls and
    urls without ``://`` have empty host and path and are allowed. Null html has no links.
    Repeated rows count as pages each. An empty table gives none. Extra columns are not read.
    """
    host, path = host_of(pages["url"]), path_of(pages["url"])
    ruled = pages.select(pages["page_id"].alias("page_id"), host.alias("host"), path.alias("path"))
    rule, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    ruled = stage(ruled.withColumn("rule", rule).withColumn("ruled", verdict), "pages-ruled")
    counted = stage(ruled.groupBy("host").agg(
        F.count("*").alias("pages"), F.count_if(F.col("ruled") == "allow").alias("good"),
        F.count_if(F.col("ruled") == "block").alias("bad")), "host-counts")
    pages_all, good, bad = counted.agg(F.sum("pages"), F.sum("good"), F.sum("bad")).first()
    seeds = counted.filter("host <> ''").select(
        "host", (F.col("good") / max(good or 0, 1)).alias("good"), (F.col("bad") / max(bad or 0, 1)).alias("bad"))
    scored = scores(host_edges(pages), seeds, tolerance).select(
        "host", F.round("trust", 9).alias("trust"), F.round("distrust", 9).alias("distrust"))
    fair = F.col("pages") / max(pages_all or 0, 1)
    judged = counted.join(scored, "host", "left").select(
        "host", "trust", "distrust",
        F.when((F.col("distrust") > F.col("trust")) & (F.col("distrust") * (1 - fair) >= lift * fair * (1 - F.col("distrust"))), "block")
        .otherwise("allow").alias("by_host"))
    return ruled.join(judged, "host", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", "by_host", F.lit("allow")).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"),
        F.coalesce("distrust", F.lit(0.0)).alias("distrust"))
