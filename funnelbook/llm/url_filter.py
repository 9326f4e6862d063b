"""URL filters: listed rules first, and for all other hosts trust and distrust spread over the link graph.

Trust is personalised PageRank that starts at hosts whose rule allows them and follows links. Distrust starts at hosts whose rule
blocks them and follows links backwards: who links to a blocked host shares its blame. Both are counted in pages, allowed and
blocked ones, that walks bring to a host. A host is blocked if its distrust is more than its trust and reaches a threshold for each
page of its own. Hosts that no walk connects have no part in it. All of it is DataFrame code.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

#: (host, path, verdict) of the rules that the registered query applies.
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)
#: The host of an absolute or protocol-relative address in an attribute.
LINK = r"""(?i)\b(?:href|src|action)\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s>]+)"""
#: Equal sums may differ by so much, as their parts are added in any order.
_ROUNDING = 1e-9
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without a host part."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """Struct ``rule``, ``verdict`` of the longest rule whose host is the host or a parent of it and whose path begins the path."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for name, start, verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):  # the last that fits is the longest
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        found = F.when(fits, F.struct(F.lit(name + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def host_edges(pages: DataFrame, *, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``src``, ``dst``, ``weight``: links from one host to another, counted before and after the shuffle."""
    links = F.regexp_extract_all(F.coalesce(F.col(html_col).cast("string"), F.lit("")), F.lit(LINK), F.lit(1))
    return (
        pages.select(host_of(F.col(url_col)).alias("src"), F.explode(links).alias("dst"))
        .withColumn("dst", F.translate("dst", _UPPER, _LOWER))
        .where("src <> dst AND src <> '' AND dst <> ''")
        .groupBy("src", "dst")
        .agg(F.count("*").cast("double").alias("weight"))
    )


def propagate(edges: DataFrame, seeds: DataFrame, *, damping: float = 0.85, tolerance: float = 1e-3) -> DataFrame:
    """``kind``, ``host``, ``score`` of personalised PageRank; edges ``kind, src, dst, weight``, seeds ``kind, host, weight``.

    Every kind is a graph of its own with restart weights that sum to 1. The score is the sum of what walks from the seeds bring, a
    step less likely by ``damping`` than the one before; a walk ends at a host without links. So scores are linear in the seeds, and
    what other seeds and hosts the table holds changes the common scale only. Each round sends the walks on by one join on the
    source and one aggregation by target, written to the shared folder; rounds end when no walk is left, or when each has
    less than ``tolerance`` of its weight left, however large the table is.
    """
    share = F.col("weight") / F.sum("weight").over(_by("kind", "src"))
    shares = written(edges.select("kind", "src", "dst", share.alias("share")))
    total = seeds.groupBy("kind").agg(F.sum("weight").alias("total"))
    flow = written(seeds.join(total, "kind").select("kind", "host", ((1 - damping) * F.col("weight") / F.col("total")).alias("score")))
    score = flow
    for k in range(1, math.ceil(math.log(tolerance) / math.log(damping)) + 1):
        sent = flow.join(shares, (flow["kind"] == shares["kind"]) & (flow["host"] == shares["src"]))
        sent = sent.select(flow["kind"], F.col("dst").alias("host"), (damping * F.col("score") * F.col("share")).alias("score"))
        flow = written(sent.groupBy("kind", "host").agg(F.sum("score").alias("score")))
        if flow.isEmpty():
            break
        score = score.unionByName(flow)
        if k % 8 == 0:
            score = written(score.groupBy("kind", "host").agg(F.sum("score").alias("score")))
    return score.groupBy("kind", "host").agg(F.sum("score").alias("score"))


def _by(*columns: str):
    from pyspark.sql import Window

    return Window.partitionBy(*columns)


def judge_hosts(
    pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, *, threshold: float = 1e-4, url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """``host``, ``trust``, ``distrust``, ``verdict`` of every host in a seed or a link.

    Seeds are the hosts of pages that a rule allows or blocks, weighted by the number of such pages. ``trust`` and ``distrust`` are the host's
    own such pages and what walks from all of them bring, in allowed and in blocked pages, so they do not depend on hosts that no walk
    connects. A host is blocked if its distrust is more than its trust and at least ``threshold`` blocked pages for each page of its own.
    """
    host, path = host_of(F.col(url_col)), path_of(F.col(url_col))
    ruled = lambda verdict: F.count(F.when(F.col("verdict") == verdict, 1)).cast("double")
    sizes = written(
        pages.select(host.alias("host"), rule_of(host, path, rules)["verdict"].alias("verdict"))
        .where("host <> ''")
        .groupBy("host")
        .agg(F.count("*").alias("pages"), ruled("allow").alias("trust"), ruled("block").alias("distrust"))
    )
    seeds = sizes.select("host", F.expr("stack(2, 'trust', trust, 'distrust', distrust) AS (kind, weight)")).where("weight > 0")
    totals = sizes.agg(F.sum("trust").alias("trust"), F.sum("distrust").alias("distrust")).first()  # two numbers
    edges = written(host_edges(pages, url_col=url_col, html_col=html_col))
    both = edges.select(F.lit("trust").alias("kind"), "src", "dst", "weight").unionByName(
        edges.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
    )
    score = propagate(both, seeds)
    part = lambda kind: F.sum(F.when(F.col("kind") == kind, F.col("score") * (totals[kind] or 0.0)).otherwise(0.0)).alias(kind)
    own = sizes.select("host", "pages", F.col("trust").alias("__t"), F.col("distrust").alias("__d"))
    sums = score.groupBy("host").agg(part("trust"), part("distrust")).join(own, "host", "left")
    sums = sums.withColumns({"trust": F.col("trust") + F.coalesce("__t", F.lit(0.0)), "distrust": F.col("distrust") + F.coalesce("__d", F.lit(0.0))})
    bad = (F.col("distrust") >= threshold * F.coalesce("pages", F.lit(1))) & (F.col("distrust") > (1 + _ROUNDING) * F.col("trust"))
    return sums.select("host", "trust", "distrust", F.when(bad, "block").otherwise("allow").alias("verdict"))


def filter_urls(
    pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, *, threshold: float = 1e-4, id_col: str = "page_id",
    url_col: str = "url", html_col: str = "html",
) -> DataFrame:
    """Id, ``host``, ``path``, ``rule`` and ``verdict`` of every page, with the host's ``trust`` and ``distrust``.

    A rule's verdict holds where one fits, the longest first; else the host's. Hosts that neither seeds nor links reach have
    no trust and no distrust and are allowed, so are pages without a host: null urls and urls without ``://`` have empty host and
    path. Null pages have no links. Repeated rows each give a row, an empty table none. Other columns are ignored.

    The page table is joined with one row per host; Spark broadcasts that side only if it is small, and else splits the rows of a
    hot host by their shuffled size.
    """
    hosts = written(judge_hosts(pages, rules, threshold=threshold, url_col=url_col, html_col=html_col))
    rows = pages.select(F.col(id_col), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    rows = rows.withColumn("__rule", rule_of(F.col("host"), F.col("path"), rules))
    out = rows.join(hosts.withColumnRenamed("verdict", "__host"), "host", "left")
    return out.select(
        id_col, "host", "path", F.col("__rule.rule").alias("rule"),
        F.coalesce("__rule.verdict", "__host", F.lit("allow")).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
    )
