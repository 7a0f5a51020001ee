"""URL filters: prefix rules, and link-graph propagation for the pages that no rule fits.

Rules name a host and a path prefix; a rule fits its host and all subdomains if the url's path
starts with the rule's, and the longest fitting rule decides. Pages without a rule are judged by
their host's place in the link graph:

* Edges: from a page's host to every other host that its HTML names (links with a host, such as
  ``https://host/`` and ``//host/``, and host names of three or more labels), counted once per page and
  summed per pair of hosts.
* Seeds: a host's share of pages that a rule allows (trust) or blocks (distrust).
* Trust flows along the edges, personalised PageRank from the allowed seeds: a host divides its trust
  among the hosts it links to. Distrust flows against them, from the blocked seeds to those who link
  there, and counts with the share that the link has among all links of the one who links. So a
  host's distrust is the chance that a walk along its links meets blocked hosts, and does not fall
  with the number of others who link there. Rounds go on until no score moves by ``TOLERANCE``;
  damping makes them end.
* A host is blocked where its distrust is at least ``LEAST`` of what a fully blocked seed keeps for
  itself and exceeds its trust; otherwise it is allowed.

DataFrame operations only. Each round's scores are written to the shared folder. Hosts of a third
of all pages are one row after the first aggregation, so no join meets them page by page but the
last, whose host side is one row a host.

Null urls, and urls without ``://``: host and path empty, no rule, allowed. Null HTML names no host.
Repeated rows count as so many pages and give a row each. No pages: no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cobble.llm.common import materialize

#: Fixed values of the result's contract: (verdict, host, path).
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
DAMPING, TOLERANCE, LEAST = 0.85, 1e-4, 0.5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A link's host behind ``://``, or behind ``//`` where an attribute's value begins, or a name of three
#: or more labels that no mail address or path holds.
NAMED_HOST = (
    r"(?:://|(?<=[\x22\x27=])//)[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
    r"|(?<![\w@./-])(?:[A-Za-z0-9-]+\.){2,}[A-Za-z]{2,}(?![\w@-]|\.\w)"
)


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, r"://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """(name, verdict) of the longest rule that fits, else null."""
    found = F.lit(None).cast("struct<name:string,verdict:string>")
    for verdict, name, prefix in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), r[0])):
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(prefix)
        own = F.struct(F.lit(name + prefix).alias("name"), F.lit(verdict).alias("verdict"))
        found = F.when(fits, own).otherwise(found)
    return found


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, weight): on how many pages of ``src`` the other host ``dst`` is named."""
    # One scan of the HTML; what stands before a link's host is taken off the few that are found.
    named = F.transform(
        F.expr(f"regexp_extract_all(html, r'{NAMED_HOST}', 0)"),
        lambda h: F.translate(F.call_function("ltrim", F.lit(":/"), h), UPPER, LOWER),
    )
    pairs = pages.filter("host <> ''").select("host", F.explode(F.array_distinct(named)).alias("dst"))
    pairs = pairs.filter((F.col("dst") != "") & (F.col("dst") != F.col("host")))
    return pairs.groupBy(F.col("host").alias("src"), "dst").agg(F.count("*").cast("double").alias("weight"))


def propagate(edges: DataFrame, seeds: DataFrame, damping: float, tolerance: float) -> DataFrame:
    """(host, trust, distrust) of every host that has an edge or a seed.

    ``edges`` (src, dst, weight), ``seeds`` (host, trust, distrust), one row a host.
    """
    # Both kinds share by the links of the one who links: trust leaves it, distrust comes to it.
    out = edges.groupBy("src").agg(F.sum("weight").alias("total"))
    shares = edges.join(out, "src").select("src", "dst", (F.col("weight") / F.col("total")).alias("share"))
    shares = materialize(shares, "url-shares")
    forward = shares.select(F.lit("trust").alias("kind"), "src", "dst", "share")
    backward = shares.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "share")
    steps = forward.unionByName(backward)
    seed = seeds.selectExpr("host", "stack(2, 'trust', trust, 'distrust', distrust) AS (kind, seed)").filter("seed > 0")
    base = materialize(seed.select("kind", "host", (F.col("seed") * (1 - damping)).alias("base")), "url-base")
    scores = base.withColumnRenamed("base", "score")
    while True:
        sent = scores.withColumnRenamed("host", "src").join(steps, ["kind", "src"])
        flow = sent.groupBy("kind", F.col("dst").alias("host")).agg((damping * F.sum(F.col("score") * F.col("share"))).alias("flow"))
        new = flow.join(base, ["kind", "host"], "full").select(
            "kind", "host", (F.coalesce("flow", F.lit(0.0)) + F.coalesce("base", F.lit(0.0))).alias("score")
        )
        before = scores.withColumnRenamed("score", "before")
        new = materialize(
            new.join(before, ["kind", "host"], "left").withColumn("move", F.abs(F.col("score") - F.coalesce("before", F.lit(0.0)))),
            "url-scores",
        )
        scores = new.select("kind", "host", "score")
        if (new.agg(F.max("move")).first()[0] or 0.0) < tolerance:
            break
    return scores.groupBy("host").agg(
        F.sum(F.when(F.col("kind") == "trust", F.col("score")).otherwise(0.0)).alias("trust"),
        F.sum(F.when(F.col("kind") == "distrust", F.col("score")).otherwise(0.0)).alias("distrust"),
    )


def judge_urls(
    pages: DataFrame,
    rules: Sequence[tuple[str, str, str]] = RULES,
    damping: float = DAMPING,
    tolerance: float = TOLERANCE,
    least: float = LEAST,
) -> DataFrame:
    """Per row of ``pages`` (page_id, url, html): host, path, rule, verdict, and the host's trust and distrust."""
    parts = pages.select(
        pages["page_id"].cast("bigint").alias("page_id"),
        host_of(pages["url"]).alias("host"),
        path_of(pages["url"]).alias("path"),
        pages["html"].alias("html"),
    )
    ruled = parts.withColumn("fit", rule_of(F.col("host"), F.col("path"), rules))
    share = {k: F.avg((F.coalesce(F.col("fit.verdict"), F.lit("")) == v).cast("double")) for k, v in (("trust", "allow"), ("distrust", "block"))}
    seeds = ruled.filter("host <> ''").groupBy("host").agg(*(v.alias(k) for k, v in share.items()))
    scores = propagate(host_edges(parts), seeds, damping, tolerance)
    blocked = (F.col("distrust") >= least * (1 - damping)) & (F.col("distrust") > F.col("trust"))
    verdicts = scores.select("host", "trust", "distrust", F.when(blocked, "block").otherwise("allow").alias("method"))
    return (
        ruled.drop("html")
        .join(verdicts, "host", "left")
        .select(
            "page_id",
            "host",
            "path",
            F.col("fit.name").alias("rule"),
            F.coalesce(F.col("fit.verdict"), F.col("method"), F.lit("allow")).alias("verdict"),
            F.coalesce("trust", F.lit(0.0)).alias("trust"),
            F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
        )
    )
