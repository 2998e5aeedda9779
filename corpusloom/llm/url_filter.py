"""URL verdicts: fixed rules first, and for all other pages trust and distrust that flow along the links between hosts.

Rules make seeds: a host's seed of trust (distrust) is the share of its pages that the rules allow (block). A host that is only
linked to has a seed of 1 if a rule speaks for all its paths.

* Trust is a personalised PageRank without normalisation: ``trust = damping * P' (seed + trust)``, where ``P`` holds each host's
  shares of links. It counts the damped visits of walks that start at the seeds.
* Distrust runs against the links: ``distrust = damping * P (seed + distrust)``, the damped visits to blocked hosts of a walk
  that starts at the host itself. So it does not get less where many hosts link to one blocked host, and a host that also
  links to many others gets little.

A host's own seed is in neither score: its rules speak for the pages they fit, and its other pages are judged by links. A host is
blocked if its distrust is at least ``FLOOR`` and exceeds its trust.

Both sums are taken round by round. What later rounds can still add to any host is at most ``damping / (1 - damping)`` times the
sum of a round's trust and the largest value of its distrust; the rounds end when both bounds are at most ``TOLERANCE``. They shrink at
least by ``damping`` a round, so the number of rounds grows with the logarithm of the number of seeds only.

Defined results: a NULL or relative url has empty host and path and fits no rule; a NULL html has no links; links of a
host to itself do not count; an empty table gives an empty result; a repeated page is judged like the first, and its links and
its share of the host's pages count again. Other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from corpusloom.llm.common import ascii_lower, landed

URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
LINK = r"""(?i)<a\s[^>]*?\bhref\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s>]+)"""
DAMPING = 0.85
FLOOR = 0.1  # a chain of 14 links, or one link in eight, to a blocked host
TOLERANCE = 1e-4
SUMMED_EVERY = 8  # rounds whose tables are summed up in one


def host_of(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, URL, 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest of the ``(rule, verdict)`` pairs that fits, and its verdict; NULL where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: len(r[0])):
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def host_edges(pages: DataFrame) -> DataFrame:
    """Rows ``(src, dst, links)`` of the links between different hosts; ``pages`` has ``host`` and ``html``."""
    links = F.explode(F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(LINK), F.lit(1)))
    found = pages.where("host <> ''").select(F.col("host").alias("src"), links.alias("dst"))
    return found.withColumn("dst", ascii_lower("dst")).where("src <> dst").groupBy("src", "dst").agg(F.count(F.lit(1)).alias("links"))


def propagate(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE) -> DataFrame:
    """Rows ``(host, trust, distrust)`` of the hosts that a walk reaches; edges are ``(src, dst, links)``, seeds ``(host, trust, distrust)``.

    One round is one job: it moves both kinds one link on, and tells how much moved. Shares and rounds are landed, so that Spark may
    split the edges of a host that has very many.
    """
    totals = landed(edges.groupBy("src").agg(F.sum("links").alias("all_links")), "totals")
    shares = edges.join(totals, "src").select("src", "dst", (F.col("links") / F.col("all_links") * damping).alias("share"))
    forward = shares.select(F.lit("trust").alias("kind"), F.col("src").alias("at"), F.col("dst").alias("to"), "share")
    backward = shares.select(F.lit("distrust").alias("kind"), F.col("dst").alias("at"), F.col("src").alias("to"), "share")
    moves = landed(forward.unionByName(backward), "moves")
    kinds = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("mass")) for k in ("trust", "distrust")]))
    mass = landed(seeds.select("host", kinds.alias("k")).select("host", "k.*").where("mass > 0"), "mass")
    rounds: list[DataFrame] = []
    while True:
        moved = mass.join(moves, (mass["host"] == moves["at"]) & (mass["kind"] == moves["kind"]))
        moved = moved.select(F.col("to").alias("host"), moves["kind"], (F.col("mass") * F.col("share")).alias("mass"))
        left = Observation()  # taken while the round is written
        mass = landed(
            moved.groupBy("host", "kind").agg(F.sum("mass").alias("mass")).observe(
                left,
                F.sum(F.when(F.col("kind") == "trust", F.col("mass"))).alias("trust"),
                F.max(F.when(F.col("kind") == "distrust", F.col("mass"))).alias("distrust"),
            ),
            "mass",
        )
        rounds.append(mass)
        if len(rounds) == SUMMED_EVERY:
            rounds = [landed(_summed(rounds), "scores")]
        if max(left.get["trust"] or 0.0, left.get["distrust"] or 0.0) * damping <= tolerance * (1 - damping):
            break
    return _summed(rounds).groupBy("host").agg(
        *[F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("mass"))), F.lit(0.0)).alias(k) for k in ("trust", "distrust")]
    )


def _summed(rounds: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, rounds).groupBy("host", "kind").agg(F.sum("mass").alias("mass"))


def judged(pages: DataFrame, rules: Sequence[tuple[str, str]], floor: float = FLOOR) -> DataFrame:
    """Rows ``(page_id, host, path, rule, verdict)`` for pages ``(page_id, url, html)``.

    Every host without a score is allowed. The final join carries ids and urls' parts only; a hot host's rows are split
    by Spark's skew handling, or not moved at all while the list of blocked hosts is small enough for Spark to broadcast.
    """
    parts = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "html")
    rule, says = matching_rule(F.col("host"), F.col("path"), rules)
    rows = parts.withColumns({"rule": rule, "said": says})
    edges = landed(host_edges(rows), "edges")
    rows = rows.drop("html")
    if edges.isEmpty():
        return rows.select("page_id", "host", "path", "rule", F.coalesce("said", F.lit("allow")).alias("verdict"))
    shares = {kind: F.count_if(F.col("said") == word) / F.count(F.lit(1)) for kind, word in (("trust", "allow"), ("distrust", "block"))}
    own = landed(rows.where("host <> ''").groupBy("host").agg(*[share.alias(kind) for kind, share in shares.items()]), "seeds")
    linked = edges.select(F.col("dst").alias("host")).distinct().join(own, "host", "left_anti")
    word = matching_rule(F.col("host"), F.lit("/"), rules)[1]
    linked = linked.select("host", *[(word == w).cast("double").alias(k) for k, w in (("trust", "allow"), ("distrust", "block"))])
    scores = propagate(edges, own.unionByName(linked).where("trust > 0 or distrust > 0"))
    bad = landed(scores.where((F.col("distrust") >= floor) & (F.col("distrust") > F.col("trust"))).select("host"), "blocked-hosts")
    found = F.coalesce("said", F.when(F.col("bad"), F.lit("block")), F.lit("allow"))
    return rows.join(bad.withColumn("bad", F.lit(True)), "host", "left").select("page_id", "host", "path", "rule", found.alias("verdict"))
