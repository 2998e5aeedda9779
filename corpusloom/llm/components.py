"""Connected components of a graph of links, as joins and aggregations.

Alternates large-star and small-star steps: each vertex hands its neighbours the smallest vertex it knows, until every
vertex points to the smallest of its component. All state is in tables in the shared folder; the driver sees a count and a
checksum per step. The minima are landed before they are joined back, so a vertex with very many links is dealt out by
Spark's skew handling.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from corpusloom.llm.common import landed


def _star(pairs: DataFrame, large: bool) -> DataFrame:
    """One step over links ``(u, v)``: neighbours above (large) or up to (small) the vertex are linked to its minimum."""
    turned = pairs.select(F.col("v").alias("u"), F.col("u").alias("v"))
    around = pairs.unionByName(turned) if large else pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = landed(around.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "least")
    joined = around.join(least, "u")
    if large:
        new = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        new = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return new.where("u <> v").distinct()


def components(pairs: DataFrame) -> DataFrame:
    """Rows ``(u, v)``: every linked vertex but the smallest of its component, and that smallest one."""
    pairs = landed(pairs.where("u <> v").select("u", "v").distinct(), "links")
    seen = None
    while True:
        mark = Observation()  # counted while the step is written
        step = _star(landed(_star(pairs, True), "star"), False).observe(
            mark, F.count(F.lit(1)).alias("n"), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 40))).alias("sum")
        )
        pairs, now = landed(step, "star"), mark.get
        if now == seen or not now["n"]:
            return pairs
        seen = now
