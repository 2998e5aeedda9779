"""How filters interact: what every filter removes, at every place of every order of the filters.

1. Each document gets a mask with one bit per filter that it fails. Documents are then only counts: a cell ``(part, mask)`` holds
   its number of documents and how many of them are labelled good or toxic, at most 32 cells for a part.
2. A recursive query extends prefixes of filters by a filter that they lack. It carries the bits applied so far and joins the
   cells of the part at each level, so a level emits the figures of its own step: 325 rows for a part.
3. Each of the 120 orders reads its five steps from its prefixes. A filter's Shapley count is the sum of what it removes over all
   orders; a prefix of ``k`` filters stands for ``(5 - k)!`` of them.

A document with the text of a smaller doc_id fails E. The smallest doc_id of each text is found by a digest, and documents are
joined with it on digest and doc_id, so a text that a third of the documents have is spread over all tasks. Everything that
moves is a digest, an id and a mask, never a text.

Defined results: a NULL text is an empty one, which fails A alone (and E); a NULL source is the part ``''``; a NULL doc_id fails E
for no document and never itself, and has no label; rows that share a doc_id and a text are not duplicates of each other; several
labels of one doc_id count as one that is good or toxic if any of them is; an empty table gives an empty result. Only ``doc_id``,
``text`` and ``source`` of the documents and ``doc_id``, ``quality`` and ``toxic`` of the labels are read, so other columns cannot clash.
Invalid UTF-8 counts as Spark's string functions see it: broken bytes are replacement characters. Texts are read whole, in one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import WHITE, landed

FILTERS = "ABCDE"  # the bit of a filter is its place here
MIN_WORDS, MIN_DISTINCT, MAX_CAPITALS = 200, 50, 2  # words; per cent of words; per cent of code points
MARKS = "[#$%&*|]"
METRICS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def text_mask(words: Column, distinct: Column, capitals: Column, points: Column, marked: Column) -> Column:
    """The bits of A to D from a text's counts."""
    fails = (
        words < MIN_WORDS,
        F.lit(100).cast("bigint") * distinct < F.lit(MIN_DISTINCT).cast("bigint") * words,
        F.lit(100).cast("bigint") * capitals > F.lit(MAX_CAPITALS).cast("bigint") * points,
        marked,
    )
    bits = [F.when(f, F.lit(1 << i)).otherwise(F.lit(0)) for i, f in enumerate(fails)]
    return sum(bits[1:], bits[0])


def measured(docs: DataFrame) -> DataFrame:
    """Rows ``(doc_id, part, digest, mask)`` with the bits that a text decides alone; written, so that texts are read once."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("bigint"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), text.alias("text"))
    rows = rows.withColumn("words", F.array_remove(F.split("text", f"[{WHITE}]+"), ""))
    mask = text_mask(
        F.size("words"),
        F.size(F.array_distinct("words")),
        F.length(F.regexp_replace("text", "[^A-Z]+", "")),
        F.length("text"),
        F.col("text").rlike(MARKS),
    )
    return landed(rows.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), mask.alias("mask")), "masks")


def cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows ``(part, mask, n, good, toxic)``."""
    rows = measured(docs)
    known = rows.where("doc_id is not null")
    firsts = known.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    marks = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    copy = F.when(F.col("first"), F.lit(0)).otherwise(F.lit(1 << FILTERS.index("E")))
    judged = known.join(firsts, ["digest", "doc_id"], "left").join(marks, "doc_id", "left")
    judged = judged.select("part", (F.col("mask") + copy).alias("mask"), "good", "toxic")
    nameless = rows.where("doc_id is null").select("part", "mask", F.lit(0).alias("good"), F.lit(0).alias("toxic"))
    whole = judged.unionByName(nameless).groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.coalesce("good", F.lit(0))).alias("good"),
        F.sum(F.coalesce("toxic", F.lit(0))).alias("toxic"),
    )
    return landed(whole, "cells")


def _over_cells(what: str, condition: str) -> str:
    return f"aggregate(c.cells, 0L, (total, m) -> total + if({condition}, m.{what}, 0L))"


def prefixes(counts: DataFrame) -> DataFrame:
    """Rows ``(part, filter_order, step, …)``: the figures of the last filter of every prefix, from the cells of the parts."""
    spark = counts.sparkSession
    here, earlier = "m.mask & f.bit <> 0", "m.mask & s.applied <> 0"
    figures = (
        _over_cells("n", "m.mask & (s.applied | f.bit) = 0"),
        _over_cells("n", f"{here} and not {earlier}"),
        _over_cells("n", f"{here} and {earlier}"),
        _over_cells("n", "m.mask = f.bit"),
        _over_cells("good", f"{here} and not {earlier}"),
        _over_cells("toxic", f"{here} and not {earlier}"),
    )
    # At most 32 cells for a part, so the list of a part is bounded.
    by_part = landed(counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells")), "parts")
    filters = spark.createDataFrame([(f, 1 << i) for i, f in enumerate(FILTERS)], "letter string, bit int")
    # LIMIT ALL: as many rows as the parts need, rather than the engine's default limit for recursion.
    walk = f"""
        WITH RECURSIVE steps (part, filter_order, step, applied, {", ".join(METRICS)}) AS (
            SELECT part, CAST('' AS STRING), 0, 0, {", ".join("0L" for _ in METRICS)} FROM {{parts}}
            UNION ALL
            SELECT s.part, concat(s.filter_order, f.letter), s.step + 1, s.applied | f.bit, {", ".join(figures)}
            FROM steps s JOIN {{filters}} f ON s.applied & f.bit = 0 JOIN {{parts}} c ON c.part = s.part
        )
        SELECT part, filter_order, step, {", ".join(METRICS)} FROM steps WHERE step > 0 LIMIT ALL
    """
    return landed(spark.sql(walk, parts=by_part, filters=filters), "prefixes")


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows ``(part, filter_order, step, …, shapley)``: 600 for each part of the documents."""
    walked = prefixes(cells(docs, labels))
    last = F.substring("filter_order", -1, 1)
    stands_for = F.factorial(F.lit(len(FILTERS)) - F.col("step"))
    shapley = walked.groupBy("part", last.alias("letter")).agg(F.sum(F.col("removed") * stands_for).alias("shapley"))
    orders = walked.where(F.col("step") == len(FILTERS)).select("part", F.col("filter_order").alias("whole"))
    places = orders.select("part", "whole", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))
    places = places.withColumns({"filter_order": F.expr("substring(whole, 1, step)"), "letter": F.expr("substring(whole, step, 1)")})
    found = places.join(walked, ["part", "filter_order", "step"]).join(shapley, ["part", "letter"])
    return found.select("part", F.col("whole").alias("filter_order"), "step", *METRICS, "shapley")
