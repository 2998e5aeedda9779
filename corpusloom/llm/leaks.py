"""Benchmark leaks: windows of documents that are as long as a benchmark item and nearly equal to it.

Texts are lower-cased and cut into words at white space; shingles are five words. A window is proposed for an item by the
places of the item's shingles in the text alone, in whatever order they stand: it is as long as the item, begins at such a place (or
at the text's start, and ends at one), and holds so many of them that the similarity can be reached. A window that
begins elsewhere can be moved to the next such place without losing any, so the best window of an item is always proposed, and
others with the same shingles may not be. Equal windows are one from here on. Each gets a 64-bit SimHash of its shingles;
a multi-index over four 16-bit blocks finds the items: two fingerprints that differ in at most ``RADIUS`` = 19 bits differ in at
most four bits of some block, and the index holds every value within four bits of each item's blocks, so none within the
radius is missed. What it finds is verified by the exact weighted similarity: the sum of the smaller over the sum of the
larger counts of each shingle, 0.8 or more.

Defined results: a NULL or short text (below five words) has no windows; items with fewer than five words are not searched
for; a window is cut at the text's ends; repeated items are one, and repeated rows of a document count as one document;
documents with a NULL doc_id are one document; empty tables give no leaks. Other columns of the input are ignored.

Native: no function leaves the JVM. The text is read twice (for the places, then for the windows of the texts that have some), and only
places and windows move. The benchmark's shingles are broadcast while
there are at most ``BROADCAST_SHINGLES`` of them, and joined by a shuffle beyond.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import WHITE, landed

WORDS, SIMILARITY, RADIUS = 5, 0.8, 19
BLOCKS, BLOCK_BITS = 4, 16
BROADCAST_SHINGLES = 500_000


def shingles(text: Column) -> Column:
    """Hashes of the five-word shingles of a text, in order."""
    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(f"[^{WHITE}]+"), F.lit(0))

    def hashes(w: Column) -> Column:
        places = F.when(F.size(w) >= WORDS, F.sequence(F.lit(0), F.size(w) - WORDS)).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WORDS)]))

    return F.transform(F.array(words), hashes)[0]  # bound once, so that the words are not cut again for each shingle


def items(benchmark: DataFrame) -> DataFrame:
    """Rows ``(item_id, item)``: each item's shingles."""
    return benchmark.select("item_id", shingles(F.col("text")).alias("item")).where(F.size("item") > 0).distinct()


def reaching(docs: DataFrame, found: DataFrame, least: float) -> DataFrame:
    """Rows ``(text_key, start, length)``, in shingles: windows that hold enough shingles of an item, in any order."""
    known = found.select(F.xxhash64("item").alias("key"), F.size("item").alias("m"), F.explode(F.array_distinct("item")).alias("h"))
    lists = known.groupBy("h").agg(F.collect_set(F.struct("key", "m")).alias("places"))
    if lists.count() <= BROADCAST_SHINGLES:
        lists = F.broadcast(lists)
    rows = docs.select(F.md5("text").alias("text_key"), shingles(F.col("text")).alias("all"))
    hits = rows.select("text_key", F.size("all").alias("n"), F.posexplode("all").alias("pos", "h")).join(lists, "h")
    each = hits.select("text_key", "n", "pos", F.explode("places").alias("x")).select("text_key", "n", "pos", "x.*")
    sorted_places = each.groupBy("text_key", "n", "key", "m").agg(F.sort_array(F.collect_set("pos")).alias("at"))

    def needed(length: Column) -> Column:  # common / (length + m - common) >= least
        return F.greatest(F.lit(1), F.ceil((length + F.col("m")) * F.lit(least / (1 + least)) - F.lit(1e-6)).cast("int"))

    def from_here(p: Column, i: Column) -> Column:
        length = F.least(F.col("m"), F.col("n") - p)
        last = F.get("at", i + needed(length) - 1)  # the last of so many places, counted from this one
        return F.when(F.coalesce(last < p + length, F.lit(False)), F.struct(p.alias("start"), length.alias("length")))

    def up_to_here(p: Column, i: Column) -> Column:
        reached = (p + 1 < F.col("m")) & (i + 1 >= needed(p + 1))
        return F.when(reached, F.struct(F.lit(0).alias("start"), (p + 1).alias("length")))

    cut = F.filter(F.concat(F.transform("at", from_here), F.transform("at", up_to_here)), lambda x: x.isNotNull())
    return sorted_places.select("text_key", F.explode(cut).alias("x")).select("text_key", "x.*").distinct()


def windows(docs: DataFrame, found: DataFrame, least: float) -> DataFrame:
    """Rows ``(doc_id, start, window)``: the proposed windows of each document, as shingles."""
    cuts = landed(reaching(docs, found, least), "cuts")
    lists = cuts.groupBy("text_key").agg(F.collect_list(F.struct("start", "length")).alias("cuts"))
    if cuts.count() <= BROADCAST_SHINGLES:
        lists = F.broadcast(lists)
    rows = docs.select("doc_id", "text", F.md5("text").alias("text_key")).join(lists, "text_key")
    taken = F.transform(F.array(shingles(F.col("text"))), lambda a: F.transform(
        "cuts", lambda x: F.struct(x["start"].alias("start"), F.slice(a, x["start"] + 1, x["length"]).alias("window"))
    ))[0]
    return rows.select("doc_id", F.explode(taken).alias("x")).select("doc_id", "x.*")


def simhash(found: Column) -> Column:
    """64 bits: each is set if most of the shingles' hashes (each as often as it occurs) have it set."""
    def bit(b: int) -> Column:
        votes = F.aggregate(found, F.lit(0), lambda n, h: n + F.shiftrightunsigned(h, b).bitwiseAND(F.lit(1).cast("bigint")).cast("int"))
        return F.when(votes * 2 > F.size(found), F.shiftleft(F.lit(1).cast("bigint"), b)).otherwise(F.lit(0).cast("bigint"))

    total = bit(0)
    for b in range(1, 64):
        total = total.bitwiseOR(bit(b))
    return total


def block(fingerprint: Column, b: int) -> Column:
    return F.shiftrightunsigned(fingerprint, b * BLOCK_BITS).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1).cast("bigint")).cast("int")


def blocks(fingerprint: Column) -> Column:
    return F.array(*[F.struct(F.lit(b).alias("block"), block(fingerprint, b).alias("value")) for b in range(BLOCKS)])


def similarity(a: Column, b: Column) -> Column:
    """Exact weighted Jaccard similarity of two arrays: equal values are paired off by their counts."""
    def count(values: Column, x: Column) -> Column:
        return F.size(F.filter(values, lambda y: y == x))

    common = F.aggregate(F.array_intersect(a, b), F.lit(0), lambda n, x: n + F.least(count(a, x), count(b, x)))
    return common / (F.size(a) + F.size(b) - common)


def leaks(docs: DataFrame, benchmark: DataFrame, least: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """Rows ``(doc_id, start, length, item_id, similarity)`` of all verified windows; start and length count words."""
    known = landed(items(benchmark), "items")
    seen = landed(
        windows(docs, known, least).withColumn("content", F.sha2(F.array_join(F.transform("window", lambda h: F.hex(h)), ""), 256)), "windows"
    )
    distinct = seen.groupBy("content").agg(F.first("window").alias("window")).where(F.size("window") > 0)
    printed = landed(distinct.withColumn("print", simhash(F.col("window"))), "fingerprints")
    wrong = radius // BLOCKS
    masks = [sum(1 << b for b in bits) for n in range(wrong + 1) for bits in combinations(range(BLOCK_BITS), n)]
    offsets = F.split(F.lit(",".join(map(str, masks))), ",").cast("array<int>")  # 2,517 numbers as one literal
    prints = known.withColumn("item_print", simhash(F.col("item")))
    index = prints.select("item_id", "item", "item_print", F.explode(blocks(F.col("item_print"))).alias("b")).select(
        "item_id", "item_print", "b.block", F.explode(F.transform(offsets, lambda m: m.bitwiseXOR(F.col("b.value")))).alias("value")
    )
    probes = printed.select("content", "print", F.explode(blocks(F.col("print"))).alias("b")).select("content", "print", "b.*")
    near = F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))) <= radius
    # Spark's estimate of the exploded index is far too low: it is joined by a shuffle, not broadcast.
    pairs = probes.join(index.hint("merge"), ["block", "value"]).where(near).select("content", "item_id").distinct()
    exact = similarity(F.col("window"), F.col("item"))
    verified = pairs.join(printed.select("content", "window"), "content").join(known, "item_id").withColumn("similarity", exact)
    good = verified.where(F.col("similarity") >= least).select("content", "item_id", "similarity")
    size = (F.size("window") + WORDS - 1).alias("length")
    return seen.join(good, "content").select("doc_id", "start", size, "item_id", "similarity")


def marked(docs: DataFrame, benchmark: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """One row per document: ``doc_id``, ``contaminated``, ``kept`` (the opposite), the leaked ``item_ids``, the largest ``similarity``."""
    found = leaks(docs, benchmark, least).groupBy("doc_id").agg(
        F.sort_array(F.collect_set("item_id")).alias("item_ids"), F.max("similarity").alias("similarity")
    )
    ids = docs.select("doc_id").withColumnRenamed("doc_id", "__id")
    rows = ids.join(found, ids["__id"].eqNullSafe(found["doc_id"]), "left")
    return rows.select(
        F.col("__id").alias("doc_id"),
        F.col("item_ids").isNotNull().alias("contaminated"),
        F.col("item_ids").isNull().alias("kept"),
        F.coalesce("item_ids", F.array().cast("array<bigint>")).alias("item_ids"),
        F.coalesce("similarity", F.lit(0.0)).alias("similarity"),
    )
