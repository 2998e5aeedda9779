"""Hilbert-curve shards: rows that are close in several metadata dimensions come to lie in the same shard and files.

Each dimension is quantised to ``BITS`` bits: numbers by their logarithm (half octaves; six bits hold all numbers below 2 ** 31,
and so the size of any text, seven those of 64 bits), names by their place among the distinct names. The cell's place on the Hilbert curve is the first sort key, the text's hash the second, doc_id the last, and the sorted rows are cut into
shards whose row counts differ by one at most (law ``rows``). Rows of equal text take the smallest place of their group,
so a group of copies is one run, which at most the fixed cuts divide.

Defined results: a NULL dimension is a cell of its own (0); a NULL text has size 1, crc 0 and counts as the empty text;
a NULL doc_id sorts first; repeated rows each get a slot; an empty table gives an empty result. ``shards`` passes all
columns of its input through, except ``shard``, ``slot`` and names that begin with ``__``.

Native: expressions, one aggregation, one range partitioning. A hot group of copies is spread by doc_id in the range
partitioning; the join that carries the group's place back is dealt again by Spark where one text has most rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import landed, ranked

BITS = 6


def log_cell(value: Column, bits: int = BITS) -> Column:
    """A positive whole number's half octave: twice its number of bits, and its second bit; NULL and the others are 0."""
    binary = F.bin(value.cast("bigint"))
    cell = F.length(binary) * 2 + (F.substring(binary, 2, 1) == "1").cast("int")
    return F.when(value > 0, F.least(cell, F.lit((1 << bits) - 1))).otherwise(0).cast("int")


def with_name_cells(docs: DataFrame, names: Mapping[str, str], bits: int = BITS) -> DataFrame:
    """Add cells of name columns, ``{new column: name column}``: the distinct names in order, cut into equal runs; NULL is 0.

    The cells keep the order of the names, which hashes would not, so the smallest and largest name of a file say what it holds.
    Names are ranked by a range partitioning. Their table is broadcast only if Spark finds its files small.
    """
    last = (1 << bits) - 1
    for cell, name in names.items():
        found, total = ranked(docs.where(F.col(name).isNotNull()).select(F.col(name).alias("__name")).distinct(), ["__name"], "__rank", "names")
        numbered = landed(found.select("__name", F.expr(f"cast(__rank * {last} div {max(1, total)} + 1 as int)").alias("__of")), "name-cells")
        docs = docs.join(numbered, docs[name] == F.col("__name"), "left").withColumn(cell, F.coalesce("__of", F.lit(0))).drop("__name", "__of")
    return docs


def hilbert_index(cells: Sequence[Column], bits: int = BITS) -> Column:
    """The place of a cell on the Hilbert curve through ``2 ** bits`` cells in each dimension.

    Gray decoding with exchanged and inverted axes: from the highest bit down, each axis either inverts the lower bits
    of the first one or exchanges them with it. The steps are folded over an array of ``(bit, axis)``.
    """
    n = len(cells)
    steps = F.array(*[F.struct(F.lit(1 << b).alias("q"), F.lit(i).alias("i")) for b in range(bits - 1, 0, -1) for i in range(n)])
    start = F.array(*[c.cast("int") for c in cells])

    def turn(x: Column, s: Column) -> Column:
        low, first, other = s["q"] - 1, F.get(x, F.lit(0)), F.get(x, s["i"])
        inverted = F.transform(x, lambda v, j: F.when(j == 0, v.bitwiseXOR(low)).otherwise(v))
        differ = first.bitwiseXOR(other).bitwiseAND(low)
        exchanged = F.transform(x, lambda v, j: F.when((j == 0) | (j == s["i"]), v.bitwiseXOR(differ)).otherwise(v))
        same = F.when(s["i"] == 0, x).otherwise(exchanged)
        return F.when(other.bitwiseAND(s["q"]) != 0, inverted).otherwise(same)

    turned = F.aggregate(steps, start, turn)
    # Gray encoding: each axis is combined with the one before it, then all with the parity of the last axis' higher bits.
    coded = F.aggregate(
        turned,
        F.array().cast("array<int>"),
        lambda done, v: F.concat(done, F.array(F.when(F.size(done) == 0, v).otherwise(v.bitwiseXOR(F.get(done, F.size(done) - 1))))),
    )
    higher = F.array(*[F.lit(1 << b) for b in range(bits - 1, 0, -1)])

    def parity(c: Column) -> Column:
        return F.aggregate(
            higher, F.lit(0), lambda t, q: F.when(F.get(c, F.lit(n - 1)).bitwiseAND(q) != 0, t.bitwiseXOR(q - 1)).otherwise(t)
        )

    # The index takes one bit of every axis in turn, highest bits first.
    wanted = F.array(*[F.struct(F.lit(b).alias("b"), F.lit(i).alias("i")) for b in range(bits - 1, -1, -1) for i in range(n)])
    packed = F.transform(F.array(F.struct(coded.alias("c"))), lambda s: F.struct(s["c"].alias("c"), parity(s["c"]).alias("t")))
    return F.element_at(
        F.transform(
            packed,
            lambda s: F.aggregate(
                wanted,
                F.lit(0).cast("bigint"),
                lambda h, w: h * 2 + F.get(s["c"], w["i"]).bitwiseXOR(s["t"]).bitwiseAND(F.call_function("shiftleft", F.lit(1), w["b"])).cast("boolean").cast("bigint"),
            ),
        ),
        1,
    )


def shards(docs: DataFrame, cells: Sequence[Column], count: int, group: Column, tie: str = "doc_id", bits: int = BITS) -> DataFrame:
    """Add ``shard`` (0 to ``count`` - 1) and ``slot`` (from 0 within the shard). Rows of one ``group`` stay in one run."""
    rows = docs.select(*[c for c in docs.columns if c not in ("shard", "slot")], hilbert_index(cells, bits).alias("__own"), group.alias("__group"))
    rows = landed(rows, "cells")
    # Landed, so that both sides of the join are dealt out for it alone and Spark may split a text that most rows share.
    first = landed(rows.groupBy("__group").agg(F.min("__own").alias("__cell")), "groups")
    placed, total = ranked(rows.drop("__own").join(first, "__group"), ["__cell", "__group", tie], "__rank", "curve")
    shard = F.expr(f"__rank * {count} div {max(1, total)}")
    first_rank = F.expr(f"(shard * {max(1, total)} + {count - 1}) div {count}")
    cut = placed.withColumn("shard", shard.cast("int")).withColumn("slot", (F.col("__rank") - first_rank).cast("bigint"))
    return cut.drop("__rank", "__cell", "__group")


def document_shards(docs: DataFrame, count: int) -> DataFrame:
    """Shards of documents by language, source and size: rows ``(doc_id, size, text_crc32, shard, slot)``."""
    text = F.coalesce("text", F.lit(""))
    size = (F.octet_length(text) + 1).cast("bigint")
    group = F.md5(text)  # the text itself is not moved
    rows = docs.select(
        "doc_id", size.alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), "lang", "source", log_cell(size).alias("__size"), group.alias("__text")
    )
    rows = with_name_cells(rows, {"__lang": "lang", "__source": "source"})
    placed = shards(rows, [F.col("__lang"), F.col("__source"), F.col("__size")], count, F.col("__text"))
    return placed.select("doc_id", "size", "text_crc32", "shard", "slot")


def write_shards(docs: DataFrame, cells: Sequence[Column], count: int, group: Column, path: str) -> None:
    """Write the rows as one folder per shard, each file a run of the curve, so that file statistics prune all dimensions."""
    rows = shards(docs, cells, count, group)
    rows.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
