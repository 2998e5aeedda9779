"""What the operators share: landed tables, global ranks and the functions that travel with a job."""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusloom.session import scratch_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WHITE = r"\x20\x09-\x0D"


def travels(module: str) -> None:
    """Send the functions of a module with the job, so that executors need not have this package installed."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def landed(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to a new folder below ``spark.checkpoint.dir`` and read it back.

    This cuts the lineage: what follows reads files that all executors share, so a lost executor costs no earlier work
    and a value that was computed once is never computed differently again.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ranked(df: DataFrame, order: list, out: str, label: str) -> tuple[DataFrame, int]:
    """Add each row's place from 0 in a global order, and return it with the number of rows.

    Rows are range-partitioned and sorted once, and written. A row's place within its partition is part of its
    ``monotonically_increasing_id``; the sizes of the partitions (one row each) give the rest. The order should be total:
    rows that tie in all of ``order`` share a partition and take their places in any order.
    """
    sorted_rows = df.repartitionByRange(shuffle_parts(df.sparkSession), *order).sortWithinPartitions(*order)
    rows = landed(sorted_rows.withColumn("__id", F.monotonically_increasing_id()), label)
    part, place = F.shiftright("__id", 33), F.col("__id").bitwiseAND((1 << 33) - 1)
    sizes = rows.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__rows"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    starts = sizes.select("__part", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__start"))
    total = rows.count()
    placed = rows.withColumn("__part", part).join(F.broadcast(starts), "__part")
    return placed.withColumn(out, F.col("__start") + place).drop("__id", "__part", "__start"), total


def ascii_lower(column: Column | str) -> Column:
    return F.translate(column, UPPER, LOWER)
