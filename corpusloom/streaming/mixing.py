"""The exact weighted mix of streams, the same for any cut into micro-batches.

Every source has a clock: the sum of the arrival gaps of its rows so far. A row's arrival time is its source's clock after it, as in
``operators.mixing.interleave``, so it depends on the rows before it alone and not on batches. The mix ends where the first
source ends. Which one that is shows only at the end, but every source will end at its present clock or later: rows up to the
slowest clock are part of the mix, whatever comes, and are written; later ones wait until that clock has passed them.

A micro-batch ``k`` reads the state that batch ``k - 1`` left and writes its own beside it, so a batch that is repeated after a
failure replaces what it wrote before. State is one row per source (clock and last key) and one per part of waiting rows. Waiting
rows are written once, with their arrival time, and read again by a filter on it; parts that are used up are left out.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corpusloom.operators.mixing import arrival_gap, normalised
from corpusloom.operators.ordering import running_total

CLOCKS, PARTS = "source string, clock bigint, last bigint", "part bigint, latest bigint"


def _integers(column: str, values: Mapping[str, int]) -> Column:
    entries = [item for name, value in values.items() for item in (F.lit(name), F.lit(value).cast("bigint"))]
    return F.try_element_at(F.create_map(*entries), F.col(column))


class StreamMix:
    """Mix the sources of a stream by weight; rows ``t <= `` the slowest clock are written to ``path/out/batch=…``.

    ``weights`` names the sources that take part. A source without a row so far holds everything back, since it may be the one
    that ends first; leave sources that were not loaded out. Keys of a source rise from batch to batch (files or offsets in
    order); within a batch they may come in any order. A batch that goes back is an error, since its rows' places are past.
    Rows of other sources and rows without a key are left out.
    """

    def __init__(self, weights: Mapping[str, float], seed: int, path: str, source: str = "source", key: str = "key") -> None:
        self.shares, self.seed, self.path = normalised(weights), seed, path
        self.source, self.key = source, key

    def state(self, spark: SparkSession, batch: int) -> tuple[dict[str, int], dict[str, int], dict[int, int]]:
        """Clocks, last keys and waiting parts before a batch."""
        if batch == 0:
            return dict.fromkeys(self.shares, 0), {}, {}
        clocks = spark.read.schema(CLOCKS).parquet(f"{self.path}/clocks/batch={batch - 1}").collect()
        parts = spark.read.schema(PARTS).parquet(f"{self.path}/parts/batch={batch - 1}").collect()
        last = {r["source"]: r["last"] for r in clocks if r["last"] is not None}
        return {r["source"]: r["clock"] for r in clocks}, last, {r["part"]: r["latest"] for r in parts}

    def __call__(self, batch: DataFrame, number: int) -> None:
        """One micro-batch; to be given to ``foreachBatch``."""
        spark = batch.sparkSession
        clocks, last, waiting = self.state(spark, number)
        known = batch.where(F.col(self.source).isin(list(self.shares)) & F.col(self.key).isNotNull())
        done = min(clocks.values()) if number else -1
        gap = arrival_gap(self.source, self.key, self.shares, self.seed)
        timed = running_total(known, gap, [self.key], within=[self.source], out="t")
        timed = timed.withColumn("t", F.col("t") + _integers(self.source, clocks))
        timed.write.mode("overwrite").parquet(f"{self.path}/timed/part={number}")
        written = spark.read.schema(timed.schema).parquet(f"{self.path}/timed/part={number}")
        for row in written.groupBy(self.source).agg(F.max("t"), F.min(self.key), F.max(self.key)).collect():
            name, latest, low, high = row
            if name in last and low <= last[name]:
                raise ValueError(f"keys of source {name} go back from {last[name]} to {low}")
            clocks[name], last[name] = latest, high
            waiting[number] = max(latest, waiting.get(number, 0))
        now = min(clocks.values())
        ready = (F.col("t") > done) & (F.col("t") <= now)
        paths = [f"{self.path}/timed/part={part}" for part in waiting]
        rows = spark.read.schema(timed.schema).parquet(*paths).where(ready) if paths else written
        rows.write.mode("overwrite").parquet(f"{self.path}/out/batch={number}")
        left = [(part, latest) for part, latest in waiting.items() if latest > now]
        spark.createDataFrame(left, PARTS).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/parts/batch={number}")
        rows = [(name, clock, last.get(name)) for name, clock in clocks.items()]
        spark.createDataFrame(rows, CLOCKS).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/clocks/batch={number}")

    def start(self, stream: DataFrame, checkpoint: str) -> StreamingQuery:
        """Mix what the stream holds now; with the same checkpoint and path a later call goes on where this one ended."""
        writer = stream.writeStream.foreachBatch(self).option("checkpointLocation", checkpoint)
        return writer.trigger(availableNow=True).start()
