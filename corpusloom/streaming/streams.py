"""Streaming forms of the operators.

Rendering, text pick and encoding are stateless and work on streaming frames unchanged. Here are the parts that need
another form: mixing by rate, and running averages.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from corpusloom.functions.hashing import uniform
from corpusloom.operators.mixing import lookup, normalised


def thinning_rates(weights: Mapping[str, float], expected_rows: Mapping[str, float]) -> dict[str, float]:
    """Share of each source to keep so that the kept rows follow the weights; the scarcest source is kept whole."""
    shares = normalised({name: w for name, w in weights.items() if expected_rows.get(name, 0) > 0})
    density = {name: share / expected_rows[name] for name, share in shares.items()}
    fullest = max(density.values())
    return {name: value / fullest for name, value in density.items()}


def mix_by_rate(
    df: DataFrame, rates: Mapping[str, float], seed: int, source: str = "source", key: str = "key"
) -> DataFrame:
    """Weighted mix without state: a row stays when its seeded draw is below the rate of its source."""
    return df.where(F.col(source).isin(list(rates))).where(uniform(seed, source, key) < lookup(source, rates))


def running_averages(metrics: DataFrame) -> DataFrame:
    """Mean and number of values of each metric so far; for update or complete mode."""
    return metrics.groupBy("key").agg(F.avg("value").alias("mean"), F.count(F.lit(1)).alias("n"))


class NewestValues(StatefulProcessor):
    """Keeps each metric's ``n`` values of the highest steps in the state store, and their mean.

    Values lie in numbered slots in the order of their steps, one store entry each. A value that arrives in order is written behind
    the last slot, and the first slot is cleared once there are more than ``n``; a late value moves those of higher steps up by one.
    Nothing else is read or written: the sum is carried along, with the rounding errors of its additions apart.
    """

    def __init__(self, n: int) -> None:
        self.n = n

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.summary = handle.getValueState("summary", "first bigint, size bigint, total double, lost double, odd bigint")
        self.slots = handle.getMapState("slots", "slot bigint", "step bigint, value double")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        new = pd.concat(list(rows))[["step", "value"]].sort_values("step", kind="stable").tail(self.n)
        first, size, total, lost, odd = self.summary.get() if self.summary.exists() else (0, 0, 0.0, 0.0, 0)

        def added(value: float, sign: int) -> None:
            nonlocal total, lost, odd
            if not math.isfinite(value):
                odd += sign
                return
            value *= sign
            whole = total + value
            lost += (total - whole) + value if abs(total) >= abs(value) else (value - whole) + total
            total = whole

        for step, value in zip(new["step"].astype("int64").tolist(), new["value"].astype("float64").tolist(), strict=True):
            if size == self.n and self.slots.getValue((first,))[0] >= step:
                continue  # older than all that are kept
            slot = first + size
            while slot > first and (before := self.slots.getValue((slot - 1,)))[0] > step:
                self.slots.updateValue((slot,), tuple(before))
                slot -= 1
            self.slots.updateValue((slot,), (step, value))
            added(value, 1)
            size += 1
            if size > self.n:
                added(self.slots.getValue((first,))[1], -1)
                self.slots.removeKey((first,))
                first, size = first + 1, self.n
        self.summary.update((first, size, total, lost, odd))
        if odd:
            mean = float(np.mean([value for _, value in self.slots.values()]))
        else:
            mean = (total + lost) / size
        yield pd.DataFrame({"key": [key[0]], "mean": [mean], "n": [size]})

    def close(self) -> None:
        pass


def last_n_averages(metrics: DataFrame, n: int) -> DataFrame:
    """Mean of each metric's ``n`` values with the highest steps so far, whatever order they arrive in.

    The state of a metric is at most ``n`` values, of which a batch touches the newest and oldest (``NewestValues``). Each task
    first cuts its own rows to the newest ``n`` per metric, so the stateful stage receives little even when one metric has most
    of the rows. The mean is NULL while a NaN is among the values. Start such a stream within ``entry_states``.
    """

    def newest(rows: pd.DataFrame) -> pd.DataFrame:
        return rows.sort_values("step", ascending=False, kind="stable").groupby("key", sort=False).head(n)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept = None
        for batch in batches:
            kept = newest(batch if kept is None else pd.concat([kept, batch]))
        if kept is not None:
            yield kept

    return (
        metrics.select("key", "step", "value")
        .mapInPandas(cut, "key string, step bigint, value double")
        .groupBy("key")
        .transformWithStateInPandas(NewestValues(n), "key string, mean double, n bigint", "Update", "None")
    )


@contextmanager
def entry_states(spark: SparkSession) -> Iterator[None]:
    """Streams that start herein keep their state in a store of single entries, whose checkpoints hold what changed."""
    wanted = {
        "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def each_batch(df: DataFrame, action: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Run a batch operator, such as the exact mix, on every micro-batch of what a stream holds now.

    ``action`` gets the batch number and may be called again with the same one after a failure.
    """
    return (
        df.writeStream.foreachBatch(action)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def save_latest(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write each update of a keyed stream below ``path``, one folder per micro-batch; a repeat replaces its folder."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    with entry_states(df.sparkSession):
        return (
            df.writeStream.outputMode("update")
            .foreachBatch(write)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
