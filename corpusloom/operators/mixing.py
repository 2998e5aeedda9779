"""Weighted interleaving of sources."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusloom.functions.hashing import uniform
from corpusloom.operators.ordering import bucket_count, bucket_of, key_bounds, numbered, require_bounded, running_total
from corpusloom.session import landed

# Arrival gaps are whole multiples of 2**-20, so that sums do not depend on the order of addition.
CLOCK_SCALE = float(1 << 20)

# Fixed value: steps of a streaming run that sets no limit.
DEFAULT_STEPS = 10_000


def parse_weights(text: str | None, defaults: list[float]) -> list[float]:
    """Comma-separated weights; positions that are not given keep their default."""
    given = [float(w) for w in text.split(",")] if text else []
    return [given[i] if i < len(given) else default for i, default in enumerate(defaults)]


def normalised(weights: Mapping[str, float]) -> dict[str, float]:
    """Shares of the sources that take part; a source of weight 0 never gets a turn and is left out."""
    for name, weight in weights.items():
        if weight < 0 or math.isnan(weight) or math.isinf(weight):
            raise ValueError(f"weight of {name} must be a non-negative number, not {weight}")
    total = sum(weights.values())
    if total <= 0:
        raise ValueError("at least one source needs a positive weight")
    return {name: weight / total for name, weight in weights.items() if weight > 0}


def union_sources(frames: Mapping[str, DataFrame], source: str = "source") -> DataFrame:
    """All sources one below the other, tagged with their name; columns a source lacks are NULL."""
    tagged = [df.withColumn(source, F.lit(name)) for name, df in frames.items()]
    whole = tagged[0]
    for df in tagged[1:]:
        whole = whole.unionByName(df, allowMissingColumns=True)
    return whole


def lookup(column: str, values: Mapping[str, float]) -> Column:
    """The number that a small driver-side mapping gives for a column, NULL where it has none."""
    entries = [item for name, value in values.items() for item in (F.lit(name), F.lit(float(value)))]
    return F.try_element_at(F.create_map(*entries), F.col(column))


def arrival_gap(source: str, key: str, shares: Mapping[str, float], seed: int) -> Column:
    """Waiting time of a row after its predecessor: exponential, with the share of its source as the rate."""
    gap = -F.ln(uniform(seed, source, key)) / lookup(source, shares)
    return F.round(gap * F.lit(CLOCK_SCALE)).cast("bigint")


def interleave(
    df: DataFrame,
    weights: Mapping[str, float],
    seed: int,
    source: str = "source",
    key: str = "key",
    position: str | None = None,
    rows_per_bucket: int | None = None,
) -> DataFrame:
    """Mix sources by weight until the first of them is used up.

    Each row gets an arrival time ``t``: the sum of exponential gaps up to it within its source, in key order. Merging
    such arrival processes draws the source of every slot independently with the given shares. The mix ends at the
    earliest last arrival, which is simply the smallest sum of gaps, so the cut is known before any row is sorted, and
    buckets that start beyond it are dropped before the shuffle.

    Sources without rows count as not loaded. One remaining source passes through whole. ``key`` is a numeric order key,
    unique within a source. The result is ordered by ``t``, source, key; ``position`` adds the place in that order.
    """
    require_bounded(df, "an exact mix")
    parts = df.where(F.col(source).isin(list(normalised(weights))))
    rows = {r[0]: r[1] for r in parts.groupBy(source).count().collect()}
    if not rows:
        raise ValueError("no source has any row")
    shares = normalised({name: weights[name] for name in rows})
    bounds = key_bounds(parts, key, rows_per_bucket, rows=sum(rows.values()))
    gap, bucket = arrival_gap(source, key, shares, seed), bucket_of(F.col(key), bounds)
    clocks = bucket_clocks(parts.select(source, bucket.alias("__bucket"), gap.alias("__value")), source)
    # One number per source each: where its clock ends, and the last bucket that begins before the mix ends.
    cut = min(r[1] for r in clocks.groupBy(source).agg(F.max(F.col("__value") + F.col("__total"))).collect())
    if len(shares) > 1:
        clocks = clocks.where(F.col("__value") <= cut)
        near = {r[0]: r[1] for r in clocks.groupBy(source).agg(F.max("__bucket")).collect()}
        parts = parts.where(bucket <= lookup(source, near))
    heads = clocks.select(source, "__bucket", "__value")
    mixed = running_total(parts, gap, [key], within=[source], out="t", bucket=bucket, heads=heads)
    if len(shares) > 1:
        mixed = mixed.where(F.col("t") <= F.lit(cut))
    if position is None:
        return mixed
    return place_by_time(mixed, cut, source, key, position, sum(rows.values()), rows_per_bucket)


def bucket_clocks(gaps: DataFrame, source: str) -> DataFrame:
    """Rows ``(source, __bucket, __total, __value)``: the gaps of every bucket, and those of all earlier ones of its source.

    A table of at most ``MAX_BUCKETS`` rows per source, in the shared folder.
    """
    totals = landed(gaps.groupBy(source, "__bucket").agg(F.sum("__value").alias("__total")), "clocks")
    before = Window.partitionBy(source).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    return totals.withColumn("__value", F.coalesce(F.sum("__total").over(before), F.lit(0)))


def place_by_time(
    mixed: DataFrame, last: int, source: str, key: str, out: str, rows: int, rows_per_bucket: int | None = None
) -> DataFrame:
    """Add the place of every row by arrival time. Arrivals are spread evenly, so equal time slices are the buckets."""
    slices = bucket_count(mixed, rows, rows_per_bucket)
    width = max(1, -(-(last + 1) // slices))
    return numbered(mixed, ["t", source, key], out=out, bucket=F.floor(F.col("t") / F.lit(width)))


def row_budget(
    mixed: DataFrame,
    max_steps: int,
    per_device_batch: int,
    accumulation: int = 1,
    replicas: int = 1,
    unbounded: bool = False,
    position: str = "position",
) -> DataFrame:
    """Keep the rows that a run will consume: all of them without a step limit.

    ``unbounded`` says that the run reads an endless stream; without a limit it gets 10,000 steps.
    """
    if max_steps <= 0:
        if not unbounded:
            return mixed
        max_steps = DEFAULT_STEPS
    return mixed.where(F.col(position) <= F.lit(max_steps * per_device_batch * accumulation * replicas))
