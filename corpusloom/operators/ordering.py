"""Row numbers, running totals, seeded shuffles and first-N over any number of rows.

A window without a partition key puts all rows into one task, and a window on a skewed key puts a third of them there.
Both are avoided by a two-level sum: rows are cut into buckets along the order key, each bucket gets its own total, the
totals (one row per bucket and group) become offsets, and only rows of one bucket are sorted together. The bucket is a
plain function of the row, so a task that is run again after an executor loss yields the same values, and results do not
depend on where the cuts lie.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusloom.functions.hashing import digest_integer, seeded_digest

ROWS_PER_BUCKET = 250_000
MAX_BUCKETS = 131_072  # at 100 TB a bucket holds less than 1 GB, which its task sorts with spilling
SAMPLED_PER_BUCKET = 64

_BUCKET = "__bucket"


def bucket_count(df: DataFrame, rows: int, rows_per_bucket: int | None = None) -> int:
    """Into how many buckets some rows are cut: at least one per shuffle partition, and more for many rows.

    Small and large inputs go the same way; only an input of a row or two has a single bucket.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wanted = max(-(-rows // (rows_per_bucket or ROWS_PER_BUCKET)), min(parts, rows // 2))
    return max(1, min(MAX_BUCKETS, wanted))


def key_bounds(
    df: DataFrame, key: str, rows_per_bucket: int | None = None, rows: int | None = None, buckets: int | None = None
) -> list:
    """Cut points that split a numeric order key into buckets of about ``rows_per_bucket`` rows.

    They are quantiles of a sample that is chosen by hash, of a fixed number of keys per bucket, so the pass stays cheap
    for any input. The driver receives at most ``MAX_BUCKETS`` numbers. The cuts only steer the balance of the work.
    """
    if rows is None:
        rows = df.where(F.col(key).isNotNull()).count()
    buckets = buckets or bucket_count(df, rows, rows_per_bucket)
    if buckets <= 1:
        return []
    every = max(1, rows // (buckets * SAMPLED_PER_BUCKET))
    sample = df.select(key) if every == 1 else df.select(key).where(F.pmod(F.xxhash64(key), F.lit(every)) == 0)
    points = constants([i / buckets for i in range(1, buckets)], "double")
    cuts = sample.agg(F.percentile_approx(key, points, F.lit(max(10_000, 4 * buckets)))).first()[0]
    return sorted(set(cuts or []))


def constants(values: Sequence, kind: str) -> Column:
    """An array of constants, written as one string that the optimizer turns into a literal."""
    return F.split(F.lit(",".join(str(v) for v in values)), ",").cast(f"array<{kind}>")


def bucket_of(key: Column, bounds: Sequence) -> Column:
    """How many cut points are <= key: a binary search inside one expression."""
    if not bounds:
        return F.lit(0)
    cuts = constants(bounds, "bigint" if all(isinstance(b, int) for b in bounds) else "double")
    steps = [1 << i for i in range(len(bounds).bit_length())]
    return F.aggregate(
        constants(reversed(steps), "int"),
        F.lit(0),
        lambda low, s: F.when(F.get(cuts, low + s - 1) <= key, low + s).otherwise(low),
    )


def running_total(
    df: DataFrame,
    value: Column,
    order: Sequence[str],
    within: Sequence[str] = (),
    out: str = "running_total",
    rows_per_bucket: int | None = None,
    bucket: Column | None = None,
    heads: DataFrame | None = None,
) -> DataFrame:
    """Add the running sum of ``value`` (this row included) in ``order``, separately for each group of ``within``.

    The first order column must be numeric and close to unique within a group; the others break ties. ``bucket`` may be
    passed when some expression already splits the rows in order, and ``heads`` when the totals of the earlier buckets are known
    as rows of the group's columns, ``__bucket`` and ``__value``.
    """
    keys = list(within)
    if bucket is None:
        bounds = key_bounds(df, order[0], rows_per_bucket)
        if not bounds:
            alone = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
            return df.withColumn(out, F.sum(value).over(alone))
        bucket = bucket_of(F.col(order[0]), bounds)
    parts = df.withColumns({_BUCKET: bucket, "__value": value, "__row": F.lit(1)})
    # The total of the earlier buckets enters each bucket as a row of its own, ahead of all others. The rows are thus
    # moved once and joined with nothing.
    heads = (bucket_offsets(parts, F.col("__value"), keys) if heads is None else heads).withColumn("__row", F.lit(0))
    window = Window.partitionBy(*keys, _BUCKET).orderBy("__row", *order)
    return (
        parts.unionByName(heads, allowMissingColumns=True)
        .withColumn(out, F.sum("__value").over(window.rowsBetween(Window.unboundedPreceding, 0)))
        .where("__row = 1")
        .drop(_BUCKET, "__value", "__row")
    )


def bucket_offsets(parts: DataFrame, value: Column, keys: Sequence[str]) -> DataFrame:
    """Per group and bucket, the total of all earlier buckets. At most ``MAX_BUCKETS`` rows per group are sorted."""
    totals = parts.groupBy(*keys, _BUCKET).agg(F.sum(value).alias("__total"))
    before = Window.partitionBy(*keys).orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    return totals.withColumn("__value", F.coalesce(F.sum("__total").over(before), F.lit(0))).drop("__total")


def numbered(
    df: DataFrame,
    order: Sequence[str],
    within: Sequence[str] = (),
    out: str = "row_number",
    rows_per_bucket: int | None = None,
    bucket: Column | None = None,
) -> DataFrame:
    """Row numbers from 1 in ``order`` within each group."""
    return running_total(df, F.lit(1).cast("bigint"), order, within, out, rows_per_bucket, bucket)


def seeded_shuffle(df: DataFrame, key: str, seed: int, out: str = "position") -> DataFrame:
    """Add the place of every row in a seeded random order: by digest of seed and key, then by key.

    Digests are evenly spread, so their leading digits are the buckets and no quantile pass is needed; their number follows
    the number of rows. Only a bounded frame can be shuffled.
    """
    require_bounded(df, "a shuffle")
    hashed = df.withColumn("__digest", seeded_digest(seed, key))
    buckets, digits = bucket_count(df, df.count()), 1
    while 16**digits < buckets:
        digits += 1
    bucket = digest_integer(F.col("__digest"), digits)
    return numbered(hashed, ["__digest", key], out=out, bucket=bucket).drop("__digest")


def first_n(df: DataFrame, n: int, key: str, rows_per_bucket: int | None = None) -> DataFrame:
    """The ``n`` rows with the smallest unique key, as a filter on the key.

    The key of the n-th row is found on the key column alone, bucket by bucket; the rows themselves are then read with a
    predicate that reaches the scan, and are neither sorted nor moved.
    """
    require_bounded(df, "a first-N sample")
    limit = rows_per_bucket or ROWS_PER_BUCKET  # keys alone, so a bucket of them is small
    if n <= 0:
        return df.where(F.lit(False))
    known = df.where(F.col(key).isNotNull())  # a row without a key has no place
    keys, wanted = known.select(key), n
    while (rows := keys.count()) > limit:
        bounds = key_bounds(keys, key, rows=rows, buckets=min(MAX_BUCKETS, -(-rows // limit)))
        sizes = {r[0]: r[1] for r in keys.groupBy(bucket_of(F.col(key), bounds)).count().collect()}
        chosen = None
        for b in sorted(sizes):
            if wanted <= sizes[b]:
                chosen = b
                break
            wanted -= sizes[b]
        if chosen is None:
            return known
        if chosen > 0:
            keys = keys.where(F.col(key) >= F.lit(bounds[chosen - 1]))
        if chosen < len(bounds):
            keys = keys.where(F.col(key) < F.lit(bounds[chosen]))
        if sizes[chosen] == sum(sizes.values()):
            break  # the cuts no longer narrow the range
    last, found = keys.orderBy(key).limit(wanted).agg(F.max(key), F.count(F.lit(1))).first()
    return known if found < wanted else df.where(F.col(key) <= F.lit(last))


def require_bounded(df: DataFrame, what: str) -> None:
    if df.isStreaming:
        raise ValueError(f"{what} needs a bounded frame; set a step limit for streams instead")
