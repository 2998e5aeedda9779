"""Reports on training runs: metric logs, tensor health, model size, checkpoints, run time."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from corpusloom.operators.ordering import ROWS_PER_BUCKET, numbered

# Values of one metric that a summary row holds at most; longer series continue in further rows.
VALUES_PER_PART = 65_536

# Limits of the health classes and names that are always reported.
COLLAPSED_BELOW = 1e-6
REPORTED_NAMES = ("embed", "layers.0")

# Up to so many rows of a group Spark's optimizer cuts groups before it shuffles them; the results are the same beyond.
GROUP_LIMIT = 1000

NAMES_HELD = 100_000  # tensors whose moments a task combines before it hands them on

MIB = 1024 * 1024


# Metric log ---------------------------------------------------------------------------------------------------------


def metric_log(metrics: DataFrame, interval: int = 100, rows_per_bucket: int | None = None) -> DataFrame:
    """At every ``interval``-th step, for every metric seen so far, the mean of its last ``interval`` values.

    ``metrics`` has ``step, key, value`` with at most one value per step and key. Values are numbered per key, cut into
    blocks, and each block also receives the few values before it that its first means need and the one after it, so a
    metric with most of the values is spread over many tasks. A mean is valid until the metric's next value; the log
    steps that fall into that span are its output rows.
    """
    last = metrics.agg(F.max("step")).first()[0]
    if last is None or last < interval:
        return metrics.select(F.lit(0).cast("bigint").alias("log_step"), "key", F.lit(0.0).alias("mean")).where("false")
    block_rows = max(rows_per_bucket or ROWS_PER_BUCKET, interval)
    rows = numbered(metrics.select("step", "key", "value"), ["step"], ["key"], "n", rows_per_bucket)
    block, place = F.floor((F.col("n") - 1) / block_rows), (F.col("n") - 1) % block_rows
    following = F.when(place > block_rows - interval, block + 1)
    preceding = F.when((place == 0) & (block > 0), block - 1)
    spread = rows.withColumn("home", block).withColumn(
        "block", F.explode(F.array_compact(F.array(block, following, preceding)))
    )
    ordered = Window.partitionBy("key", "block").orderBy("n")
    means = spread.select(
        "key",
        "step",
        (F.col("home") == F.col("block")).alias("own"),
        F.avg("value").over(ordered.rowsBetween(1 - interval, 0)).alias("mean"),
        F.lead("step", 1, last + 1).over(ordered).alias("until"),
    ).where("own")
    first_log = F.ceil(F.col("step") / interval) * interval
    last_log = F.floor((F.col("until") - 1) / interval) * interval
    return means.where(first_log <= last_log).select(
        F.explode(F.sequence(first_log, last_log, F.lit(interval).cast("bigint"))).alias("log_step"), "key", "mean"
    )


def metric_averages(
    metrics: DataFrame, last_n: int | None = None, keys: Sequence[str] | None = None, rows_per_bucket: int | None = None
) -> DataFrame:
    """Mean of every metric, of its last ``last_n`` values if given. Asked ``keys`` that do not occur get 0.0."""
    chosen = metrics
    if last_n:
        # Spark keeps only the first last_n rows per key on the map side before it shuffles them.
        newest = Window.partitionBy("key").orderBy(F.col("step").desc())
        if last_n <= GROUP_LIMIT:
            chosen = metrics.withColumn("age", F.row_number().over(newest)).where(F.col("age") <= last_n)
        else:
            # A value without a step is the oldest, as in the window above.
            backwards = metrics.withColumn("__back", F.coalesce(-F.col("step"), F.lit((1 << 63) - 1)))
            chosen = numbered(backwards, ["__back"], ["key"], "age", rows_per_bucket).where(F.col("age") <= last_n)
    means = chosen.groupBy("key").agg(F.avg("value").alias("mean"))
    if keys is None:
        return means
    asked = metrics.sparkSession.createDataFrame([(k,) for k in keys], "key string")
    return asked.join(means, "key", "left").select("key", F.coalesce("mean", F.lit(0.0)).alias("mean"))


def metric_summary(
    metrics: DataFrame, values_per_part: int = VALUES_PER_PART, rows_per_bucket: int | None = None
) -> DataFrame:
    """All values of every metric in step order with their overall mean, and the number of steps.

    A row holds at most ``values_per_part`` values; ``part`` numbers the rows of a metric.
    """
    rows = numbered(metrics.select("step", "key", "value"), ["step"], ["key"], "n", rows_per_bucket)
    parts = (
        rows.groupBy("key", F.floor((F.col("n") - 1) / values_per_part).alias("part"))
        .agg(F.array_sort(F.collect_list(F.struct("n", "value"))).alias("entries"))
        .select("key", "part", F.transform("entries", lambda e: e["value"]).alias("values"))
    )
    means = metrics.groupBy("key").agg(F.avg("value").alias("average"))
    steps = metrics.agg(F.max("step")).first()[0]
    return parts.join(means, "key").withColumn("step", F.lit(steps))


def save_metric_report(metrics: DataFrame, path: str) -> None:
    metric_summary(metrics).write.mode("overwrite").json(path)


# Tensor health ------------------------------------------------------------------------------------------------------


def tensor_moments(tensors: DataFrame, name: str = "name", values: str = "values") -> DataFrame:
    """Rows ``(name, numel, has_nan, has_inf, n, mean, m2)``: one per tensor and task, over the arrays that the task has seen.

    ``m2`` is the sum of squared distances from ``mean``. Arrays are taken as whole columns; no element becomes a row. Moments of
    arrays of one tensor are combined pairwise (Chan's rule), which loses no digits where the mean is far from zero.
    """

    names = ["name", "numel", "has_nan", "has_inf", "n", "mean", "m2"]
    kinds = [pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.int64(), pa.float64(), pa.float64()]

    def record(parts: dict[str | None, list]) -> pa.RecordBatch:
        columns = [list(parts), *([p[i] for p in parts.values()] for i in range(6))]
        return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[str | None, list] = {}
        for batch in batches:
            keys = batch.column(0).to_pylist()
            codes = {key: i for i, key in enumerate(dict.fromkeys(keys))}
            lists = batch.column(1)
            of_row = np.array([codes[k] for k in keys], np.int64)
            flat = lists.flatten()
            of_value = np.repeat(of_row, lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            numel = np.bincount(of_value, minlength=len(codes))
            known = flat.is_valid().to_numpy(zero_copy_only=False)
            x = flat.to_numpy(zero_copy_only=False)[known].astype(np.float64)
            of_value = of_value[known]
            with np.errstate(invalid="ignore", divide="ignore"):
                n = np.bincount(of_value, minlength=len(codes))
                mean = np.bincount(of_value, x, len(codes)) / n
                x0 = x - mean[of_value]
                rest = np.bincount(of_value, x0, len(codes)) / n  # what rounding left of the mean
                mean, m2 = mean + rest, np.bincount(of_value, (x0 - rest[of_value]) ** 2, len(codes))
            nan = np.bincount(of_value, np.isnan(x), len(codes)) > 0
            inf = np.bincount(of_value, np.isinf(x), len(codes)) > 0
            for key, i in codes.items():
                new = [int(numel[i]), bool(nan[i]), bool(inf[i]), int(n[i]), float(mean[i]) if n[i] else 0.0, float(m2[i])]
                parts[key] = merged_moments(parts[key], new) if key in parts else new
            if len(parts) > NAMES_HELD:
                yield record(parts)
                parts = {}
        if parts:
            yield record(parts)

    kept = tensors.select(F.col(name).cast("string"), values)
    return kept.mapInArrow(run, "name string, numel bigint, has_nan boolean, has_inf boolean, n bigint, mean double, m2 double")


def merged_moments(a: list, b: list) -> list:
    """Counts, flags, mean and squared distances of two sets of values together."""
    n = a[3] + b[3]
    if not a[3] or not b[3]:
        mean, m2 = (b if b[3] else a)[4:]
    else:
        apart = b[4] - a[4]
        mean, m2 = a[4] + apart * b[3] / n, a[5] + b[5] + apart * apart * a[3] * b[3] / n
    return [a[0] + b[0], a[1] or b[1], a[2] or b[2], n, mean, m2]


def tensor_statistics(tensors: DataFrame, name: str = "name", values: str = "values") -> DataFrame:
    """Per tensor: element count, mean, sample deviation, whether NaN or infinite values occur, and health class.

    A tensor may be stored in any number of rows. Only floating-point tensors are looked at. NULL elements count as elements,
    but have no part in mean and deviation. At most one row per tensor and task is moved and gathered.
    """
    kind = tensors.schema[values].dataType
    if not (isinstance(kind, T.ArrayType) and isinstance(kind.elementType, (T.FloatType, T.DoubleType))):
        raise ValueError(f"{values} must hold floating-point numbers")
    parts = tensor_moments(tensors, name, values).groupBy("name").agg(
        F.sum("numel").alias("numel"),
        F.max("has_nan").alias("has_nan"),
        F.max("has_inf").alias("has_inf"),
        F.array_sort(F.collect_list(F.when(F.col("n") > 0, F.struct("n", "mean", "m2")))).alias("parts"),
    )
    # Chan's rule again, over the tasks.
    whole = F.expr("""aggregate(parts, named_struct('n', 0L, 'mean', 0D, 'm2', 0D), (a, b) -> named_struct(
        'n', a.n + b.n,
        'mean', if(a.n = 0, b.mean, a.mean + (b.mean - a.mean) * b.n / (a.n + b.n)),
        'm2', if(a.n = 0, b.m2, a.m2 + b.m2 + (b.mean - a.mean) * (b.mean - a.mean) * a.n * b.n / (a.n + b.n))))""")
    stats = parts.withColumn("whole", whole).select(
        F.col("name").alias(name),
        "numel",
        "has_nan",
        "has_inf",
        F.when(F.col("whole.n") > 0, F.col("whole.mean")).alias("mean"),
        F.when(F.col("whole.n") > 1, F.sqrt(F.col("whole.m2") / (F.col("whole.n") - 1))).alias("std"),
    )
    return stats.withColumn("health", health_class(F.col("has_nan"), F.col("has_inf"), F.col("std")))


def health_class(has_nan: Column, has_inf: Column, std: Column) -> Column:
    """First match wins; a tensor of one element has no deviation and counts as ok."""
    return (
        F.when(has_nan | has_inf, F.lit("nan_inf"))
        .when(std == 0, F.lit("dead"))
        .when(std < COLLAPSED_BELOW, F.lit("collapsed"))
        .otherwise(F.lit("ok"))
    )


def reported_tensors(stats: DataFrame, name: str = "name") -> DataFrame:
    """Tensors worth a line in the report: unhealthy ones and those with a well-known name."""
    wanted = F.col("health") != "ok"
    for part in REPORTED_NAMES:
        wanted = wanted | F.col(name).contains(part)
    return stats.where(wanted)


def tensor_summary(stats: DataFrame, name: str = "name", examples: int = 5) -> DataFrame:
    """One row: totals, number and first examples of broken and of collapsed tensors, and the verdict.

    Dead tensors are counted but, as in the verdict's definition, do not make it unhealthy.
    """
    totals = stats.agg(
        F.coalesce(F.sum("numel"), F.lit(0)).alias("total_elements"),
        F.count_if(F.col("health") == "nan_inf").alias("bad_count"),
        F.count_if(F.col("health") == "collapsed").alias("small_std_count"),
        F.count_if(F.col("health") == "dead").alias("dead_count"),
    )
    rows = totals
    for health, out in (("nan_inf", "bad_examples"), ("collapsed", "small_std_examples")):
        # A top-k over names, so that a long list of broken tensors is never gathered.
        top = stats.where(F.col("health") == health).select(F.col(name).alias(out)).orderBy(out).limit(examples)
        rows = rows.unionByName(top, allowMissingColumns=True)
    # One row of totals and a few of examples become one row; lists leave NULLs out.
    whole = rows.agg(
        *[F.max(c).alias(c) for c in totals.columns],
        *[F.array_sort(F.collect_list(c)).alias(c) for c in ("bad_examples", "small_std_examples")],
    )
    healthy = F.expr("total_elements > 0 AND bad_count = 0 AND small_std_count = 0")
    return whole.withColumn("healthy", healthy).select(
        "total_elements", "bad_count", "small_std_count", "dead_count", "healthy", "bad_examples", "small_std_examples"
    )


# Model size ---------------------------------------------------------------------------------------------------------


def size_rollup(manifest: DataFrame) -> DataFrame:
    """Parameter counts and memory from rows ``kind, numel, element_size, requires_grad``."""
    parameter = F.col("kind") == "parameter"
    size = F.col("numel") * F.col("element_size")

    def total(test: Column, value: Column) -> Column:
        return F.coalesce(F.sum(F.when(test, value)), F.lit(0))

    sums = manifest.agg(
        total(parameter, F.col("numel")).alias("total_params"),
        total(parameter & F.col("requires_grad"), F.col("numel")).alias("trainable_params"),
        total(parameter, size).alias("p"),
        total(F.col("kind") == "buffer", size).alias("b"),
    )
    share = F.try_divide(F.lit(100.0) * F.col("trainable_params"), F.col("total_params"))
    return sums.select(
        "total_params",
        "trainable_params",
        F.coalesce(share, F.lit(0.0)).alias("trainable_percent"),
        (F.col("p") / MIB).alias("param_size_mb"),
        (F.col("b") / MIB).alias("buffer_size_mb"),
        ((F.col("p") + F.col("b")) / MIB).alias("total_size_mb"),
        (F.col("total_params") / 1e9).alias("total_params_billions"),
    )


# Checkpoints --------------------------------------------------------------------------------------------------------


def checkpoint_step(path: Column) -> Column:
    """Step number in a name ``checkpoint-<number>``: its second dash-separated part, digits with optional ``_``."""
    leaf = F.regexp_extract(path, r"([^/]*)/*$", 1)
    number = F.regexp_extract(leaf, r"^checkpoint-\s*([+]?[0-9]+(?:_[0-9]+)*)\s*(?:-.*)?$", 1)
    return F.when(number != "", F.regexp_replace(number, "_", "").try_cast("bigint"))


def checkpoint_retention(
    checkpoints: DataFrame,
    keep_last: int = 3,
    keep_best: bool = True,
    metric: str = "loss",
    lower_is_better: bool = True,
    run: str = "run",
    path: str = "path",
) -> DataFrame:
    """All checkpoints with their step and a ``keep`` flag: the newest ``keep_last`` and the best of every run.

    Names without a step number are not checkpoints. Ties for the best go to the larger step; missing and NaN metrics
    never win. Nothing is deleted.
    """
    found = checkpoints.withColumn("step", checkpoint_step(F.col(path))).where(F.col("step").isNotNull())
    rows = found.select(run, path, "step")
    if keep_last <= GROUP_LIMIT:
        # Spark cuts each run to its newest rows before the shuffle, so a run with most of the rows stays cheap.
        newest = Window.partitionBy(run).orderBy(F.col("step").desc(), F.col(path))
        aged = rows.withColumn("age", F.row_number().over(newest))
    else:
        aged = numbered(rows.withColumn("__back", -F.col("step")), ["__back", path], [run], "age")
    kept = aged.where(F.col("age") <= keep_last).select(run, path)
    if keep_best:
        score = F.col(metric) if lower_is_better else -F.col(metric)
        rank = F.struct(score.alias("s"), (-F.col("step")).alias("n"), F.col(path).alias("p"))
        unbeatable = float("inf")
        best = (
            found.where(F.col(metric).isNotNull() & ~F.isnan(metric) & (score < F.lit(unbeatable)))
            .groupBy(run)
            .agg(F.min(rank).alias("best"))
            .select(run, F.col("best.p").alias(path))
        )
        kept = kept.unionByName(best).distinct()
    return found.join(kept.withColumn("kept", F.lit(True)), [run, path], "left").withColumn(
        "keep", F.coalesce("kept", F.lit(False))
    ).drop("kept")


def latest_checkpoint(
    checkpoints: DataFrame, run: str = "run", path: str = "path", overwrite: bool = False
) -> DataFrame:
    """Per run the checkpoint with the highest step; none when the run is to be overwritten."""
    found = checkpoints.withColumn("step", checkpoint_step(F.col(path))).where(F.col("step").isNotNull())
    last = F.struct(F.col("step").alias("s"), F.col(path).alias("p"))
    latest = found.groupBy(run).agg(F.max(last).alias("last"))
    return latest.select(run, F.col("last.p").alias(path), F.col("last.s").alias("step")).where(F.lit(not overwrite))


def checkpoint_records(
    checkpoints: DataFrame,
    folder: Column,
    step: Column,
    saved_at: Column,
    metric_names: Sequence[str],
    model_size: Column | None = None,
) -> DataFrame:
    """Metadata rows of saved checkpoints; a checkpoint without a step is named by its time.

    Metrics without a value are left out of the map. ``model_size`` may hold the columns of ``size_rollup`` as a struct.
    """
    by_time = F.date_format(saved_at, "yyyyMMdd_HHmmss")
    pairs = [item for m in metric_names for item in (F.lit(m), F.col(m).cast("double"))]
    rows = [
        F.concat(folder, F.lit("/checkpoint-"), F.coalesce(step.cast("string"), by_time)).alias("path"),
        step.cast("bigint").alias("step"),
        saved_at.alias("saved_at"),
        F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull()).alias("metrics"),
    ]
    return checkpoints.select(*rows, *([model_size.alias("model_size")] if model_size is not None else []))


def save_checkpoint_records(records: DataFrame, path: str) -> None:
    records.write.mode("append").parquet(path)


# Run time -----------------------------------------------------------------------------------------------------------


def step_plan(runs: DataFrame) -> DataFrame:
    """Steps and time of runs ``num_samples, batch_size, accumulation, epochs, sec_per_step``."""
    planned = runs.withColumn(
        "steps_per_epoch", F.floor(F.col("num_samples") / (F.col("batch_size") * F.col("accumulation")))
    )
    planned = planned.withColumn("total_steps", F.col("steps_per_epoch") * F.col("epochs"))
    planned = planned.withColumn("total_time_seconds", F.col("total_steps") * F.col("sec_per_step"))
    return planned.withColumns(
        {
            "total_time_minutes": F.col("total_time_seconds") / 60,
            "total_time_hours": F.col("total_time_seconds") / 3600,
            "total_time_days": F.col("total_time_seconds") / 86400,
            "duration": duration_text(F.col("total_time_seconds")),
        }
    )


def duration_text(seconds: Column) -> Column:
    """Seconds, minutes, hours or days with one decimal."""
    return (
        F.when(seconds < 60, F.concat(one_decimal(seconds), F.lit("s")))
        .when(seconds < 3600, F.concat(one_decimal(seconds / 60), F.lit("m")))
        .when(seconds < 86400, F.concat(one_decimal(seconds / 3600), F.lit("h")))
        .otherwise(F.concat(one_decimal(seconds / 86400), F.lit("d")))
    )


def one_decimal(x: Column) -> Column:
    """A non-negative number with one decimal, rounded by its exact binary value (ties to even), as Python prints it.

    ``format_string`` rounds the shortest decimal form instead, which differs for numbers such as 1.15. Both
    subtractions below are exact close to the middle between two results, which is where the sign matters.
    """
    tenths = F.floor(x * 10)
    middle = 2 * tenths + 1
    beyond = (x * 16 - middle) + x * 4
    up = (beyond > 0) | ((beyond == 0) & (tenths % 2 == 1))
    rounded = tenths + F.when(up, F.lit(1)).otherwise(F.lit(0))
    return F.concat(F.floor(rounded / 10).cast("string"), F.lit("."), (rounded % 10).cast("string"))
