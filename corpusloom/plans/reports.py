"""Queries: metric logs, tensors, model size, checkpoints, run time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators import runs as u
from corpusloom.plans import adapters as a
from corpusloom.plans.registry import query, table
from corpusloom.session import scratch_path

INTERVAL = 100
LAST_N = 50

METRICS_SQL = "metrics AS (SELECT event_id + 1 AS step, event_type AS key, value FROM events)"
TENSORS_SQL = """
tensors AS (SELECT 'layers.' || label AS name, unnest(embedding)::DOUBLE AS x FROM embeddings),
stats AS (
  SELECT name, count(*) AS numel, bool_or(isnan(x)) AS has_nan, bool_or(isinf(x)) AS has_inf, avg(x) AS mean,
    stddev_samp(x) AS std FROM tensors GROUP BY name
),
health AS (
  SELECT *, CASE WHEN has_nan OR has_inf THEN 'nan_inf' WHEN std = 0 THEN 'dead' WHEN std < 1e-6 THEN 'collapsed'
    ELSE 'ok' END AS health FROM stats
)"""


@query(f"""
WITH {METRICS_SQL},
means AS (
  SELECT key, step, avg(value) OVER (PARTITION BY key ORDER BY step ROWS BETWEEN {INTERVAL - 1} PRECEDING AND CURRENT ROW)
    AS mean FROM metrics
),
logs AS (SELECT k.key, l.log_step FROM (SELECT DISTINCT key FROM metrics) k,
  (SELECT unnest(range({INTERVAL}, (SELECT max(step) FROM metrics) + 1, {INTERVAL})) AS log_step) l)
SELECT log_step, logs.key, round(mean, 6) AS mean
FROM logs ASOF JOIN means ON logs.key = means.key AND logs.log_step >= means.step
""")
def metric_log(spark: SparkSession, folder: str) -> DataFrame:
    rows = u.metric_log(a.metrics(spark, folder), INTERVAL)
    return rows.select("log_step", "key", F.round("mean", 6).alias("mean"))


@query(f"WITH {METRICS_SQL} SELECT key, round(avg(value), 6) AS mean FROM metrics GROUP BY key")
def metric_averages(spark: SparkSession, folder: str) -> DataFrame:
    return u.metric_averages(a.metrics(spark, folder)).select("key", F.round("mean", 6).alias("mean"))


@query(f"""
WITH {METRICS_SQL}, aged AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY step DESC) AS age FROM metrics)
SELECT asked.key, round(coalesce(avg(value), 0.0), 6) AS mean
FROM (VALUES ('click'), ('error'), ('view'), ('loss')) asked(key) LEFT JOIN aged ON aged.key = asked.key AND age <= {LAST_N}
GROUP BY asked.key
""")
def metric_last_n(spark: SparkSession, folder: str) -> DataFrame:
    rows = u.metric_averages(a.metrics(spark, folder), LAST_N, keys=["click", "error", "view", "loss"])
    return rows.select("key", F.round("mean", 6).alias("mean"))


@query(f"""
WITH {METRICS_SQL},
placed AS (SELECT *, (row_number() OVER (PARTITION BY key ORDER BY step) - 1) // {u.VALUES_PER_PART} AS part FROM metrics)
SELECT key, part, string_agg(CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR), ',' ORDER BY step) AS cents,
  round((SELECT avg(value) FROM metrics m WHERE m.key = placed.key), 6) AS average, (SELECT max(step) FROM metrics) AS step
FROM placed GROUP BY key, part
""")
def metric_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Values are shown in hundredths, so that both engines write them alike."""
    rows = u.metric_summary(a.metrics(spark, folder))
    cents = F.transform("values", lambda v: F.round(v * 100).cast("bigint")).cast("array<string>")
    return rows.select(
        "key", "part", F.array_join(cents, ",").alias("cents"), F.round("average", 6).alias("average"), "step"
    )


@query(f"""
WITH {METRICS_SQL}
SELECT key, count(*) AS n, round(avg(value), 6) AS average FROM metrics GROUP BY key
""")
def metric_report(spark: SparkSession, folder: str) -> DataFrame:
    """The report written as JSON and read back."""
    path = scratch_path(spark, "metrics")
    u.save_metric_report(a.metrics(spark, folder), path)
    schema = "key string, part bigint, values array<double>, average double, step bigint"
    rows = spark.read.schema(schema).json(path)
    return rows.groupBy("key").agg(
        F.sum(F.size("values")).alias("n"), F.round(F.max("average"), 6).alias("average")
    )


@query(f"""
WITH {TENSORS_SQL}
SELECT name, numel, has_nan, has_inf, round(mean, 6) AS mean, round(std, 6) AS std, health FROM health
""")
def tensor_health(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(u.tensor_statistics(a.tensors(spark, folder)))


@query(f"""
WITH {TENSORS_SQL}
SELECT name, numel, has_nan, has_inf, round(mean, 6) AS mean, round(std, 6) AS std, health FROM health
WHERE health <> 'ok' OR contains(name, 'embed') OR contains(name, 'layers.0')
""")
def tensor_report(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(u.reported_tensors(u.tensor_statistics(a.tensors(spark, folder))))


def _rounded(stats: DataFrame) -> DataFrame:
    return stats.withColumns({"mean": F.round("mean", 6), "std": F.round("std", 6)})


@query(f"""
WITH {TENSORS_SQL}
SELECT CAST(sum(numel) AS BIGINT) AS total_elements, count(*) FILTER (WHERE health = 'nan_inf') AS bad_count,
  count(*) FILTER (WHERE health = 'collapsed') AS small_std_count, count(*) FILTER (WHERE health = 'dead') AS dead_count,
  sum(numel) > 0 AND count(*) FILTER (WHERE health IN ('nan_inf', 'collapsed')) = 0 AS healthy,
  (SELECT coalesce(string_agg(name, ',' ORDER BY name), '') FROM (
    SELECT name FROM health WHERE health = 'nan_inf' ORDER BY name LIMIT 5)) AS bad_examples,
  (SELECT coalesce(string_agg(name, ',' ORDER BY name), '') FROM (
    SELECT name FROM health WHERE health = 'collapsed' ORDER BY name LIMIT 5)) AS small_std_examples
FROM health
""")
def tensor_summary(spark: SparkSession, folder: str) -> DataFrame:
    rows = u.tensor_summary(u.tensor_statistics(a.tensors(spark, folder)))
    return rows.withColumns({c: F.array_join(c, ",") for c in ("bad_examples", "small_std_examples")})


@query("""
WITH manifest AS (
  SELECT CASE WHEN label % 5 = 0 THEN 'buffer' ELSE 'parameter' END AS kind, len(embedding) AS numel, 4 AS element_size,
    label % 2 = 0 AS requires_grad FROM embeddings
),
sums AS (
  SELECT CAST(sum(numel) FILTER (WHERE kind = 'parameter') AS BIGINT) AS total_params,
    CAST(sum(numel) FILTER (WHERE kind = 'parameter' AND requires_grad) AS BIGINT) AS trainable_params,
    sum(numel * element_size) FILTER (WHERE kind = 'parameter') / 1048576.0 AS p,
    sum(numel * element_size) FILTER (WHERE kind = 'buffer') / 1048576.0 AS b
  FROM manifest
)
SELECT total_params, trainable_params, round(100.0 * trainable_params / total_params, 6) AS trainable_percent,
  round(p::DOUBLE, 6) AS param_size_mb, round(b::DOUBLE, 6) AS buffer_size_mb, round((p + b)::DOUBLE, 6) AS total_size_mb,
  round(total_params / 1e9, 9) AS total_params_billions FROM sums
""")
def size_rollup(spark: SparkSession, folder: str) -> DataFrame:
    rows = u.size_rollup(a.manifest(spark, folder))
    sizes = ("trainable_percent", "param_size_mb", "buffer_size_mb", "total_size_mb")
    return rows.withColumns(
        {**{c: F.round(c, 6) for c in sizes}, "total_params_billions": F.round("total_params_billions", 9)}
    )


@query("""
WITH checkpoints AS (SELECT user_id AS run, 'checkpoint-' || event_id AS path, value AS loss, event_id AS step FROM events),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY run ORDER BY step DESC) AS age,
    row_number() OVER (PARTITION BY run ORDER BY loss, step DESC) AS place FROM checkpoints
)
SELECT run, path, loss, step, age <= 3 OR place = 1 AS keep FROM ranked
""")
def checkpoint_retention(spark: SparkSession, folder: str) -> DataFrame:
    return u.checkpoint_retention(a.checkpoints(spark, folder)).select("run", "path", "loss", "step", "keep")


@query("""
SELECT event_id, CASE event_id % 4 WHEN 0 THEN event_id WHEN 1 THEN CAST('2024' || lpad(event_id::VARCHAR, 12, '0') AS BIGINT)
  END AS step FROM events
""")
def checkpoint_steps(spark: SparkSession, folder: str) -> DataFrame:
    """Plain step numbers, time stamps, names without a number and names of something else."""
    number = F.col("event_id").cast("string")
    padded = F.lpad(number, 12, "0")
    stamp = F.concat(F.lit("2024"), F.substring(padded, 1, 4), F.lit("_"), F.substring(padded, 5, 8))
    name = (
        F.when(F.col("event_id") % 4 == 0, F.concat(F.lit("out/checkpoint-"), number, F.lit("/")))
        .when(F.col("event_id") % 4 == 1, F.concat(F.lit("checkpoint-"), stamp))
        .when(F.col("event_id") % 4 == 2, F.concat(F.lit("checkpoint-"), F.col("event_type")))
        .otherwise(F.concat(F.lit("other-"), number))
    )
    return table(spark, folder, "events").select("event_id", u.checkpoint_step(name).alias("step"))


@query("""
SELECT user_id AS run, 'checkpoint-' || max(event_id) AS path, max(event_id) AS step FROM events GROUP BY user_id
""")
def latest_checkpoint(spark: SparkSession, folder: str) -> DataFrame:
    return u.latest_checkpoint(a.checkpoints(spark, folder))


@query("""
SELECT 'runs/' || user_id || '/checkpoint-' || CASE WHEN event_type = 'view' THEN strftime(ts, '%Y%m%d_%H%M%S')
  ELSE event_id::VARCHAR END AS path, CASE WHEN event_type <> 'view' THEN event_id END AS step, value AS loss FROM events
""")
def checkpoint_records(spark: SparkSession, folder: str) -> DataFrame:
    """Metadata rows appended to a table and read back; checkpoints without a step are named by their time."""
    events = table(spark, folder, "events").withColumn("loss", F.col("value"))
    records = u.checkpoint_records(
        events,
        F.concat(F.lit("runs/"), F.col("user_id").cast("string")),
        F.when(F.col("event_type") != "view", F.col("event_id")),
        F.col("ts"),
        ["loss"],
    )
    path = scratch_path(spark, "checkpoints")
    u.save_checkpoint_records(records, path)
    return spark.read.parquet(path).select("path", "step", F.col("metrics")["loss"].alias("loss"))


@query("""
WITH runs AS (SELECT source, CAST(sum(n_chars) AS BIGINT) AS num_samples, count(*) AS epochs FROM documents GROUP BY source),
steps AS (SELECT *, num_samples // 32 AS steps_per_epoch, num_samples // 32 * epochs AS total_steps FROM runs),
times AS (SELECT *, total_steps * 0.5::DOUBLE AS s FROM steps)
SELECT source, steps_per_epoch, total_steps, s AS total_time_seconds, round(s / 60, 6) AS total_time_minutes,
  round(s / 3600, 6) AS total_time_hours, round(s / 86400, 6) AS total_time_days,
  CASE WHEN s < 60 THEN printf('%.1fs', s) WHEN s < 3600 THEN printf('%.1fm', s / 60)
    WHEN s < 86400 THEN printf('%.1fh', s / 3600) ELSE printf('%.1fd', s / 86400) END AS duration
FROM times
""")
def step_plan(spark: SparkSession, folder: str) -> DataFrame:
    rows = u.step_plan(a.run_plans(spark, folder))
    times = ("total_time_minutes", "total_time_hours", "total_time_days")
    return rows.select(
        "source", "steps_per_epoch", "total_steps", "total_time_seconds", *[F.round(c, 6).alias(c) for c in times], "duration"
    )


@query("""
SELECT event_id, CASE WHEN s < 60 THEN printf('%.1fs', s) WHEN s < 3600 THEN printf('%.1fm', s / 60)
  WHEN s < 86400 THEN printf('%.1fh', s / 3600) ELSE printf('%.1fd', s / 86400) END AS duration
FROM (SELECT event_id, value * (1 + event_id % 7 * 100)::DOUBLE AS s FROM events)
""")
def duration_text(spark: SparkSession, folder: str) -> DataFrame:
    seconds = F.col("value") * (1 + F.col("event_id") % 7 * 100).cast("double")
    return table(spark, folder, "events").select("event_id", u.duration_text(seconds).alias("duration"))
