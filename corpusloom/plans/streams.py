"""Queries: streaming forms. Every stream reads what its source holds now and ends (``availableNow``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators import rendering as r
from corpusloom.operators import tokens as k
from corpusloom.operators.mixing import union_sources
from corpusloom.operators.ordering import bucket_of, key_bounds
from corpusloom.plans import adapters as a
from corpusloom.plans.blends import SEED, SOURCES_SQL, mix_sql
from corpusloom.plans.chat import MESSAGES_SQL
from corpusloom.plans.registry import SQL, query, table
from corpusloom.plans.reports import LAST_N, METRICS_SQL
from corpusloom.plans.sequences import MAX_LENGTH
from corpusloom.session import scratch_path
from corpusloom.sources.catalogue import Source
from corpusloom.sources.readers import Layout, scan_stream
from corpusloom.sources.sinks import land, land_stream
from corpusloom.streaming import streams as s
from corpusloom.streaming.mixing import StreamMix

STREAM_PARTS = 3
FILES_PER_BATCH = 1000


def replayed(spark: SparkSession, df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """A bounded frame landed as files and read back as a stream, and a scratch folder for the stream."""
    root = scratch_path(spark, name)
    land(df, f"{root}/{name}")
    return scan_stream(spark, Layout(root), Source(name), df.schema), root


def streamed(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table as a stream of the files it has, without a copy; the schema is the batch reader's.

    As a pattern, the name may stand for a folder or for a single file, which the file source does not take by its plain name.
    """
    return scan_stream(spark, Layout(folder), Source(f"{name}.[p]arquet"), table(spark, folder, name).schema, FILES_PER_BATCH)


def finished(stream: DataFrame, root: str) -> DataFrame:
    """Run a stream to the end of its source into a folder and read the result."""
    land_stream(stream, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{root}/out")


@query("SELECT doc_id, text FROM documents")
def stream_scan(spark: SparkSession, folder: str) -> DataFrame:
    return finished(r.pick_text(streamed(spark, folder, "documents"), keep=["doc_id"]), scratch_path(spark, "documents"))


@query(MESSAGES_SQL)
def stream_render(spark: SparkSession, folder: str) -> DataFrame:
    stream, root = replayed(spark, a.messages(spark, folder), "messages")
    return finished(r.render_chat(stream, keep=["conv_id", "part"]), root)


@query(SQL["encode_bytes"])
def stream_encode(spark: SparkSession, folder: str) -> DataFrame:
    """Encoding of a stream of documents with a vocabulary of single bytes."""
    stream = streamed(spark, folder, "documents")
    rows = finished(k.encode(stream, k.Vocabulary([]), MAX_LENGTH, keep=["doc_id"]), scratch_path(spark, "documents"))
    attended = F.aggregate("attention_mask", F.lit(0).cast("bigint"), lambda s, x: s + x)
    return rows.select("doc_id", "n_tokens", a.joined_ids("input_ids").alias("input_ids"), attended.alias("attended"))


@query(f"WITH {METRICS_SQL} SELECT key, round(avg(value), 6) AS mean, count(*) AS n FROM metrics GROUP BY key")
def stream_metrics(spark: SparkSession, folder: str) -> DataFrame:
    stream = a.metric_rows(streamed(spark, folder, "events"))
    return _latest(s.running_averages(stream), scratch_path(spark, "metrics"))


@query(f"""
WITH {METRICS_SQL}, aged AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY step DESC) AS age FROM metrics)
SELECT key, round(avg(value), 6) AS mean, count(*) AS n FROM aged WHERE age <= {LAST_N} GROUP BY key
""")
def stream_last_n(spark: SparkSession, folder: str) -> DataFrame:
    stream = a.metric_rows(streamed(spark, folder, "events"))
    return _latest(s.last_n_averages(stream, LAST_N), scratch_path(spark, "metrics"))


def _latest(stream: DataFrame, root: str) -> DataFrame:
    """The last state that an updating stream wrote for every key."""
    s.save_latest(stream, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    written = stream.sparkSession.read.parquet(f"{root}/out")
    return written.groupBy("key").agg(
        F.round(F.max_by("mean", "batch"), 6).alias("mean"), F.max_by("n", "batch").alias("n")
    )


def _expected(spark: SparkSession, folder: str) -> tuple[DataFrame, dict[str, float]]:
    whole = union_sources(a.blend_sources(spark, folder))
    return whole, {x["source"]: x["count"] for x in whole.groupBy("source").count().collect()}


@query(f"""
WITH {SOURCES_SQL},
weights AS (SELECT * FROM (VALUES {", ".join(f"('{n}', {w}::DOUBLE)" for n, w in a.MIX_WEIGHTS.items())}) w(source, weight)),
density AS (SELECT source, weight / count(*) AS d FROM sources JOIN weights USING (source) GROUP BY source, weight),
rates AS (SELECT source, d / max(d) OVER () AS rate FROM density)
SELECT source, key, text FROM sources JOIN rates USING (source)
WHERE (('0x' || substr(md5('{SEED}:' || source || ':' || key), 1, 13))::BIGINT + 0.5) / 4503599627370496.0 < rate
""")
def stream_mix(spark: SparkSession, folder: str) -> DataFrame:
    """Sources mixed by rate on a stream, without state."""
    whole, expected = _expected(spark, folder)
    stream, root = replayed(spark, whole, "blend")
    rates = s.thinning_rates(a.MIX_WEIGHTS, expected)
    return finished(s.mix_by_rate(stream, rates, SEED), root).select("source", "key", "text")


@query(f"WITH {mix_sql(a.MIX_WEIGHTS, SEED)} SELECT source, key, text, t FROM mix")
def stream_mix_batches(spark: SparkSession, folder: str) -> DataFrame:
    """The exact mix of a blend that arrives in parts, in order of its keys; the stream is started anew for each of them."""
    whole, expected = _expected(spark, folder)
    root = scratch_path(spark, "blend")
    mix = StreamMix({n: w for n, w in a.MIX_WEIGHTS.items() if expected.get(n)}, SEED, root)
    bounds = key_bounds(whole, "key", buckets=STREAM_PARTS)
    for part in range(len(bounds) + 1):
        whole.where(bucket_of(F.col("key"), bounds) == part).write.mode("append").parquet(f"{root}/blend")
        stream = scan_stream(spark, Layout(root), Source("blend"), whole.schema)
        mix.start(stream, f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/out").select("source", "key", "text", "t")
