import math

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import runs as u
from corpusloom.operators.mixing import interleave
from corpusloom.operators.rendering import render_chat
from corpusloom.sources.sinks import land_stream
from corpusloom.streaming import streams as s
from corpusloom.streaming.mixing import StreamMix

METRICS = "step bigint, key string, value double"


def metric_rows(n=200):
    return [(i, "hot" if i % 7 else "rare", float((i * 31) % 17)) for i in range(1, n + 1)]


def stream_of(spark, df, path, files=4):
    """A file stream whose files arrive in an order that has nothing to do with the steps."""
    df.repartition(files).write.parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


def latest(spark, path):
    rows = spark.read.parquet(path).groupBy("key").agg(F.max_by("mean", "batch").alias("mean")).collect()
    return {x.key: x.mean for x in rows}


def test_render_equals_batch(spark, tmp_path):
    rows = [([("user", f"q{i}"), ("assistant", "a")],) for i in range(30)]
    df = spark.createDataFrame(rows, "messages array<struct<role:string,content:string>>")
    stream = render_chat(stream_of(spark, df, str(tmp_path / "in")))
    land_stream(stream, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    land_stream(stream, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()  # a restart adds nothing
    got = sorted(x.text for x in spark.read.schema("text string").parquet(str(tmp_path / "out")).collect())
    assert got == sorted(x.text for x in render_chat(df).collect())


def test_running_averages(spark, tmp_path):
    df = spark.createDataFrame(metric_rows(), METRICS)
    stream = s.running_averages(stream_of(spark, df, str(tmp_path / "in")))
    s.save_latest(stream, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    want = {x.key: x.mean for x in u.metric_averages(df).collect()}
    assert latest(spark, str(tmp_path / "out")) == pytest.approx(want)


@pytest.mark.parametrize("n", [3, 50])
def test_last_n_over_several_batches(spark, tmp_path, n):
    df = spark.createDataFrame(metric_rows(), METRICS)
    stream = s.last_n_averages(stream_of(spark, df, str(tmp_path / "in")), n)
    s.save_latest(stream, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    want = {x.key: x.mean for x in u.metric_averages(df, n).collect()}
    assert latest(spark, str(tmp_path / "out")) == pytest.approx(want)


def test_rates(spark):
    rates = s.thinning_rates({"a": 0.5, "b": 0.5, "c": 0.0, "d": 1.0}, {"a": 1000, "b": 100, "c": 10, "d": 0})
    assert rates == pytest.approx({"a": 0.1, "b": 1.0})
    rows = [("a", i) for i in range(1000)] + [("b", i) for i in range(100)] + [("c", i) for i in range(10)]
    kept = s.mix_by_rate(spark.createDataFrame(rows, "source string, key bigint"), rates, 1)
    counts = {x["source"]: x["count"] for x in kept.groupBy("source").count().collect()}
    assert counts["b"] == 100 and 70 < counts["a"] < 130 and "c" not in counts


@pytest.mark.parametrize("n", [3, 50])
def test_last_n_goes_on_after_a_restart(spark, tmp_path, n):
    """Values in order, late ones and non-finite ones, over two runs with the same checkpoint."""
    rows = metric_rows() + [(5_000 + i, "odd", v) for i, v in enumerate([1.0, float("nan"), 2.0, 1e300, 3.0, 4.0])]
    df = spark.createDataFrame(rows, METRICS)
    source, out, ck = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")
    for part in (F.col("step") % 3 == 1, F.col("step") % 3 == 0, F.col("step") % 3 == 2):  # the later parts hold late steps
        df.where(part).repartition(2).write.mode("append").parquet(source)
        stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(source)
        s.save_latest(s.last_n_averages(stream, n), out, ck).awaitTermination()
    want = {x.key: x.mean for x in u.metric_averages(df, n).collect()}
    got = latest(spark, out)
    odd = got.pop("odd"), want.pop("odd")
    assert odd[0] is None and math.isnan(odd[1]) if n == 50 else odd[0] == pytest.approx(odd[1])
    assert got == pytest.approx(want)
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", "").endswith("HDFSBackedStateStoreProvider") or not spark.conf.get(
        "spark.sql.streaming.stateStore.providerClass", None
    )


# The exact mix --------------------------------------------------------------------------------------------------------

MIXED = {"a": 0.5, "b": 0.3, "c": 0.2}
MIX_SCHEMA = "source string, key bigint, text string"


def blend_rows(spark):
    rows = [(name, i * 3, f"{name}{i}") for name, n in (("a", 400), ("b", 60), ("c", 150)) for i in range(n)]
    return spark.createDataFrame([*rows, ("other", 1, "x"), ("a", None, "no key")], MIX_SCHEMA)


def written(spark, path):
    return sorted(tuple(r) for r in spark.read.parquet(f"{path}/out").select("source", "key", "text", "t").collect())


@pytest.mark.parametrize("cuts", [[], [90], [1, 30, 31, 170, 171, 172, 900]])
def test_exact_mix_does_not_depend_on_batches(spark, tmp_path, cuts):
    df, path = blend_rows(spark), str(tmp_path / "mix")
    mix = StreamMix(MIXED, 7, path)
    for low, high in zip([-1, *cuts], [*cuts, 10_000]):
        df.where((F.col("key") > low) & (F.col("key") <= high) | F.col("key").isNull() & (F.lit(low) < 0)).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
        mix.start(stream, str(tmp_path / "ck")).awaitTermination()
    want = interleave(df.where("key is not null"), MIXED, 7).select("source", "key", "text", "t")
    assert written(spark, path) == sorted(tuple(r) for r in want.collect())


def test_exact_mix_of_sources_that_arrive_at_different_times(spark, tmp_path):
    """One source after the other: all wait for the last; a batch that is repeated writes the same again."""
    df, path = blend_rows(spark).where("key is not null"), str(tmp_path / "mix")
    mix = StreamMix(MIXED, 7, path)
    for number, part in enumerate(["source = 'a'", "source = 'c' AND key < 90", "false", "source = 'b'", "source = 'c' AND key >= 90"]):
        before = written(spark, path) if number else []
        mix(df.where(part), number)
        again = written(spark, path)
        mix(df.where(part), number)
        assert written(spark, path) == again and (number < 3) == (not again) and set(before) <= set(again)
    assert again == sorted(tuple(r) for r in interleave(df, MIXED, 7).select("source", "key", "text", "t").collect())


def test_exact_mix_rejects_keys_that_go_back(spark, tmp_path):
    df = blend_rows(spark)
    mix = StreamMix(MIXED, 7, str(tmp_path / "mix"))
    mix(df.where("key >= 60"), 0)
    with pytest.raises(ValueError):
        mix(df.where("key < 60"), 1)
