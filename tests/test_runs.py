import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import runs as u

METRICS = "step bigint, key string, value double"


def sparse_log(n=400, seed=2):
    rng = random.Random(seed)
    rows = []
    for step in range(1, n + 1):
        for key, chance in (("hot", 0.95), ("rare", 0.02), ("late", 0.3 if step > n // 2 else 0.0)):
            if rng.random() < chance:
                rows.append((step, key, rng.random()))
    return rows


def replay(rows, interval):
    """The rule of a metric log, one update after the other."""
    by_step, known, out = {}, {}, {}
    for step, key, value in rows:
        by_step.setdefault(step, []).append((key, value))
    for step in range(1, max(by_step) + 1):
        for key, value in by_step.get(step, []):
            known.setdefault(key, []).append(value)
        if step % interval == 0:
            for key, values in known.items():
                last = values[-interval:]
                out[step, key] = sum(last) / len(last)
    return out


@pytest.mark.parametrize("interval, rows_per_bucket", [(10, None), (10, 10), (25, 30), (1, 5), (300, 50), (500, None)])
def test_metric_log(spark, interval, rows_per_bucket):
    rows = sparse_log()
    df = spark.createDataFrame(rows, METRICS).repartition(5)
    got = {(x.log_step, x.key): x.mean for x in u.metric_log(df, interval, rows_per_bucket).collect()}
    want = replay(rows, interval)
    assert got.keys() == want.keys()
    assert all(math.isclose(got[k], want[k], abs_tol=1e-12) for k in want)


@pytest.mark.parametrize("last_n", [None, 0, 3, 2000])
def test_averages(spark, last_n):
    rows = sparse_log()
    df = spark.createDataFrame(rows, METRICS)
    got = {x.key: x.mean for x in u.metric_averages(df, last_n, ["hot", "rare", "none"], rows_per_bucket=40).collect()}
    for key in ("hot", "rare"):
        values = [v for _, k, v in rows if k == key]
        values = values[-last_n:] if last_n else values
        assert math.isclose(got[key], sum(values) / len(values))
    assert got["none"] == 0.0


def test_summary_in_parts(spark, tmp_path):
    rows = sparse_log()
    df = spark.createDataFrame(rows, METRICS).repartition(3)
    parts = u.metric_summary(df, values_per_part=50, rows_per_bucket=60).collect()
    for key in ("hot", "rare", "late"):
        values = [v for _, k, v in rows if k == key]
        mine = sorted((x for x in parts if x.key == key), key=lambda x: x.part)
        assert [v for x in mine for v in x["values"]] == values
        assert all(len(x["values"]) <= 50 and x.step == 400 for x in mine)
        assert math.isclose(mine[0].average, sum(values) / len(values))
    u.save_metric_report(df, str(tmp_path / "m"))
    assert spark.read.json(str(tmp_path / "m")).count() == 3


def test_health(spark):
    nan, inf = float("nan"), float("inf")
    rows = [("nan", [1.0, nan]), ("inf", [1.0, -inf]), ("dead", [2.0, 2.0]), ("collapsed", [0.0, 1e-9]), ("one", [5.0])]
    rows += [("ok", [1.0, 2.0]), ("embed.x", [1.0, 3.0]), ("layers.01", [0.0, 9.0])]
    df = spark.createDataFrame(rows, "name string, values array<double>")
    stats = u.tensor_statistics(df)
    health = {x.name: x.health for x in stats.collect()}
    assert health["nan"] == health["inf"] == "nan_inf"
    assert (health["dead"], health["collapsed"], health["one"], health["ok"]) == ("dead", "collapsed", "ok", "ok")
    assert {x.name for x in u.reported_tensors(stats).collect()} == {
        "nan", "inf", "dead", "collapsed", "embed.x", "layers.01",
    }
    got = u.tensor_summary(stats).first()
    assert (got.total_elements, got.bad_count, got.small_std_count, got.dead_count) == (15, 2, 1, 1)
    assert got.bad_examples == ["inf", "nan"] and got.small_std_examples == ["collapsed"] and not got.healthy


def test_tensor_in_several_rows_and_examples_limit(spark):
    df = spark.createDataFrame([("a", [1.0]), ("a", [2.0, 3.0])], "name string, values array<float>")
    got = u.tensor_statistics(df).first()
    assert (got.numel, got.mean, got.std) == (3, 2.0, 1.0)
    bad = spark.createDataFrame([(f"t{i}", [float("nan")]) for i in range(9)], "name string, values array<double>")
    assert u.tensor_summary(u.tensor_statistics(bad)).first().bad_examples == ["t0", "t1", "t2", "t3", "t4"]
    with pytest.raises(ValueError):
        u.tensor_statistics(spark.createDataFrame([("i", [1])], "name string, values array<int>"))


def test_moments_are_those_of_all_elements(spark):
    """Arrays of one tensor in many rows and tasks, far from zero, with NULLs, empty and NULL arrays; no element becomes a row."""
    rng = random.Random(3)
    rows, values = [], {}
    for i in range(300):
        name = rng.choice(["hot", "hot", "hot", "far", "one", None])
        size = rng.choice([0, 1, 5, 64])
        array = None if rng.random() < 0.05 else [None if rng.random() < 0.1 else rng.gauss(1e9 if name == "far" else 0, 1) for _ in range(size)]
        rows.append((name, array, "x"))
        values.setdefault(name, []).extend(array or [])
    rows.append(("none", [], "x"))
    df = spark.createDataFrame(rows, "name string, values array<double>, mean string").repartition(7)
    stats = u.tensor_statistics(df)
    assert "Generate" not in stats._jdf.queryExecution().executedPlan().toString()
    got = {x.name: x for x in stats.collect()}
    for name, all_values in values.items():
        known = [v for v in all_values if v is not None]
        assert got[name].numel == len(all_values)
        assert math.isclose(got[name].mean, statistics.fmean(known), rel_tol=1e-12, abs_tol=1e-12)
        assert math.isclose(got[name]["std"], statistics.stdev(known), rel_tol=1e-6)
    assert tuple(got["none"])[1:] == (0, False, False, None, None, "ok")


def test_a_tensor_of_ten_million_elements(spark):
    df = spark.range(10).select(F.lit("w").alias("name"), F.expr("transform(sequence(1, 1000000), i -> cast(i % 2 as float))").alias("values"))
    got = u.tensor_statistics(df).first()
    assert (got.numel, got.mean, got.health) == (10_000_000, 0.5, "ok") and math.isclose(got["std"], 0.5, rel_tol=1e-6)


def test_dead_tensors_do_not_change_the_verdict(spark):
    df = spark.createDataFrame([("a", [1.0, 1.0]), ("b", [1.0, 2.0])], "name string, values array<double>")
    assert u.tensor_summary(u.tensor_statistics(df)).first().healthy
    assert not u.tensor_summary(u.tensor_statistics(df.where("false"))).first().healthy


def test_size(spark):
    rows = [("p", "parameter", 2 * 1024 * 1024, 4, True), ("q", "parameter", 2 * 1024 * 1024, 2, False)]
    rows.append(("b", "buffer", 1024 * 1024, 4, False))
    schema = "name string, kind string, numel bigint, element_size int, requires_grad boolean"
    got = u.size_rollup(spark.createDataFrame(rows, schema)).first()
    assert tuple(got) == (4194304, 2097152, 50.0, 12.0, 4.0, 16.0, 4194304 / 1e9)
    assert u.size_rollup(spark.createDataFrame([], schema)).first().trainable_percent == 0.0


def test_step_names(spark):
    cases = {
        "checkpoint-12": 12, "checkpoint-abc": None, "checkpoint-20240101_120000": 20240101120000, "other-5": None,
        "out/checkpoint-7": 7, "out/checkpoint-7/": 7, "checkpoint-5-old": 5, "checkpoint-": None, "checkpoint-1__0": None,
        "checkpoint--5": None, "my-checkpoint-4": None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "path string")
    got = {x.path: x.step for x in df.select("path", u.checkpoint_step(F.col("path")).alias("step")).collect()}
    assert got == cases


def kept(spark, rows, **options):
    df = spark.createDataFrame(rows, "run string, path string, loss double")
    return {x.path for x in u.checkpoint_retention(df, **options).where("keep").collect()}


def test_retention(spark):
    rows = [("r", "checkpoint-10", 1.0), ("r", "checkpoint-20", 1.0), ("r", "checkpoint-30", 2.0)]
    assert kept(spark, rows, keep_last=1) == {"checkpoint-30", "checkpoint-20"}
    assert kept(spark, rows, keep_last=1, keep_best=False) == {"checkpoint-30"}
    assert kept(spark, rows, keep_last=1, lower_is_better=False) == {"checkpoint-30"}
    nan = [("r", "checkpoint-1", float("nan")), ("r", "checkpoint-2", None), ("r", "checkpoint-3", 5.0), ("r", "x", 0.0)]
    nan += [("r", "checkpoint-9", float("inf"))]
    assert kept(spark, nan, keep_last=1) == {"checkpoint-3", "checkpoint-9"}


def test_retention_keeps_every_row_of_a_large_run(spark):
    rows = [("hot", f"checkpoint-{i}", float((i * 37) % 101)) for i in range(500)] + [("b", "checkpoint-1", 1.0)]
    df = spark.createDataFrame(rows, "run string, path string, loss double")
    got = u.checkpoint_retention(df).collect()
    assert len(got) == 501 and len({x.path for x in got if x.keep and x.run == "hot"}) == 4
    plan = u.checkpoint_retention(df)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_latest(spark):
    df = spark.createDataFrame([("r", "checkpoint-9"), ("r", "checkpoint-10"), ("s", "none")], "run string, path string")
    assert [tuple(x) for x in u.latest_checkpoint(df).collect()] == [("r", "checkpoint-10", 10)]
    assert u.latest_checkpoint(df, overwrite=True).count() == 0


def test_step_plan(spark):
    schema = "num_samples bigint, batch_size int, accumulation int, epochs int, sec_per_step double"
    got = u.step_plan(spark.createDataFrame([(1_000_000, 4, 8, 1, 0.5)], schema)).first()
    assert (got.steps_per_epoch, got.total_steps, got.total_time_seconds, got.duration) == (31250, 31250, 15625.0, "4.3h")


def test_durations_round_like_python(spark):
    def python(s):
        for limit, size, unit in ((60, 1, "s"), (3600, 60, "m"), (86400, 3600, "h")):
            if s < limit:
                return f"{s / size:.1f}{unit}"
        return f"{s / 86400:.1f}d"

    rng = random.Random(0)
    seconds = [59.94, 60.0, 3600.0, 86400.0, 0.0, 0.05, 0.25, 0.35, 0.45, 1.15, 63.0, 69.0, 59.95, 59.949999, 12345678.9]
    seconds += [i / 20 for i in range(1200)] + [float(i) for i in range(60, 3600, 3)]
    seconds += [rng.random() * 10 ** rng.randint(0, 7) for _ in range(2000)]
    df = spark.createDataFrame([(s,) for s in seconds], "s double")
    got = [x[0] for x in df.select(u.duration_text(F.col("s"))).collect()]
    assert got == [python(s) for s in seconds]


def test_checkpoint_records(spark, tmp_path):
    df = spark.sql("select 5L as step, timestamp'2024-01-02 03:04:05' as ts, 0.5D as loss, cast(null as double) as acc "
                   "union all select null, timestamp'2024-01-02 03:04:05', null, 1D")
    rec = u.checkpoint_records(df, F.lit("out"), F.col("step"), F.col("ts"), ["loss", "acc"])
    for _ in range(2):
        u.save_checkpoint_records(rec, str(tmp_path / "c"))
    got = {x.path: x.metrics for x in spark.read.parquet(str(tmp_path / "c")).collect()}
    assert got == {"out/checkpoint-5": {"loss": 0.5}, "out/checkpoint-20240102_030405": {"acc": 1.0}}
    assert spark.read.parquet(str(tmp_path / "c")).count() == 4
    sized = u.checkpoint_records(df, F.lit("out"), F.col("step"), F.col("ts"), ["loss"], F.struct(F.lit(7).alias("total_params")))
    assert sized.first().model_size.total_params == 7
