import itertools
import random

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import mixing as m
from corpusloom.operators import ordering as o


def frame(spark, rows, partitions):
    return spark.createDataFrame(rows, "g string, k bigint, v bigint").repartition(partitions)


def skewed_rows(n=600):
    rng = random.Random(5)
    keys = rng.sample(range(-10**12, 10**12), n)
    # One group holds most of the rows, another one a single row, and one has no name.
    groups = ["hot"] * (n - 60) + ["b"] * 39 + ["single"] + [None] * 20
    return [(g, k, rng.randint(-5, 100)) for g, k in zip(groups, keys)]


@pytest.mark.parametrize("partitions, rows_per_bucket", [(1, 10**6), (4, 50), (16, 7), (3, 1)])
def test_running_total(spark, partitions, rows_per_bucket):
    rows = skewed_rows()
    df = o.running_total(
        frame(spark, rows, partitions), F.col("v"), ["k"], ["g"], out="t", rows_per_bucket=rows_per_bucket
    )
    got = {(x.g, x.k): x.t for x in df.collect()}
    want, sums = {}, {}
    for g, k, v in sorted(rows, key=lambda r: r[1]):
        sums[g] = sums.get(g, 0) + v
        want[g, k] = sums[g]
    assert got == want


@pytest.mark.parametrize("rows_per_bucket", [10**6, 40])
def test_numbered_over_everything(spark, rows_per_bucket):
    rows = skewed_rows()
    df = o.numbered(frame(spark, rows, 5), ["k"], rows_per_bucket=rows_per_bucket)
    got = [x.k for x in sorted(df.collect(), key=lambda x: x.row_number)]
    assert got == sorted(r[1] for r in rows)


def test_buckets_follow_the_cuts(spark):
    for cuts in ([], [5], [-3, 0, 4, 9], list(range(0, 200, 3))):
        rows = spark.range(-10, 210).select("id", o.bucket_of(F.col("id"), cuts).alias("b")).collect()
        assert all(x.b == sum(c <= x.id for c in cuts) for x in rows)


@pytest.mark.parametrize(
    "n, rows_per_bucket",
    [(0, 50), (1, 50), (7, 2), (7, 10**6), (333, 50), (599, 10**6), (599, 50), (600, 50), (600, 2), (1000, 50)],
)
def test_first_n(spark, n, rows_per_bucket):
    rows = skewed_rows()
    got = sorted(x.k for x in o.first_n(frame(spark, rows, 3), n, "k", rows_per_bucket).collect())
    assert got == sorted(r[1] for r in rows)[:n]


def test_first_n_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).withColumn("text", F.lit("x")).write.parquet(path)
    plan = o.first_n(spark.read.parquet(path), 10, "id", 50)._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(id,9)" in plan and "Exchange" not in plan


def test_shuffle_is_a_permutation_and_ignores_partitioning(spark):
    def order(partitions, seed):
        df = o.seeded_shuffle(spark.range(500).repartition(partitions), "id", seed)
        return [x.id for x in sorted(df.collect(), key=lambda x: x.position)]

    assert order(1, 3) == order(16, 3)
    assert sorted(order(4, 3)) == list(range(500))
    assert order(4, 3) != order(4, 4)


def test_streams_are_refused(spark):
    stream = spark.readStream.format("rate").load()
    for call in (lambda: o.seeded_shuffle(stream, "value", 1), lambda: o.first_n(stream, 3, "value")):
        with pytest.raises(ValueError):
            call()


# Mixing -------------------------------------------------------------------------------------------------------------


def sources(spark, sizes, partitions=4):
    rows = [(name, i * 3 - 7, f"{name}{i}") for name, n in sizes.items() for i in range(n)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "source string, key bigint, text string").repartition(partitions)


def mix(spark, sizes, weights, partitions=4, rows_per_bucket=None, seed=42):
    df = m.interleave(
        sources(spark, sizes, partitions), weights, seed, position="position", rows_per_bucket=rows_per_bucket
    )
    return [(x.source, x.key, x.t) for x in sorted(df.collect(), key=lambda x: x.position)]


SIZES = {"a": 2000, "b": 300, "c": 500}
WEIGHTS = {"a": 0.5, "b": 0.3, "c": 0.2}


def test_mix_properties(spark):
    rows = mix(spark, SIZES, WEIGHTS)
    assert rows == sorted(rows, key=lambda r: (r[2], r[0], r[1]))
    taken = {s: [r[1] for r in rows if r[0] == s] for s in SIZES}
    for s, keys in taken.items():
        assert keys == [i * 3 - 7 for i in range(len(keys))]  # a prefix of the source, in its order
    assert [s for s in SIZES if len(taken[s]) == SIZES[s]] == ["b"]
    assert rows[-1][0] == "b"  # the mix ends with the last row of the source that is used up
    for s, p in WEIGHTS.items():
        assert abs(len(taken[s]) / len(rows) - p) < 0.05


def test_mix_does_not_depend_on_layout(spark):
    want = mix(spark, SIZES, WEIGHTS, 1)
    assert mix(spark, SIZES, WEIGHTS, 16, rows_per_bucket=37) == want
    assert mix(spark, SIZES, WEIGHTS, 4, rows_per_bucket=300) == want
    assert mix(spark, SIZES, WEIGHTS, 4, seed=43) != want


def test_labels_are_drawn_independently(spark):
    labels = [r[0] for r in mix(spark, {"a": 4000, "b": 4000}, {"a": 1, "b": 1})]
    runs = sum(1 for _ in itertools.groupby(labels))
    assert abs(runs / len(labels) - 0.5) < 0.03


def test_mix_edges(spark):
    assert len(mix(spark, {"a": 50}, {"a": 0.2})) == 50
    assert {r[0] for r in mix(spark, SIZES, {"a": 1, "b": 0, "c": 1})} == {"a", "c"}
    assert {r[0] for r in mix(spark, {"a": 9, "c": 9}, {"a": 1, "b": 1, "c": 1})} == {"a", "c"}
    for weights in ({"a": 0.0}, {"a": -1.0, "b": 2.0}):
        with pytest.raises(ValueError):
            mix(spark, {"a": 5, "b": 5}, weights)
    with pytest.raises(ValueError):
        mix(spark, {"a": 5}, {"b": 1.0})


def test_weights():
    assert m.parse_weights("0.7,0.3", [0.5, 0.2, 0.15, 0.1, 0.05]) == [0.7, 0.3, 0.15, 0.1, 0.05]
    assert m.parse_weights(None, [0.5]) == [0.5]
    got = m.normalised({"a": 0.5, "b": 0.2, "c": 0.15})
    assert [round(v, 6) for v in got.values()] == [0.588235, 0.235294, 0.176471]


def test_known_mix(spark):
    from corpusloom.plans import adapters as a

    frames = a.blend_sources(spark, "/root/testdata/sf0.01")
    numbered = {str(i): frames[name] for i, name in enumerate(a.MIX_WEIGHTS)}
    weights = {str(i): w for i, w in enumerate(a.MIX_WEIGHTS.values())}
    rows = m.interleave(m.union_sources(numbered), weights, 42).groupBy("source").count().collect()
    assert {x["source"]: x["count"] for x in rows} == {"0": 303, "1": 129, "2": 81, "3": 61, "4": 25}


def test_row_budget(spark):
    df = m.interleave(sources(spark, SIZES), WEIGHTS, 1, position="position")
    assert m.row_budget(df, 3, 2, 2, 2).count() == 24
    assert m.row_budget(df, 0, 1).count() == df.count()
    assert m.row_budget(df, -1, 1, unbounded=False).count() == df.count()


def test_no_task_holds_all_rows(spark):
    df = m.interleave(sources(spark, SIZES), WEIGHTS, 1, position="position", rows_per_bucket=100)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows
    for line in windows:
        assert "__bucket" in line or "__total" in line
