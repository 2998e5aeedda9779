"""Rules that must not change with the size of the input."""

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import turns as turns_module
from corpusloom.operators import mixing, ordering, runs
from corpusloom.plans import chat
from corpusloom.plans.datasets import preference_dataset, sft_dataset

FOLDER = "/root/testdata/sf0.001"


def test_bounded_mix_is_whole(spark):
    rows = spark.range(1000).withColumnRenamed("id", "position")
    assert mixing.row_budget(rows, -1, 1).count() == 1000
    assert mixing.row_budget(rows, 5, 2).count() == 11  # positions 0 to 10
    frames = {"a": spark.range(400).select(F.col("id").alias("key"), F.lit("t").alias("text"))}
    assert sft_dataset(frames, {"a": 1.0}, per_device_batch=1, accumulation=1).count() == 400


@pytest.mark.parametrize("size", [2, 3, 1024])
def test_parts_join_to_the_whole_template(spark, monkeypatch, size):
    whole = {r.conv_id: r.text for r in chat.chat_template(spark, FOLDER).collect()}
    monkeypatch.setattr(turns_module, "TURNS_PER_PART", size)
    parts = {}
    for r in sorted(chat.chat_template(spark, FOLDER).collect(), key=lambda r: (r.conv_id, r.part)):
        parts[r.conv_id] = parts.get(r.conv_id, "") + r.text
    assert parts == whole


@pytest.mark.parametrize("size", [1, 3, 1024])
def test_nested_pairs_are_dropped_by_conversation(spark, size):
    def side(*texts):
        return [turn for t in texts for turn in (("user", f"q{t}"), ("assistant", t))]

    pairs = {1: (side("a", "b"), side("c", "d")), 2: (side("", ""), side("c", "d")), 3: (side("", "x"), side("y", ""))}
    rows = []
    for key, (chosen, rejected) in pairs.items():
        for part in range(-(-len(chosen) // size)):
            at = slice(part * size, (part + 1) * size)
            rows.append((key, part, chosen[at], rejected[at]))
    turn = "array<struct<role:string,content:string>>"
    frame = spark.createDataFrame(rows, f"conv_id long, part long, chosen {turn}, rejected {turn}")
    text = {}
    for r in sorted(preference_dataset(frame, conversation="conv_id").collect(), key=lambda r: r.part):
        text[r.conv_id] = tuple(x + y for x, y in zip(text.get(r.conv_id, ("", "", "")), (r.prompt, r.chosen, r.rejected)))
    assert {k: v[1:] for k, v in text.items()} == {1: ("ab", "cd"), 3: ("x", "y")}


@pytest.mark.parametrize("last_n", [1, 999, 1000, 1001, 2000])
def test_values_without_a_step_are_the_oldest(spark, last_n):
    rows = [("k", i, float(i)) for i in range(1500)] + [("k", None, 1e6)] * 3
    got = runs.metric_averages(spark.createDataFrame(rows, "key string, step long, value double"), last_n).first().mean
    values = [1e6] * 3 + [float(i) for i in range(1500)]
    assert got == pytest.approx(sum(values[-last_n:]) / min(last_n, len(values)))


def test_first_n_leaves_out_missing_keys(spark):
    rows = spark.createDataFrame([(None,), (3,), (1,), (2,), (None,)], "key long")
    for n in (2, 3, 10):
        assert sorted(r.key for r in ordering.first_n(rows, n, "key", 2).collect()) == [1, 2, 3][:n]


def test_empty_tensors_are_reported(spark):
    rows = [("a", []), ("b", None), ("c", [1.0, 2.0]), ("a", [5.0])]
    stats = {r.name: (r.numel, r.health) for r in runs.tensor_statistics(spark.createDataFrame(rows, "name string, values array<float>")).collect()}
    assert stats == {"a": (1, "ok"), "b": (0, "ok"), "c": (2, "ok")}


def test_no_window_holds_all_rows(spark):
    rows = spark.range(1000).select(F.col("id").alias("key"), F.lit("payload").alias("text"))
    for df in (ordering.numbered(rows, ["key"]), ordering.seeded_shuffle(rows, "key", 1)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any("SinglePartition" in line and "text" in line for line in plan.splitlines())
        assert sorted(r[0] for r in df.select(df.columns[-1]).collect()) == list(range(1, 1001))


def test_stages_from_a_blend(spark):
    from corpusloom.operators.tokens import Vocabulary
    from corpusloom.plans.datasets import encoded_pairs, sft_from_blend
    from corpusloom.sources.catalogue import Source

    blend = [Source("documents", 0.5), Source("gated", 0.5, fallback_name="benchmark"), Source("missing", 0.5)]

    def read(source):
        return spark.read.parquet(f"{FOLDER}/{source.name}.parquet").select("text")

    with pytest.warns(UserWarning, match="could not load"):
        rows = sft_from_blend(read, blend).collect()
    assert {r.source for r in rows} == {"documents", "gated"} and len(rows) > 40
    with pytest.warns(UserWarning):
        packed = sft_from_blend(read, blend, vocabulary=Vocabulary([]), max_length=64).collect()
    sizes = sorted(len(r.input_ids) for r in packed)
    assert set(sizes[1:]) == {64} and sum(sizes) == sum(len(r.text.encode()) + 1 for r in rows)
    pairs = spark.createDataFrame([(1, "abc", "de", "f"), (2, "xy", "z", "long")], "id long, prompt string, chosen string, rejected string")
    got = {r.id: r for r in encoded_pairs(pairs, Vocabulary([]), "id", max_length=5, max_prompt_length=2).collect()}
    assert {i: (len(r.prompt), len(r.chosen_ids), len(r.rejected_ids)) for i, r in got.items()} == {1: (2, 4, 4), 2: (2, 5, 5)}


@pytest.mark.parametrize("keep_last", [3, 1500])
def test_retention_is_the_same_for_many_checkpoints(spark, monkeypatch, keep_last):
    rows = [(run, f"checkpoint-{i}", float(i % 7)) for run in (1, 2) for i in range(2000)]
    frame = spark.createDataFrame(rows, "run long, path string, loss double")
    kept = {(r.run, r.path) for r in runs.checkpoint_retention(frame, keep_last, keep_best=False).where("keep").collect()}
    assert kept == {(run, f"checkpoint-{i}") for run in (1, 2) for i in range(2000 - keep_last, 2000)}
