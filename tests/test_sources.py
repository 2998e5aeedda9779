import pytest
from pyspark.sql import functions as F

from corpusloom.sources import catalogue as c
from corpusloom.sources.readers import Layout, columns_of, load_report, load_sources, scan, with_order_key
from corpusloom.sources.sinks import land


def test_pretrain_blend():
    assert [(s.weight, s.streaming) for s in c.pretrain_blend(weights="0.7,0.3")] == [
        (0.7, True), (0.3, True), (0.15, True), (0.1, True), (0.05, True),
    ]
    assert [s.config_name for s in c.pretrain_blend()] == [None, None, None, c.SPECIALIZED_CONFIG, None]
    (named,) = c.pretrain_blend("x/y", "cfg", use_sample=True, streaming=False)
    assert (named.name, named.config_name, named.streaming, named.split) == ("x/y", "cfg", False, "train")
    (sample,) = c.pretrain_blend(use_sample=True)
    assert (sample.streaming, sample.config_name) == (False, c.SAMPLE_CONFIG)


def test_sft_blend():
    assert len(c.sft_blend()) == len(c.sft_blend(subset="all")) == 6
    assert [s.weight for s in c.sft_blend(subset="math")] == [0.25, 0.15]
    assert [s.split for s in c.sft_blend(subset="chat")] == ["chat_if"]
    assert [s.streaming for s in c.sft_blend(subset="code")] == [False]
    assert [len(c.sft_blend(subset=s)) for s in ("science", "code")] == [1, 1]
    with pytest.warns(UserWarning, match="unknown subset"):
        assert [len(c.sft_blend(subset=s)) for s in ("poetry", "agentic", "math_proofs")] == [6, 6, 6]


def test_custom_sft_sources():
    (s,) = c.sft_blend("a/ultrachat_200k")
    assert (s.split, s.config_name, s.fallback_name) == ("train_sft", None, None)
    (s,) = c.sft_blend(c.POST_TRAINING_V2, subset="all")
    assert (s.split, s.config_name, s.fallback_name) == ("all", "default", c.POST_TRAINING_V1)
    (s,) = c.sft_blend(c.POST_TRAINING_V1, subset="math")
    assert (s.split, s.config_name) == ("math", None)
    (s,) = c.sft_blend("other/data", subset="math")
    assert s.split == "train"


def test_split_is_a_pruned_directory(spark, tmp_path):
    df = spark.range(100).withColumn("split", F.when(F.col("id") < 30, "train").otherwise("test"))
    land(df, str(tmp_path / "n" / "cfg"), partition_by="split")
    got = scan(spark, Layout(str(tmp_path)), c.Source("n", config_name="cfg"))
    assert got.count() == 30 and columns_of(got) == ["id"]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan


def test_formats_and_tables(spark, tmp_path):
    spark.range(3).write.json(str(tmp_path / "j"))
    assert scan(spark, Layout(str(tmp_path), "json"), c.Source("j")).count() == 3
    spark.range(4).createOrReplaceTempView("known_source")
    assert scan(spark, Layout("", tables=True), c.Source("known_source")).count() == 4


def test_order_key_follows_the_files(spark, tmp_path):
    for i, name in enumerate("cab"):
        spark.range(i * 10, i * 10 + 10, 1, 1).write.parquet(str(tmp_path / "t" / f"part={name}"))
    keyed = with_order_key(spark.read.parquet(str(tmp_path / "t")))
    rows = sorted(keyed.collect(), key=lambda x: x.key)
    assert [x.id for x in rows] == [*range(10, 20), *range(20, 30), *range(0, 10)]
    assert keyed.columns == ["id", "part", "key"]


@pytest.mark.filterwarnings("ignore:could not load")
def test_failed_sources_are_skipped_or_replaced(spark, tmp_path):
    spark.range(5).write.parquet(str(tmp_path / "good"))
    sources = [
        c.Source("gone", 0.5), c.Source("gated", 0.2, config_name="default", fallback_name="good"), c.Source("good", 0.3)
    ]
    report = load_sources(lambda s: scan(spark, Layout(str(tmp_path)), s), sources)
    assert [(e.source.name, e.loaded_from) for e in report] == [("gone", None), ("gated", "good"), ("good", "good")]
    assert "gone" in report[0].error and report[1].source.weight == 0.2
    assert load_report(spark, report).where("loaded").count() == 2
    with pytest.raises(ValueError):
        load_sources(lambda s: scan(spark, Layout(str(tmp_path)), s), sources[:1])
