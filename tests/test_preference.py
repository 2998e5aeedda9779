import pytest

from corpusloom.operators import preference as p
from corpusloom.sources.literal import fallback_pairs


def pairs(spark, schema, *rows, build=p.build_pairs):
    return [(x.prompt, x.chosen, x.rejected) for x in build(spark.createDataFrame(list(rows), schema)).collect()]


CHAT = "array<struct<role:string,content:string>>"


def test_prompt_column_wins(spark):
    schema = "prompt string, question string, chosen string, rejected string"
    assert pairs(spark, schema, ("p", "q", "c", "r")) == [("p", "c", "r")]


def test_question_with_system(spark):
    schema = "question string, system string, chosen string, rejected string"
    got = pairs(spark, schema, ("q", "s", "c", "r"), ("q", "", "c", "r"), ("q", None, "c", "r"))
    assert [g[0] for g in got] == ["s\n\nq", "q", "q"]


def test_no_prompt_drops_all(spark):
    assert pairs(spark, "chosen string, rejected string", ("c", "r")) == []


def test_nested_chat_overrides_prompt(spark):
    row = ("ignored", [("user", "u"), ("assistant", "v")], [("user", "u"), ("assistant", "w")])
    assert pairs(spark, f"prompt string, chosen {CHAT}, rejected {CHAT}", row) == [("<|user|>\nu<|end|>\n", "v", "w")]


def test_assistant_and_context_text(spark):
    chat = [("assistant", "a"), ("user", "u"), ("gpt", "b"), (None, "n"), ("human", "h"), ("tool", "t")]
    df = spark.createDataFrame([(chat, "plain")], f"c {CHAT}, s string")
    got = df.select(
        p.assistant_text(df, "c"), p.context_text(df, "c"), p.assistant_text(df, "s"), p.context_text(df, "s")
    ).first()
    assert tuple(got) == (
        "abn", "<|user|>\nu<|end|>\n<|user|>\nn<|end|>\n<|human|>\nh<|end|>\n", "plain", "",
    )


def test_ab(spark):
    schema = "prompt string, response_a string, response_b string, preference int"
    got = pairs(spark, schema, *[("p", "A", "B", x) for x in (1, 2, 0, None)])
    assert [g[1] for g in got] == ["A", "B", "B", "B"]
    assert pairs(spark, "prompt string, response_a string, response_b string", ("p", "A", "B")) == [("p", "A", "B")]


def test_empty_sides_are_dropped(spark):
    schema = "prompt string, chosen string, rejected string"
    rows = [("p", "c", "r"), ("", "c", "r"), ("p", "", "r"), ("p", "c", ""), (None, "c", "r"), ("p", None, "r")]
    assert pairs(spark, schema, *rows) == [("p", "c", "r")]


def test_loader_keeps_columns_and_rows(spark):
    df = spark.createDataFrame([("c", "", 5)], "chosen string, rejected string, extra int")
    assert p.load_pairs(df).collect()[0].asDict() == {"chosen": "c", "rejected": "", "extra": 5, "prompt": ""}
    df = spark.createDataFrame([("p", "A", "B", None)], "prompt string, response_a string, response_b string, preference int")
    got = p.load_pairs(df).first()
    assert (got.chosen, got.rejected, got.response_a) == ("B", "A", "A")


def test_unknown_layout_fails_when_planned(spark):
    df = spark.createDataFrame([("x",)], "other string")
    for build in (p.build_pairs, p.load_pairs):
        with pytest.raises(ValueError):
            build(df)


def test_parts_count_as_one_pair(spark):
    df = spark.createDataFrame(
        [(1, 0, "p", "c", ""), (1, 1, "", "", "r"), (2, 0, "p", "c", "")],
        "conv_id int, part int, prompt string, chosen string, rejected string",
    )
    assert sorted((x.conv_id, x.part) for x in p.nonempty_by(df, "conv_id").collect()) == [(1, 0), (1, 1)]


def test_fallback_pairs(spark):
    rows = fallback_pairs(spark).collect()
    assert len(rows) == 300
    assert rows[0].prompt == rows[297].prompt == "What is 2 + 2?"
    assert rows[2].chosen == "Lines of code flow down\nBugs hide in the logic maze\nDebugger awaits"
    assert p.build_pairs(fallback_pairs(spark)).count() == 300


def test_pairs_are_one_narrow_stage(spark):
    df = spark.createDataFrame([], f"chosen {CHAT}, rejected {CHAT}")
    plan = p.build_pairs(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
