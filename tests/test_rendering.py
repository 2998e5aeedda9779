import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from corpusloom.operators import rendering as r


def text_of(spark, schema, *rows, renderer="plain"):
    df = spark.createDataFrame(list(rows), schema)
    return [x.text for x in r.render_chat(df, renderer=renderer).collect()]


SHAREGPT = "conversations array<struct<from:string,value:string>>"
MESSAGES = "messages array<struct<role:string,content:string>>"


def test_sharegpt(spark):
    rows = [([("Human", "hi"), ("gpt", "yo")],), ([(None, "x")],), ([],), ([("user", None)],)]
    assert text_of(spark, SHAREGPT, *rows) == ["<|human|>\nhi\n<|gpt|>\nyo\n", "<|user|>\nx\n", "", "<|user|>\n\n"]


def test_sharegpt_without_role_field(spark):
    assert text_of(spark, "conversations array<struct<value:string>>", ([("x",)],)) == ["<|user|>\nx\n"]


def test_messages(spark):
    assert text_of(spark, MESSAGES, ([("System", "s"), ("user", "u")],)) == ["<|system|>\ns\n<|user|>\nu\n"]


def test_prompt_response(spark):
    assert text_of(spark, "prompt string, response string", ("p", "r")) == ["<|user|>\np\n<|assistant|>\nr\n"]


def test_instruction(spark):
    schema = "instruction string, input string, output string"
    got = text_of(spark, schema, ("do", "", "ok"), (" do", "it ", "ok"), (" do\x1f", None, "ok"))
    assert got == [
        "<|user|>\ndo\n<|assistant|>\nok\n",
        "<|user|>\ndo\nit\n<|assistant|>\nok\n",
        "<|user|>\ndo\n<|assistant|>\nok\n",
    ]
    assert text_of(spark, "instruction string, output string", ("a", "b")) == ["<|user|>\na\n<|assistant|>\nb\n"]


def test_layout_precedence(spark):
    both = SHAREGPT + ", text string, " + MESSAGES
    assert text_of(spark, both, ([("a", "b")], "t", [("c", "d")])) == ["<|a|>\nb\n"]
    assert text_of(spark, "prompt string, text string", ("p", "t")) == ["t"]


def test_unknown_layout_is_a_python_dict(spark):
    schema = "a int, b string, c double, d boolean, e array<struct<x:string>>, f string"
    row = (1, "it's\n é", 1.0, True, [("q",)], None)
    want = {"a": 1, "b": "it's\n é", "c": 1.0, "d": True, "e": [{"x": "q"}], "f": None}
    assert text_of(spark, schema, row) == [str(want)]


def test_python_form_of_all_types(spark):
    """Against Python itself: every type, quotes, escapes, and floats of all sizes."""
    import datetime as dt
    import random
    from decimal import Decimal

    dice = random.Random(3)
    texts = ["", "'", '"', "'\"", "\\", "a\nb\rc\td", "\x00\x1f\x7f\x85\xa0", "\u200b\u2028\ufeff\ue000", "é😀\U000e0001", "\\n'", " x "]
    floats = [0.0, -0.0, 1.0, -1.5, 1e15, 1e16, 123456789012345680.0, 1e-4, 1e-5, 0.1 + 0.2, 2e23, 8.41e21, 2.0e-3, 1e100, 5e-324, float("inf"), float("-inf"), float("nan"), 1e22, 9.5e-44]
    floats += [dice.uniform(-1, 1) * 10.0 ** dice.randint(-30, 30) for _ in range(300)] + [float(dice.randint(-9999, 9999)) for _ in range(20)]
    schema = (
        "s string, d double, f float, i long, b boolean, y binary, a array<string>, m map<int,double>, day date, at timestamp_ntz,"
        " n decimal(9,2), r struct<`it's`:string,e:array<struct<x:int>>>, none string"
    )
    rows = []
    for k, number in enumerate(floats):
        s = texts[k % len(texts)]
        at = dt.datetime(2020, 1, 2, 3, k % 60, k % 2, k % 3)
        rows.append(
            (s, number, 0.1 * k, k - 9, k % 2 == 0, s.encode() + bytes([k % 256]), [s, None][: k % 3], {k: number}, at.date(), at,
             Decimal(k) / 4, (s, [(k,), None]), None)
        )
    rows.append((None,) * 13)
    frame = spark.createDataFrame(rows, schema)
    texts_of = r.render_chat(frame)
    assert "Python" not in texts_of._jdf.queryExecution().executedPlan().toString()
    want = [str({**x.asDict(recursive=True), "y": x.y if x.y is None else bytes(x.y)}) for x in frame.collect()]
    for got, expected in zip([x.text for x in texts_of.collect()], want, strict=True):
        assert got == expected


def test_marked_conversations(spark):
    rows = [([("human", "a"), ("bot", "b"), ("tool", "c"), ("system", "d")],)]
    assert text_of(spark, SHAREGPT, *rows, renderer="marked") == [
        "<|user|>\na<|end|>\n<|assistant|>\nb<|end|>\n<|system|>\nd<|end|>\n"
    ]
    schema = "conversations array<struct<role:string,from:string,content:string>>"
    assert text_of(spark, schema, ([("assistant", "human", "a")],), renderer="marked") == ["<|assistant|>\na<|end|>\n"]


def test_marked_messages_keep_roles(spark):
    assert text_of(spark, MESSAGES, ([("tool", "c")],), renderer="marked") == ["<|tool|>\nc<|end|>\n"]


def test_marked_instruction(spark):
    got = text_of(spark, "instruction string, input string, response string", ("i", "x", "r"), renderer="marked")
    assert got == ["<|user|>\ni\n\nInput: x<|end|>\n<|assistant|>\nr<|end|>"]
    got = text_of(spark, "instruction string, input string", ("i", ""), renderer="marked")
    assert got == ["<|user|>\ni<|end|>\n<|assistant|>\n<|end|>"]


def test_marked_prompt_response(spark):
    got = text_of(spark, "prompt string, response string", ("p", "r"), renderer="marked")
    assert got == ["<|user|>\np<|end|>\n<|assistant|>\nr<|end|>"]


def test_first_long_text(spark):
    assert text_of(spark, "a string, n int, b string", ("short", 1, "long enough text"), renderer="marked") == [
        "long enough text"
    ]
    with pytest.raises(PySparkException, match="no text field"):
        text_of(spark, "a string", ("short",), renderer="marked")


def test_template(spark):
    df = spark.createDataFrame([([("user", "a"), ("tool", "t")],)], MESSAGES)
    assert df.select(r.template_text(df, generation_prompt=True)).first()[0] == (
        "<|user|>\na<|end|>\n<|assistant|>\n"
    )
    assert df.select(r.template_text(df)).first()[0] == "<|user|>\na<|end|>\n"


def history(spark, rows, **options):
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    return {(x.conv_id, x.turn, x.part): x.prompt for x in r.history_prompts(df, **options).collect()}


def test_history(spark):
    rows = [(7, 2, "user", "c"), (7, 0, "user", "a"), (7, 1, "assistant", "b")]
    assert history(spark, rows) == {
        (7, 0, 0): "<|user|>\na<|end|>\n<|assistant|>\n",
        (7, 2, 0): "<|user|>\na<|end|>\n<|assistant|>\nb<|end|>\n<|user|>\nc<|end|>\n<|assistant|>\n",
    }


def test_history_of_a_long_conversation_is_whole_in_parts(spark):
    rows = [(1, i, "user" if i % 2 == 0 else "tool", f"t{i}é😀") for i in range(11)] + [(2, 0, "user", "x")]
    whole = {k[:2]: v for k, v in history(spark, rows).items()}
    parts = history(spark, rows, turns_per_part=3)
    for key, prompt in whole.items():
        pieces = sorted((k[2], v) for k, v in parts.items() if k[:2] == key)
        assert "".join(v for _, v in pieces) == prompt
        assert len(pieces) == key[1] // 3 + 1


def test_completion(spark):
    df = spark.createDataFrame([("😀ab", "😀ab  c d\n", [1, 2], [1, 2, 3]), ("ab", "ab", [1], [1])], "p string, f string, i array<int>, j array<int>")
    got = df.select(r.completion_text(F.col("f"), F.col("p")), r.completion_ids(F.col("j"), F.col("i"))).collect()
    assert [tuple(x) for x in got] == [("c d", [3]), ("", [])]


def test_pick_text(spark):
    df = spark.createDataFrame([("i", "t", "c")], "input string, text string, content string")
    assert r.pick_text(df).first().text == "c"
    assert r.pick_text(df.drop("content")).first().text == "t"
    with pytest.raises(ValueError):
        r.pick_text(df.select(F.lit(1).alias("x")))


def test_strip_matches_python(spark):
    from corpusloom.functions.text import WHITESPACE, strip

    assert all(c.isspace() for c in WHITESPACE)
    assert set(WHITESPACE) == {chr(i) for i in range(0x110000) if chr(i).isspace()}
    texts = [WHITESPACE + "a b" + WHITESPACE, "​a", "", " "]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [x[0] for x in df.select(strip(F.col("t"))).collect()] == [t.strip() for t in texts]


def test_rendering_stays_inside_the_engine(spark):
    for schema in (SHAREGPT, MESSAGES, "prompt string, response string", "instruction string, output string"):
        for renderer in ("plain", "marked"):
            plan = r.render_chat(spark.createDataFrame([], schema), renderer=renderer)
            text = plan._jdf.queryExecution().executedPlan().toString()
            assert "Python" not in text and "Exchange" not in text
