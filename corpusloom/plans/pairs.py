"""Queries: preference pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators import preference as p
from corpusloom.plans import adapters as a
from corpusloom.plans.chat import INSTRUCTIONS, NL, chat_sql
from corpusloom.plans.registry import query, table
from corpusloom.sources import literal

FLAT = f"""{INSTRUCTIONS},
flat AS (
  SELECT e.conv_id, e.turn, e.prompt, e.response AS chosen, n.response AS rejected
  FROM exchanges e LEFT JOIN exchanges n ON n.conv_id = e.conv_id + 1 AND n.turn = e.turn
)"""
CONTEXT_SQL = chat_sql(f"'<|' || role || '|>' || {NL} || text || '<|end|>' || {NL}", "role IN ('user', 'human', 'system')")
ANSWER_SQL = chat_sql("text", "role IN ('assistant', 'gpt', 'bot')")
AB = """
ab AS (
  SELECT d.doc_id, d.source AS prompt, d.text AS response_a, n.text AS response_b, l.quality AS preference
  FROM documents d LEFT JOIN documents n ON n.doc_id = d.doc_id + 1 LEFT JOIN labels l ON l.doc_id = d.doc_id
)"""
NONEMPTY = "length(prompt) > 0 AND length(chosen) > 0 AND length(rejected) > 0"
AB_SIDES = """CASE WHEN preference = 1 THEN response_a ELSE response_b END AS chosen,
  CASE WHEN preference = 1 THEN response_b ELSE response_a END AS rejected"""


def questions(spark: SparkSession, folder: str) -> DataFrame:
    return a.flat_pairs(spark, folder).withColumnRenamed("prompt", "question").join(
        a.system_texts(spark, folder), "conv_id", "left"
    )


@query(f"""WITH {FLAT}
SELECT f.conv_id, f.turn, CASE WHEN length(s.system) > 0 THEN s.system || {NL} || {NL} ELSE '' END || prompt AS prompt
FROM flat f LEFT JOIN systems s ON s.conv_id = f.conv_id""")
def prompt_resolve(spark: SparkSession, folder: str) -> DataFrame:
    rows = questions(spark, folder)
    return rows.select("conv_id", "turn", p.resolve_prompt(rows).alias("prompt"))


@query(f"""WITH {FLAT}
SELECT conv_id, turn, prompt, chosen, rejected FROM flat WHERE {NONEMPTY}""")
def pairs_flat(spark: SparkSession, folder: str) -> DataFrame:
    return p.build_pairs(a.flat_pairs(spark, folder), keep=["conv_id", "turn"])


@query(f"""WITH {FLAT}
SELECT f.conv_id, f.turn, CASE WHEN length(s.system) > 0 THEN s.system || {NL} || {NL} ELSE '' END || prompt AS prompt,
  chosen, rejected
FROM flat f LEFT JOIN systems s ON s.conv_id = f.conv_id WHERE {NONEMPTY}""")
def pairs_question(spark: SparkSession, folder: str) -> DataFrame:
    return p.build_pairs(questions(spark, folder), keep=["conv_id", "turn"])


@query(f"""
WITH context AS ({CONTEXT_SQL}), answer AS ({ANSWER_SQL}),
pairs AS (
  SELECT c.conv_id, c.part, c.text AS prompt, a.text AS chosen, r.text AS rejected
  FROM context c JOIN answer a ON a.conv_id = c.conv_id AND a.part = c.part
  LEFT JOIN answer r ON r.conv_id = c.conv_id + 1 AND r.part = c.part
),
filled AS (
  SELECT conv_id FROM pairs GROUP BY conv_id
  HAVING max(length(prompt)) > 0 AND max(length(chosen)) > 0 AND max(length(rejected)) > 0
)
SELECT conv_id, part, prompt, chosen, rejected FROM pairs SEMI JOIN filled USING (conv_id)
""")
def pairs_nested(spark: SparkSession, folder: str) -> DataFrame:
    """Whole conversations on both sides; a pair of several parts is dropped only when a side is empty in all of them."""
    rows = a.nested_pairs(spark, folder)
    return p.nonempty_by(rows.select("conv_id", "part", *p.pair_columns(rows)), "conv_id")


@query(ANSWER_SQL)
def assistant_text(spark: SparkSession, folder: str) -> DataFrame:
    rows = a.messages(spark, folder)
    return rows.select("conv_id", "part", p.assistant_text(rows, "messages").alias("text"))


@query(CONTEXT_SQL)
def context_text(spark: SparkSession, folder: str) -> DataFrame:
    rows = a.messages(spark, folder)
    return rows.select("conv_id", "part", p.context_text(rows, "messages").alias("text"))


@query(f"WITH {AB} SELECT doc_id, {AB_SIDES} FROM ab")
def pairs_ab(spark: SparkSession, folder: str) -> DataFrame:
    rows = a.ab_records(spark, folder)
    chosen, rejected = p.preferred(rows)
    return rows.select("doc_id", chosen.alias("chosen"), rejected.alias("rejected"))


@query(f"WITH {AB}, sides AS (SELECT doc_id, prompt, {AB_SIDES} FROM ab) SELECT * FROM sides WHERE {NONEMPTY}")
def pairs_prepared(spark: SparkSession, folder: str) -> DataFrame:
    return p.build_pairs(a.ab_records(spark, folder), keep=["doc_id"])


@query(f"WITH {AB} SELECT doc_id, prompt, response_a, response_b, preference, {AB_SIDES} FROM ab")
def pairs_loader(spark: SparkSession, folder: str) -> DataFrame:
    return p.load_pairs(a.ab_records(spark, folder))


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


@query(
    "WITH templates AS (SELECT * FROM (VALUES "
    + ", ".join(f"({i}, {', '.join(_quoted(s) for s in row)})" for i, row in enumerate(literal.TEMPLATES))
    + ") t(i, prompt, chosen, rejected)) "
    "SELECT doc_id, prompt, chosen, rejected FROM documents JOIN templates ON i = doc_id % 3"
)
def pairs_literal(spark: SparkSession, folder: str) -> DataFrame:
    """The built-in pairs, dealt to all documents in turn."""
    return literal.with_templates(table(spark, folder, "documents").select("doc_id"), F.col("doc_id"))


@query(f"WITH {FLAT} SELECT count(*) AS pairs, count(*) FILTER (WHERE {NONEMPTY}) AS nonempty FROM flat")
def pair_row_count(spark: SparkSession, folder: str) -> DataFrame:
    return a.flat_pairs(spark, folder).agg(
        F.count(F.lit(1)).alias("pairs"), F.count_if(p.all_filled()).alias("nonempty")
    )
