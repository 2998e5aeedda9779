"""Queries: rendering of records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.text import WHITESPACE, code_points
from corpusloom.functions.turns import TURNS_PER_PART, part_of
from corpusloom.operators import rendering as r
from corpusloom.plans import adapters as a
from corpusloom.plans.registry import query, table

PART = f"turn // {TURNS_PER_PART} AS part"
NL = "chr(10)"
SPACES = " || ".join(f"chr({ord(c)})" for c in WHITESPACE)

EXCHANGES = """
exchanges AS (
  SELECT u.conv_id, u.turn, u.text AS prompt, a.text AS response
  FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
  WHERE u.role = 'user' AND a.role = 'assistant'
)"""
INSTRUCTIONS = f"""{EXCHANGES},
systems AS (SELECT conv_id, arg_min(text, turn) AS system FROM conversations WHERE role = 'system' GROUP BY conv_id),
instructions AS (
  SELECT e.conv_id, e.turn, e.prompt AS instruction, coalesce(s.system, '') AS input, e.response AS output
  FROM exchanges e LEFT JOIN systems s ON s.conv_id = e.conv_id
)"""


def chat_sql(piece: str, where: str = "true") -> str:
    return f"""
SELECT conv_id, {PART}, coalesce(string_agg({piece}, '' ORDER BY turn) FILTER (WHERE {where}), '') AS text
FROM conversations GROUP BY conv_id, part
"""


SHAREGPT_SQL = chat_sql(f"""'<|' || CASE role WHEN 'user' THEN 'human' WHEN 'assistant' THEN 'gpt' ELSE role END || '|>'
  || {NL} || text || {NL}""")
MESSAGES_SQL = chat_sql(f"'<|' || role || '|>' || {NL} || text || {NL}")
MARKED_SQL = chat_sql(f"'<|' || role || '|>' || {NL} || text || '<|end|>' || {NL}")
EXCHANGE_TEXT = f"'<|user|>' || {NL} || prompt || {NL} || '<|assistant|>' || {NL} || response || {NL}"
INSTRUCTION_TEXT = f"""'<|user|>' || {NL} || trim(instruction || {NL} || input, {SPACES}) || {NL}
  || '<|assistant|>' || {NL} || output || {NL}"""


@query(SHAREGPT_SQL)
def render_sharegpt(spark: SparkSession, folder: str) -> DataFrame:
    chats = a.sharegpt(spark, folder, user="Human", assistant="GPT")
    return r.render_chat(chats, keep=["conv_id", "part"])


@query(MESSAGES_SQL)
def render_messages(spark: SparkSession, folder: str) -> DataFrame:
    return r.render_chat(a.messages(spark, folder), keep=["conv_id", "part"])


@query(f"WITH {EXCHANGES} SELECT conv_id, turn, {EXCHANGE_TEXT} AS text FROM exchanges")
def render_prompt_response(spark: SparkSession, folder: str) -> DataFrame:
    return r.render_chat(a.exchanges(spark, folder), keep=["conv_id", "turn"])


@query(f"WITH {INSTRUCTIONS} SELECT conv_id, turn, {INSTRUCTION_TEXT} AS text FROM instructions")
def render_instruction(spark: SparkSession, folder: str) -> DataFrame:
    return r.render_chat(a.instructions(spark, folder), keep=["conv_id", "turn"])


@query("SELECT doc_id, text FROM documents")
def render_text(spark: SparkSession, folder: str) -> DataFrame:
    return r.render_chat(table(spark, folder, "documents").select("doc_id", "lang", "text"), keep=["doc_id"])


@query("""
SELECT doc_id, '{''quality'': ' || quality || ', ''toxic'': ' || toxic || ', ''lang'': ''' || lang || '''}' AS text
FROM labels JOIN documents USING (doc_id)
""")
def render_unknown(spark: SparkSession, folder: str) -> DataFrame:
    labels = table(spark, folder, "labels").select("doc_id", "quality", "toxic")
    langs = table(spark, folder, "documents").select("doc_id", "lang")
    return r.render_chat(labels.join(langs, "doc_id"), keep=["doc_id"])


@query(f"""
WITH {INSTRUCTIONS},
nested AS ({SHAREGPT_SQL}),
flat AS ({MESSAGES_SQL})
SELECT 'conversations' AS layout, conv_id AS key, part AS place, text FROM nested
UNION ALL SELECT 'messages', conv_id, part, text FROM flat
UNION ALL SELECT 'prompt', conv_id, turn, {EXCHANGE_TEXT} FROM exchanges
UNION ALL SELECT 'instruction', conv_id, turn, {INSTRUCTION_TEXT} FROM instructions
UNION ALL SELECT 'text', doc_id, 0, text FROM documents
""")
def render_dispatch(spark: SparkSession, folder: str) -> DataFrame:
    """Five sources of different layouts; each is dispatched on its own schema before the union."""
    key = F.col("conv_id").alias("key")
    # The layout with conversations also carries a text column, which must not win.
    nested = a.sharegpt(spark, folder).select(key, F.col("part").alias("place"), "conversations", F.lit("x").alias("text"))
    sources = {
        "conversations": nested,
        "messages": a.messages(spark, folder).select(key, F.col("part").alias("place"), "messages"),
        "prompt": a.exchanges(spark, folder).select(key, F.col("turn").alias("place"), "prompt", "response"),
        "instruction": a.instructions(spark, folder).select(
            key, F.col("turn").alias("place"), "instruction", "input", "output"
        ),
        "text": table(spark, folder, "documents").select(
            F.col("doc_id").alias("key"), F.lit(0).cast("bigint").alias("place"), "text"
        ),
    }
    rendered = [
        r.render_chat(df, keep=["key", "place"]).select(F.lit(name).alias("layout"), "key", "place", "text")
        for name, df in sources.items()
    ]
    return reduce(DataFrame.unionByName, rendered)


@query(chat_sql(f"'<|' || role || '|>' || {NL} || text || '<|end|>' || {NL}", "role IN ('user', 'assistant')"))
def render_alias_roles(spark: SparkSession, folder: str) -> DataFrame:
    turns = a.renamed_roles(table(spark, folder, "conversations"), {"user": "human", "assistant": "bot", "system": "tool"})
    chats = a.nest_turns(turns, "conversations", "from", "value")
    return r.render_chat(chats, keep=["conv_id", "part"], renderer="marked")


@query(MARKED_SQL)
def render_messages_marked(spark: SparkSession, folder: str) -> DataFrame:
    return r.render_chat(a.messages(spark, folder), keep=["conv_id", "part"], renderer="marked")


@query(f"""WITH {EXCHANGES}
SELECT conv_id, turn, '<|user|>' || {NL} || prompt || '<|end|>' || {NL} || '<|assistant|>' || {NL} || response || '<|end|>'
  AS text FROM exchanges""")
def render_prompt_response_marked(spark: SparkSession, folder: str) -> DataFrame:
    return r.render_chat(a.exchanges(spark, folder), keep=["conv_id", "turn"], renderer="marked")


@query(f"""WITH {INSTRUCTIONS}
SELECT conv_id, turn, '<|user|>' || {NL} || instruction
  || CASE WHEN length(input) > 0 THEN {NL} || {NL} || 'Input: ' || input ELSE '' END
  || '<|end|>' || {NL} || '<|assistant|>' || {NL} || output || '<|end|>' AS text FROM instructions""")
def render_instruction_input(spark: SparkSession, folder: str) -> DataFrame:
    return r.render_chat(a.instructions(spark, folder), keep=["conv_id", "turn"], renderer="marked")


@query("SELECT doc_id, text FROM documents")
def render_text_marked(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "lang", "text")
    return r.render_chat(docs, keep=["doc_id"], renderer="marked")


@query("""
SELECT doc_id, CASE WHEN length(text) > 10 THEN text ELSE 'document of ' || source END AS text FROM documents
""")
def first_long_text(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select(
        "doc_id",
        "lang",
        F.col("text").alias("body"),
        "n_chars",
        F.concat(F.lit("document of "), F.col("source")).alias("origin"),
    )
    return r.render_chat(docs, keep=["doc_id"], renderer="marked")


@query(f"""
WITH ends AS (
  SELECT conv_id, arg_max(role, turn) AS last_role, max(turn) // {TURNS_PER_PART} AS last_part FROM conversations GROUP BY conv_id
),
parts AS (
  SELECT conv_id, {PART}, string_agg('<|' || role || '|>' || {NL} || text || '<|end|>' || {NL}, '' ORDER BY turn) AS text
  FROM conversations GROUP BY conv_id, part
)
SELECT conv_id, part,
  text || CASE WHEN part = last_part AND last_role <> 'assistant' THEN '<|assistant|>' || {NL} ELSE '' END AS text
FROM parts JOIN ends USING (conv_id)
""")
def chat_template(spark: SparkSession, folder: str) -> DataFrame:
    """An assistant turn is opened at the end of a conversation that does not end with one, in its last part only."""
    turns = table(spark, folder, "conversations")
    ends = turns.groupBy("conv_id").agg(F.max_by("role", "turn").alias("last_role"), F.max(part_of("turn")).alias("last_part"))
    chats = a.messages(spark, folder).join(ends, "conv_id")
    open_turn = (F.col("part") == F.col("last_part")) & (F.col("last_role") != "assistant")
    return chats.select("conv_id", "part", r.template_text(chats, generation_prompt=open_turn).alias("text"))


@query(f"""
SELECT conv_id, turn, '<|user|>' || {NL} || text || '<|end|>' || {NL} || '<|assistant|>' || {NL} AS prompt
FROM conversations WHERE role = 'user'
""")
def single_prompt(spark: SparkSession, folder: str) -> DataFrame:
    asked = table(spark, folder, "conversations").where("role = 'user'")
    return asked.select("conv_id", "turn", r.single_prompt(F.col("text")).alias("prompt"))


@query(f"""
WITH pieces AS (
  SELECT conv_id, turn, {PART}, role,
    CASE WHEN role = 'user' THEN '<|user|>' ELSE '<|assistant|>' END || {NL} || text || '<|end|>' || {NL} AS piece
  FROM conversations
),
wholes AS (SELECT conv_id, part, string_agg(piece, '' ORDER BY turn) AS whole FROM pieces GROUP BY conv_id, part),
own AS (
  SELECT conv_id, turn, part, role, string_agg(piece, '') OVER (PARTITION BY conv_id, part ORDER BY turn) AS prompt FROM pieces
)
SELECT conv_id, turn, part, prompt || '<|assistant|>' || {NL} AS prompt FROM own WHERE role = 'user'
UNION ALL
SELECT p.conv_id, p.turn, w.part, w.whole FROM pieces p JOIN wholes w ON w.conv_id = p.conv_id AND w.part < p.part
WHERE p.role = 'user'
""")
def history_prompts(spark: SparkSession, folder: str) -> DataFrame:
    return r.history_prompts(table(spark, folder, "conversations"))


@query(f"WITH {EXCHANGES} SELECT conv_id, turn, trim(response, {SPACES}) AS completion FROM exchanges")
def completion_extract(spark: SparkSession, folder: str) -> DataFrame:
    prompt = r.single_prompt(F.col("prompt"))
    full = F.concat(prompt, F.lit("  \n"), F.col("response"), F.lit("\n\t"))
    return a.exchanges(spark, folder).select("conv_id", "turn", r.completion_text(full, prompt).alias("completion"))


@query(f"""WITH {EXCHANGES}
SELECT conv_id, turn, list_aggregate(list_transform(string_split(response, ''), lambda c: unicode(c)), 'string_agg', ',')
  AS completion FROM exchanges""")
def completion_tokens(spark: SparkSession, folder: str) -> DataFrame:
    prompt, full = code_points(F.col("prompt")), code_points(F.concat("prompt", "response"))
    return a.exchanges(spark, folder).select(
        "conv_id", "turn", a.joined_ids(r.completion_ids(full, prompt)).alias("completion")
    )
