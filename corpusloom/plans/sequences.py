"""Queries: vocabulary, tokens, batches and packing."""

from __future__ import annotations

import warnings

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators import batching as b
from corpusloom.operators import tokens as k
from corpusloom.operators.rendering import template_text
from corpusloom.plans import adapters as a
from corpusloom.plans.blends import SEED, mix_sql
from corpusloom.plans.chat import EXCHANGE_TEXT, INSTRUCTION_TEXT, INSTRUCTIONS, MARKED_SQL
from corpusloom.plans.datasets import preference_dataset, pretrain_from_blend, sft_dataset
from corpusloom.plans.pairs import FLAT
from corpusloom.plans.registry import query, table
from corpusloom.session import scratch_path
from corpusloom.sources.catalogue import Source

MAX_LENGTH = 2048
BATCH = 8
PACKED = 2048
PAD, END = 0, 2

SIMPLE_PATTERN = a.SIMPLE_PATTERN
_PATTERN_SQL = "'" + SIMPLE_PATTERN.replace("'", "''") + "'"
WORDS_SQL = f"words AS (SELECT unnest(regexp_extract_all(text, {_PATTERN_SQL})) AS word FROM documents)"
IDS_SQL = "ids AS (SELECT doc_id AS key, list_transform(string_split(text, ''), lambda c: unicode(c)) AS ids FROM documents)"


def joined_sql(ids: str) -> str:
    return f"coalesce(list_aggregate({ids}, 'string_agg', ','), '')"


@query(f"WITH {WORDS_SQL} SELECT word, count(*) AS freq FROM words GROUP BY word")
def word_counts(spark: SparkSession, folder: str) -> DataFrame:
    return k.word_counts(a.texts(spark, folder), pattern=SIMPLE_PATTERN)


@query(f"""
WITH {WORDS_SQL}, counts AS (SELECT word, count(*) AS freq FROM words GROUP BY word),
chars AS (SELECT string_split(word, '') AS c, freq FROM counts WHERE length(word) > 1),
pairs AS (SELECT c[i] || c[i + 1] AS pair, freq FROM (SELECT c, freq, unnest(range(1, len(c))) AS i FROM chars))
SELECT pair, CAST(sum(freq) AS BIGINT) AS freq FROM pairs GROUP BY pair
""")
def pair_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Adjacent characters of all words, weighted by how often the words occur."""
    return k.pair_counts(word_counts(spark, folder), symbols="word")


# The vocabularies of these queries are of full size, which is too slow for a recursive query; the tests hold a small one against
# SQL and a large one against the public tokenizer library.


@query()
def bpe_merges(spark: SparkSession, folder: str) -> DataFrame:
    return a.vocabulary(spark, folder).merges_frame(spark)


@query()
def bpe_vocabulary(spark: SparkSession, folder: str) -> DataFrame:
    return a.vocabulary(spark, folder).vocab_frame(spark)


@query(f"""
WITH rendered AS ({MARKED_SQL})
SELECT id, token, CAST(sum((length(text) - length(replace(text, token, ''))) / length(token)) AS BIGINT) AS n
FROM rendered, (VALUES {", ".join(f"({i}, '{t}')" for i, t in enumerate(k.RESERVED_TOKENS))}) t(id, token) GROUP BY id, token
""")
def reserved_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """Reserved tokens with their ids, and how often rendered conversations use them."""
    chats = a.messages(spark, folder)
    texts = chats.select(template_text(chats).alias("text"))
    uses = [
        F.sum((F.length("text") - F.length(F.replace("text", F.lit(t)))) / len(t)).cast("bigint")
        for t in k.RESERVED_TOKENS
    ]
    rows = F.array(
        *[F.struct(F.lit(i).alias("id"), F.lit(t).alias("token"), n.alias("n")) for i, (t, n) in enumerate(zip(k.RESERVED_TOKENS, uses, strict=True))]
    )
    return texts.agg(rows.alias("rows")).select(F.inline("rows"))


CHARS_SQL = """
chars AS (SELECT DISTINCT unnest(string_split(text, '')) AS token FROM documents),
vocab AS (SELECT token, row_number() OVER (ORDER BY unicode(token)) - 1 AS id, false AS special FROM chars WHERE token <> '')"""


@query(f"""
WITH {CHARS_SQL}
SELECT token, id, special FROM vocab
UNION ALL SELECT '<|startoftext|>', (SELECT max(id) + 1 FROM vocab), true
UNION ALL SELECT '<|endoftext|>', (SELECT max(id) + 2 FROM vocab), true
""")
def special_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """A vocabulary that has a pad token but neither bos nor eos gets both."""
    return k.ensure_specials(a.character_vocabulary(spark, folder), assigned={"pad": " "})


@query(f"""
WITH {CHARS_SQL}
SELECT CAST({k.VOCAB_SIZE} AS BIGINT) AS declared, count(*) AS actual, max(id) AS max_id, count(*) <> {k.VOCAB_SIZE} AS resized,
  count(*) AS adopted FROM vocab
""")
def vocab_size_check(spark: SparkSession, folder: str) -> DataFrame:
    return k.vocab_size_check(a.character_vocabulary(spark, folder), k.VOCAB_SIZE)


_BYTE_IDS = k.Vocabulary([]).byte_ids()


@query(f"""
WITH hexed AS (SELECT doc_id, regexp_extract_all(hex(encode(text)), '..') AS h FROM documents),
coded AS (SELECT doc_id, unnest(h) AS b, unnest(range(0, len(h))) AS i FROM hexed),
ids AS (SELECT * FROM (VALUES {", ".join(f"('{b:02X}', {i})" for b, i in enumerate(_BYTE_IDS))}) t(b, id))
SELECT doc_id, count(*) AS n_tokens, string_agg(id, ',' ORDER BY i) FILTER (WHERE i < {MAX_LENGTH}) AS input_ids,
  count(*) FILTER (WHERE i < {MAX_LENGTH}) AS attended
FROM coded JOIN ids USING (b) GROUP BY doc_id
""")
def encode_bytes(spark: SparkSession, folder: str) -> DataFrame:
    """Encoding with a vocabulary of single bytes, cut to the sequence length."""
    rows = k.encode(a.texts(spark, folder), k.Vocabulary([]), MAX_LENGTH, keep=["doc_id"])
    attended = F.aggregate("attention_mask", F.lit(0).cast("bigint"), lambda s, x: s + x)
    return rows.select("doc_id", "n_tokens", a.joined_ids("input_ids").alias("input_ids"), attended.alias("attended"))


@query()
def encode_truncate(spark: SparkSession, folder: str) -> DataFrame:
    learned = a.vocabulary(spark, folder)
    rows = k.encode(a.texts(spark, folder), learned, MAX_LENGTH, keep=["doc_id"])
    return rows.select("doc_id", "n_tokens", a.joined_ids("input_ids").alias("input_ids"))


@query("SELECT doc_id, text FROM documents")
def token_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Encoding and decoding with a vocabulary that was saved and loaded again give the text back."""
    path = scratch_path(spark, "vocabulary")
    k.save_vocabulary(a.vocabulary(spark, folder), spark, path)
    learned = k.load_vocabulary(spark, path)
    rows = k.encode(a.texts(spark, folder), learned, keep=["doc_id"])
    return rows.select("doc_id", k.decode(F.col("input_ids"), learned).alias("text"))


@query(f"WITH {IDS_SQL} SELECT key, list_sum(list_transform(ids, lambda i: 1))::BIGINT AS ones, len(ids) AS n FROM ids")
def attention_mask(spark: SparkSession, folder: str) -> DataFrame:
    rows = a.token_ids(spark, folder).withColumn("mask", b.attention_mask(F.col("input_ids")))
    ones = F.aggregate("mask", F.lit(0).cast("bigint"), lambda s, x: s + x)
    return rows.select("key", ones.alias("ones"), F.size("input_ids").cast("bigint").alias("n"))


@query(f"""
WITH {FLAT},
ids AS (
  SELECT conv_id, turn,
    list_transform(string_split(prompt, ''), lambda c: unicode(c)) AS p,
    list_transform(string_split(chosen, ''), lambda c: unicode(c)) AS c,
    list_transform(string_split(rejected, ''), lambda c: unicode(c)) AS r
  FROM flat WHERE rejected IS NOT NULL
),
cut AS (SELECT conv_id, turn, p[greatest(len(p) - 64, 0) + 1:] AS p, c, r FROM ids),
sides AS (SELECT conv_id, turn, list_concat(p, c)[1:256] AS c, list_concat(p, r)[1:256] AS r FROM cut),
sized AS (SELECT *, greatest(len(c), len(r)) AS w FROM sides)
SELECT conv_id, turn,
  {joined_sql('list_concat(list_transform(range(0, w - len(c)), lambda i: 0), c)')} AS chosen_ids,
  {joined_sql('list_concat(list_transform(range(0, w - len(r)), lambda i: 0), r)')} AS rejected_ids
FROM sized
""")
def pair_caps(spark: SparkSession, folder: str) -> DataFrame:
    """Prompts keep their last 64 tokens, sequences 256; the shorter side is padded on the left."""
    from corpusloom.functions.text import code_points

    pairs = a.flat_pairs(spark, folder).where("rejected IS NOT NULL")
    ids = pairs.select("conv_id", "turn", *[code_points(F.col(s)).alias(s) for s in ("prompt", "chosen", "rejected")])
    capped = b.cap_pairs(ids, PAD, max_length=256, max_prompt_length=64)
    return capped.select(
        "conv_id",
        "turn",
        a.joined_ids("chosen_ids").alias("chosen_ids"),
        a.joined_ids("rejected_ids").alias("rejected_ids"),
    )


BATCHES_SQL = f"""{IDS_SQL},
batches AS (SELECT key, ids, (row_number() OVER (ORDER BY key) - 1) // {BATCH} AS batch_id,
  CAST((row_number() OVER (ORDER BY key) - 1) % {BATCH} AS INT) AS place FROM ids)"""


@query(f"WITH {BATCHES_SQL} SELECT key, batch_id, place FROM batches")
def batches(spark: SparkSession, folder: str) -> DataFrame:
    rows = b.fixed_batches(a.token_ids(spark, folder), BATCH, ["key"])
    return rows.select("key", "batch_id", "place")


@query(f"""
WITH {BATCHES_SQL},
sized AS (SELECT *, CAST(ceil(max(len(ids)) OVER (PARTITION BY batch_id) / 8.0) * 8 AS INT) AS width FROM batches)
SELECT key, batch_id, width,
  md5({joined_sql(f'list_concat(ids, list_transform(range(0, width - len(ids)), lambda i: {PAD}))')}) AS input_ids,
  md5({joined_sql('list_concat(list_transform(ids, lambda i: 1), list_transform(range(0, width - len(ids)), lambda i: 0))')})
    AS attention_mask,
  md5({joined_sql('list_concat(ids, list_transform(range(0, width - len(ids)), lambda i: -100))')}) AS labels
FROM sized
""")
def pad_multiple(spark: SparkSession, folder: str) -> DataFrame:
    """Padded batches; the long arrays are compared by digest."""
    rows = b.collate(b.dealt_batches(a.token_ids(spark, folder), BATCH, "key"), PAD, within=[b.RANGE])
    digests = [F.md5(a.joined_ids(c)).alias(c) for c in ("input_ids", "attention_mask", "labels")]
    return rows.select("key", "batch_id", "width", *digests)


@query(f"""
WITH {BATCHES_SQL},
sized AS (SELECT *, CAST(ceil(max(len(ids)) OVER (PARTITION BY batch_id) / 8.0) * 8 AS INT) AS width FROM batches),
padded AS (SELECT batch_id, width, key,
  {joined_sql(f'list_concat(ids, list_transform(range(0, width - len(ids)), lambda i: {PAD}))')} AS line FROM sized)
SELECT batch_id, width, md5(string_agg(line, ';' ORDER BY key)) AS input_ids FROM padded GROUP BY batch_id, width
""")
def collate_groups(spark: SparkSession, folder: str) -> DataFrame:
    """One row per batch with its padded matrix."""
    rows = b.collate_groups(b.dealt_batches(a.token_ids(spark, folder), BATCH, "key"), PAD, within=[b.RANGE])
    lines = F.transform("input_ids", lambda line: a.joined_ids(line))
    return rows.select("batch_id", "width", F.md5(F.array_join(lines, ";")).alias("input_ids"))


OFFSETS_SQL = f"""{IDS_SQL},
sizes AS (SELECT key, ids, CAST(len(ids) + 1 AS BIGINT) AS n FROM ids),
offsets AS (SELECT key, ids, CAST(sum(n) OVER (ORDER BY key) AS BIGINT) - n AS start,
  CAST(sum(n) OVER (ORDER BY key) AS BIGINT) AS stop FROM sizes)"""


@query(f"""
WITH {OFFSETS_SQL}
SELECT key, start, stop, start // {PACKED} AS first_chunk, (stop - 1) // {PACKED} AS last_chunk FROM offsets
""")
def packing_offsets(spark: SparkSession, folder: str) -> DataFrame:
    rows = b.packing_offsets(a.token_ids(spark, folder), PACKED)
    return rows.select("key", "start", "stop", "first_chunk", "last_chunk")


@query(f"""
WITH {OFFSETS_SQL},
flat AS (SELECT start + unnest(range(0, stop - start)) AS place, unnest(list_append(ids, {END})) AS id FROM offsets)
SELECT place // {PACKED} AS chunk, string_agg(id, ',' ORDER BY place) AS input_ids FROM flat GROUP BY chunk
""")
def packed_sequences(spark: SparkSession, folder: str) -> DataFrame:
    rows = b.pack(a.token_ids(spark, folder), PACKED, END)
    return rows.select("chunk", a.joined_ids("input_ids").alias("input_ids"))


@query("SELECT doc_id, length(text) AS n_points, octet_length(encode(text)) AS n_bytes FROM documents")
def batched_lengths(spark: SparkSession, folder: str) -> DataFrame:
    """A function from column batches to column batches, applied to all documents."""

    def lengths(batch: pd.DataFrame) -> pd.DataFrame:
        sizes = batch["text"].str.encode("utf-8").str.len()
        return pd.DataFrame({"doc_id": batch["doc_id"], "n_points": batch["text"].str.len(), "n_bytes": sizes})

    return b.map_batches(a.texts(spark, folder), lengths, "doc_id bigint, n_points bigint, n_bytes bigint")


# Whole stages ---------------------------------------------------------------------------------------------------------


@query(f"""
WITH {mix_sql(a.MIX_WEIGHTS, SEED)},
sized AS (SELECT source, key, position, (position - 1) // 4 AS batch_id, CAST(octet_length(encode(text)) AS BIGINT) AS n_tokens
  FROM mix)
SELECT source, key, position, batch_id, n_tokens,
  CAST(ceil(max(least(n_tokens, {MAX_LENGTH})) OVER (PARTITION BY batch_id) / 8.0) * 8 AS INT) AS width FROM sized
""")
def pretrain_stage(spark: SparkSession, folder: str) -> DataFrame:
    """From a blend: load (one source is missing), mix, encode with single bytes, batch and pad."""
    frames = a.blend_sources(spark, folder)
    blend = [Source(name, weight) for name, weight in a.MIX_WEIGHTS.items()]

    def read(source: Source) -> DataFrame:
        if source.name not in frames:
            raise ValueError(f"no source {source.name}")
        return frames[source.name]

    with warnings.catch_warnings():
        warnings.simplefilter("ignore")  # the missing source is part of the test
        rows = pretrain_from_blend(
            read, [*blend, Source("missing", 0.2)], k.Vocabulary([]), max_length=MAX_LENGTH, seed=SEED
        )
    return rows.select("source", "key", "position", "batch_id", "n_tokens", F.size("input_ids").alias("width"))


SFT_WEIGHTS = {"prompt": 0.5, "instruction": 0.3, "text": 0.2}
SFT_SOURCES = f"""{INSTRUCTIONS},
sources AS (
  SELECT 'prompt' AS source, conv_id * (SELECT max(turn) + 1 FROM conversations) + turn AS key, {EXCHANGE_TEXT} AS text FROM exchanges
  UNION ALL SELECT 'instruction', conv_id * (SELECT max(turn) + 1 FROM conversations) + turn, {INSTRUCTION_TEXT} FROM instructions
  UNION ALL SELECT 'text', doc_id, text FROM documents
)"""


@query(f"""
WITH {SFT_SOURCES}, {mix_sql(SFT_WEIGHTS, SEED, sources=None)}
SELECT source, key, text, position FROM mix
""")
def sft_stage(spark: SparkSession, folder: str) -> DataFrame:
    """Render three layouts and mix them; a run over bounded tables takes all of it."""
    turns = table(spark, folder, "conversations").agg(F.max("turn")).first()[0] or 0
    key = (F.col("conv_id") * (turns + 1) + F.col("turn")).alias("key")
    frames = {
        "prompt": a.exchanges(spark, folder).select(key, "prompt", "response"),
        "instruction": a.instructions(spark, folder).select(key, "instruction", "input", "output"),
        "text": table(spark, folder, "documents").select(F.col("doc_id").alias("key"), "text"),
    }
    return sft_dataset(frames, SFT_WEIGHTS, seed=SEED).select("source", "key", "text", "position")


@query(f"WITH {FLAT} SELECT prompt, chosen, rejected FROM flat WHERE rejected IS NOT NULL")
def preference_stage(spark: SparkSession, folder: str) -> DataFrame:
    return preference_dataset(a.flat_pairs(spark, folder))
