"""Queries: sources, blends and mixing, samples and shuffles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators import mixing as m
from corpusloom.operators import ordering as o
from corpusloom.operators.rendering import pick_text
from corpusloom.plans import adapters as a
from corpusloom.plans.registry import query, table
from corpusloom.session import scratch_path
from corpusloom.sources import catalogue as c
from corpusloom.sources.readers import Layout, load_report, load_sources, scan
from corpusloom.sources.sinks import land

SEED = 42
SAMPLE_ROWS = 250
WEIGHT_OVERRIDE = "0.7,0.3"

SOURCES_SQL = """
sources AS (
  SELECT lang AS source, doc_id AS key, text FROM documents
  UNION ALL SELECT 'benchmark', item_id, text FROM benchmark
)"""


def values_sql(rows: list[tuple]) -> str:
    def literal(v) -> str:
        if v is None:
            return "NULL"
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        if isinstance(v, bool):
            return str(v).lower()
        return f"{v!r}::DOUBLE" if isinstance(v, float) else repr(v)

    return "(VALUES " + ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows) + ")"


def mix_sql(weights: dict[str, float], seed: int, sources: str | None = SOURCES_SQL) -> str:
    return f"""{sources + ", " if sources else ""}weights AS (SELECT * FROM {values_sql(list(weights.items()))} w(source, weight)),
shares AS (
  SELECT source, weight / sum(weight) OVER () AS p FROM weights WHERE weight > 0
  AND source IN (SELECT source FROM sources)
),
gaps AS (
  SELECT source, key, text, CAST(round(-ln((
      ('0x' || substr(md5('{seed}:' || source || ':' || key), 1, 13))::BIGINT + 0.5) / 4503599627370496.0
    ) / p * 1048576.0) AS BIGINT) AS gap
  FROM sources JOIN shares USING (source)
),
timed AS (SELECT source, key, text, CAST(sum(gap) OVER (PARTITION BY source ORDER BY key) AS BIGINT) AS t FROM gaps),
mix AS (
  SELECT source, key, text, t, row_number() OVER (ORDER BY t, source, key) AS position FROM timed
  WHERE t <= (SELECT min(e) FROM (SELECT max(t) AS e FROM timed GROUP BY source))
)"""


def mixed(spark: SparkSession, folder: str, position: str | None = None) -> DataFrame:
    return m.interleave(a.tagged_sources(spark, folder), a.MIX_WEIGHTS, SEED, position=position)


@query("SELECT doc_id, lang, n_chars FROM documents")
def scan_source(spark: SparkSession, folder: str) -> DataFrame:
    return scan(spark, Layout(folder), c.Source("documents")).select("doc_id", "lang", "n_chars")


@query("SELECT doc_id, text, source FROM documents WHERE lang = 'de'")
def scan_split(spark: SparkSession, folder: str) -> DataFrame:
    """Documents are landed with the language as split; reading one split prunes the other directories."""
    root = scratch_path(spark, "split")
    docs = table(spark, folder, "documents").withColumnRenamed("lang", "split")
    land(docs, f"{root}/documents", partition_by="split")
    return scan(spark, Layout(root), c.Source("documents", split="de")).select("doc_id", "text", "source")


@query("""
SELECT lang AS source, doc_id AS key, text FROM documents UNION ALL SELECT 'benchmark', item_id, text FROM benchmark
""")
def land_sources(spark: SparkSession, folder: str) -> DataFrame:
    """The prepared blend, landed with one directory per source and read back."""
    path = scratch_path(spark, "landed")
    land(a.tagged_sources(spark, folder), path, partition_by="source")
    return spark.read.parquet(path).select("source", "key", "text")


# Fixed values, written out a second time so that the comparison does not lean on the catalogue itself.
CATALOGUE_SQL = """
(VALUES (0, 'pretrain', 'cc_v2.1', 'nvidia/Nemotron-CC-v2.1'),
  (1, 'pretrain', 'cc_v2', 'nvidia/Nemotron-CC-v2'),
  (2, 'pretrain', 'code_v2', 'nvidia/Nemotron-Pretraining-Code-v2'),
  (3, 'pretrain', 'code_v1', 'nvidia/Nemotron-Pretraining-Code-v1'),
  (4, 'pretrain', 'cc_code_v1', 'nvidia/Nemotron-CC-Code-v1'),
  (5, 'pretrain', 'math_v1', 'nvidia/Nemotron-CC-Math-v1'),
  (6, 'pretrain', 'specialized_v1', 'nvidia/Nemotron-Pretraining-Specialized-v1'),
  (7, 'pretrain', 'sft_v1', 'nvidia/Nemotron-Pretraining-SFT-v1'),
  (8, 'pretrain', 'sample', 'nvidia/Nemotron-Pretraining-Dataset-sample'),
  (9, 'posttrain', 'instruction_chat', 'nvidia/Nemotron-Instruction-Following-Chat-v1'),
  (10, 'posttrain', 'math_v2', 'nvidia/Nemotron-Math-v2'),
  (11, 'posttrain', 'math_proofs', 'nvidia/Nemotron-Math-Proofs-v1'),
  (12, 'posttrain', 'science', 'nvidia/Nemotron-Science-v1'),
  (13, 'posttrain', 'agentic', 'nvidia/Nemotron-Agentic-v1'),
  (14, 'posttrain', 'competitive_programming', 'nvidia/Nemotron-Competitive-Programming-v1'),
  (15, 'posttrain', 'rl_blend', 'nvidia/Nemotron-3-Nano-RL-Training-Blend')) t(i, stage, key, name)"""


@query(f"""
SELECT stage, key, name, count(*) AS n FROM documents JOIN {CATALOGUE_SQL} ON i = doc_id % 16 GROUP BY ALL
""")
def catalogue_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """Documents carry a logical key each; their catalogue names are looked up."""
    names = [*c.PRETRAIN_SOURCES, *c.POSTTRAIN_SOURCES]
    keys = F.array(*[F.lit(k) for k in names])
    docs = table(spark, folder, "documents").select(F.get(keys, (F.col("doc_id") % len(names)).cast("int")).alias("key"))
    per_key = docs.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    return c.catalogue(spark).join(per_key, "key").select("stage", "key", "name", "n")


# The default weights 0.5, 0.2, 0.15, 0.1, 0.05 with the first two overridden.
@query(f"""
WITH {SOURCES_SQL}, counts AS (SELECT source, count(*) AS n FROM sources GROUP BY source)
SELECT name, config_name, weight, round(weight / sum(weight) OVER (), 9) AS probability, n
FROM (VALUES ('nvidia/Nemotron-CC-v2.1', NULL, 0.7::DOUBLE, 'en'),
  ('nvidia/Nemotron-Pretraining-Code-v2', NULL, 0.3::DOUBLE, 'de'),
  ('nvidia/Nemotron-CC-Math-v1', NULL, 0.15::DOUBLE, 'fr'),
  ('nvidia/Nemotron-Pretraining-Specialized-v1', 'Nemotron-Pretraining-Wiki-Rewrite', 0.1::DOUBLE, 'es'),
  ('nvidia/Nemotron-CC-Code-v1', NULL, 0.05::DOUBLE, 'benchmark')) t(name, config_name, weight, source) JOIN counts USING (source)
""")
def blend_weights(spark: SparkSession, folder: str) -> DataFrame:
    """Default blend with two weights overridden, renormalised over the sources that have rows."""
    whole = a.tagged_sources(spark, folder).where(F.col("source").isin(list(a.MIX_WEIGHTS))).groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    rows = {r["source"]: r["n"] for r in whole.collect()}
    blend = dict(zip(a.MIX_WEIGHTS, c.pretrain_blend(weights=WEIGHT_OVERRIDE), strict=True))
    shares = m.normalised({s: blend[s].weight for s in rows})
    listed = spark.createDataFrame(
        [(s, round(p, 9), rows[s]) for s, p in shares.items()], "source string, probability double, n bigint"
    )
    names = c.blend_frame(spark, list(blend.values()))
    keyed = spark.createDataFrame([(s, b.name) for s, b in blend.items()], "source string, name string")
    return names.join(keyed, "name").join(listed, "source").select("name", "config_name", "weight", "probability", "n")


SUBSETS = ("all", "math", "code", "science", "chat", "agentic")
SFT_NAMES = [s.name for s in c.sft_blend()]


# Fixed values. A name that is no subset, such as agentic, stands for all sources.
@query("""
WITH blend AS (SELECT * FROM (VALUES
  (0, 'chat', 'nvidia/Nemotron-Instruction-Following-Chat-v1', 'chat_if', 0.3::DOUBLE, true),
  (1, 'math', 'nvidia/Nemotron-Math-v2', 'train', 0.25::DOUBLE, true),
  (2, 'math_proofs', 'nvidia/Nemotron-Math-Proofs-v1', 'train', 0.15::DOUBLE, true),
  (3, 'science', 'nvidia/Nemotron-Science-v1', 'train', 0.15::DOUBLE, true),
  (4, 'agentic', 'nvidia/Nemotron-Agentic-v1', 'train', 0.1::DOUBLE, false),
  (5, 'code', 'nvidia/Nemotron-Competitive-Programming-v1', 'train', 0.05::DOUBLE, false)) t(i, part, name, split, weight, streaming)),
subsets AS (
  SELECT subset, part FROM blend, (VALUES ('all'), ('agentic')) a(subset)
  UNION ALL SELECT * FROM (VALUES ('math', 'math'), ('math', 'math_proofs'), ('code', 'code'), ('science', 'science'), ('chat', 'chat')) b(subset, part)
)
SELECT subset, name, split, weight, streaming, count(*) AS n
FROM documents JOIN blend ON i = CAST(substr(source, 4) AS INT) % 6 JOIN subsets USING (part) GROUP BY ALL
""")
def blend_sft_subset(spark: SparkSession, folder: str) -> DataFrame:
    """The sources of every fine-tuning subset, with the number of documents that belong to each."""
    names = F.array(*[F.lit(n) for n in SFT_NAMES])
    number = F.expr("cast(substring(source, 4) as int)") % len(SFT_NAMES)
    per_name = table(spark, folder, "documents").groupBy(F.get(names, number).alias("name")).agg(
        F.count(F.lit(1)).alias("n")
    )
    blends = [
        c.blend_frame(spark, c.sft_blend(subset=subset)).withColumn("subset", F.lit(subset)) for subset in SUBSETS
    ]
    return reduce(DataFrame.unionByName, blends).join(per_name, "name").select(
        "subset", "name", "split", "weight", "streaming", "n"
    )


@query("""
SELECT 'documents' AS name, 'documents' AS loaded_from, 0.6::DOUBLE AS weight, true AS loaded, (SELECT count(*) FROM documents) AS n
UNION ALL SELECT 'restricted', 'conversations', 0.3::DOUBLE, true, (SELECT count(*) FROM conversations)
UNION ALL SELECT 'missing', NULL, 0.1::DOUBLE, false, 0
""")
def load_fallbacks(spark: SparkSession, folder: str) -> DataFrame:
    """One source loads, one is replaced by its fallback, one is skipped."""
    sources = [
        c.Source("documents", 0.6),
        c.Source("restricted", 0.3, config_name="gated", fallback_name="conversations"),
        c.Source("missing", 0.1),
    ]
    report = load_sources(lambda s: scan(spark, Layout(folder), s), sources)
    counts = [
        e.frame.agg(F.count(F.lit(1)).alias("n")).withColumn("name", F.lit(e.source.name))
        for e in report
        if e.frame is not None
    ]
    return load_report(spark, report).join(reduce(DataFrame.unionByName, counts), "name", "left").withColumn(
        "n", F.coalesce("n", F.lit(0))
    )


@query("SELECT doc_id, text FROM documents")
def text_pick(spark: SparkSession, folder: str) -> DataFrame:
    """One source per language, each with its text under another name."""
    docs = table(spark, folder, "documents")
    names = {"en": "content", "de": "text", "fr": "code"}
    frames = [
        pick_text(docs.where(F.col("lang") == lang).select("doc_id", F.col("text").alias(name), "lang"), keep=["doc_id"])
        for lang, name in names.items()
    ]
    others = docs.where(F.col("lang").isNull() | ~F.col("lang").isin(list(names))).select("doc_id", F.col("text").alias("input"), "lang")
    return reduce(DataFrame.unionByName, [*frames, pick_text(others, keep=["doc_id"])])


@query("SELECT lang, count(*) AS n, (SELECT count(*) FROM documents) AS total FROM documents GROUP BY lang")
def row_count(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return docs.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).withColumn("total", F.lit(docs.count()))


@query(f"SELECT doc_id, text FROM documents ORDER BY doc_id LIMIT {SAMPLE_ROWS}")
def first_n_sample(spark: SparkSession, folder: str) -> DataFrame:
    return o.first_n(table(spark, folder, "documents").select("doc_id", "text"), SAMPLE_ROWS, "doc_id")


@query(f"SELECT doc_id, text, row_number() OVER (ORDER BY md5('{SEED}:' || doc_id), doc_id) AS position FROM documents")
def seeded_shuffle(spark: SparkSession, folder: str) -> DataFrame:
    return o.seeded_shuffle(table(spark, folder, "documents").select("doc_id", "text"), "doc_id", SEED)


@query(f"WITH {mix_sql(a.MIX_WEIGHTS, SEED)} SELECT source, key, text, t FROM mix")
def blend_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixed(spark, folder)


@query(f"WITH {mix_sql(a.MIX_WEIGHTS, SEED)} SELECT source, key, position FROM mix")
def blend_order(spark: SparkSession, folder: str) -> DataFrame:
    return mixed(spark, folder, position="position").select("source", "key", "position")


@query(f"WITH {mix_sql({'en': 1.0}, SEED)} SELECT source, key, text, t FROM mix")
def single_source(spark: SparkSession, folder: str) -> DataFrame:
    return m.interleave(m.union_sources({"en": a.blend_sources(spark, folder)["en"]}), {"en": 1.0}, SEED)


@query(f"WITH {mix_sql(a.MIX_WEIGHTS, SEED)} SELECT source, key, text, position FROM mix WHERE position <= 10 * 2 * 4 * 2")
def row_budget(spark: SparkSession, folder: str) -> DataFrame:
    """The rows that a run of ten steps consumes."""
    rows = mixed(spark, folder, position="position").select("source", "key", "text", "position")
    return m.row_budget(rows, max_steps=10, per_device_batch=2, accumulation=4, replicas=2)
