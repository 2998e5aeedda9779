"""From raw documents to packed training sequences: five stages, each over all that the stage before it kept.

Each stage takes ``(spark, docs, sf_dir)`` and returns a frame; all but the last return the columns of ``docs``. Rows that share a
doc_id are one document. A stage that drops documents moves ids only, unless there are too many of them to broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import leaks, line_dedup, near_dup, packing, quality_rules
from corpusloom.llm.common import landed
from corpusloom.llm.registry import table

SIMILARITY = 80  # per cent, of five-word shingles


def without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The documents whose doc_id is not among ``ids`` (one column, ``gone``)."""
    gone = landed(ids.where("gone is not null").distinct(), "gone")
    return docs.join(gone, docs["doc_id"] == gone["gone"], "left_anti")


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: what the base rule or the learned decision list rejects goes."""
    judged = quality_rules.judged(docs, table(spark, sf_dir, "labels"))
    # The verdict passes through a generator, since a filter on it would be pushed below and repeat every count's expression.
    verdict = judged.select(*docs.columns, F.explode(F.array("kept")).alias("__kept"))
    return verdict.where("__kept").select(*docs.columns)


def own_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup: lines that several documents share stay in one of them; ``n_chars`` follows the text."""
    rows = line_dedup.dedup_lines(docs)
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return rows.select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """MinHash near-dedup: of each group of near-duplicates the document of the smallest id stays."""
    found = near_dup.near_duplicates(docs, SIMILARITY)
    return without(docs, found.where("not kept").select(F.col("doc_id").alias("gone")))


def unseen_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents that hold a benchmark item go."""
    found = leaks.leaks(docs, table(spark, sf_dir, "benchmark"), SIMILARITY / 100)
    return without(docs, found.select(F.col("doc_id").alias("gone")))


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packing: all tokens of all documents, as pieces with their sequence and offset."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", good_documents),
    ("line_dedup", own_lines),
    ("near_dedup", one_of_each_group),
    ("decontamination", unseen_documents),
    ("packing", packed_sequences),
]

#: Learned rules, minwise trees and tokenizers are beyond SQL; the tests hold each stage against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result landed before the next stage reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = landed(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
