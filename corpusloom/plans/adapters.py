"""The record layouts of the operators, derived from the test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.text import code_points
from corpusloom.functions.turns import nest_turns
from corpusloom.operators.tokens import Vocabulary, train_vocabulary
from corpusloom.plans.registry import table
from corpusloom.session import spread

MIX_WEIGHTS = {"en": 0.5, "de": 0.2, "fr": 0.15, "es": 0.1, "benchmark": 0.05}
# Look-ahead is left out on both sides of a comparison, since the SQL engine has none.
SIMPLE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+"

_VOCABULARIES: dict[tuple[str, str], Vocabulary] = {}


def renamed_roles(turns: DataFrame, names: dict[str, str]) -> DataFrame:
    role = F.col("role")
    for old, new in names.items():
        role = F.when(F.col("role") == old, F.lit(new)).otherwise(role)
    return turns.withColumn("role", role)


def sharegpt(spark: SparkSession, folder: str, user: str = "human", assistant: str = "gpt") -> DataFrame:
    turns = renamed_roles(table(spark, folder, "conversations"), {"user": user, "assistant": assistant})
    return nest_turns(turns, "conversations", "from", "value")


def messages(spark: SparkSession, folder: str) -> DataFrame:
    return nest_turns(table(spark, folder, "conversations"), "messages", "role", "content")


def exchanges(spark: SparkSession, folder: str) -> DataFrame:
    """User turns and the assistant turns that follow them directly. (conv_id, turn) is unique, so no key is hot.

    A window over a conversation would need one scan less, but would gather a hot conversation in one task.
    """
    turns = table(spark, folder, "conversations")
    asked = turns.where("role = 'user'").select("conv_id", "turn", F.col("text").alias("prompt"))
    answers = turns.where("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("response")
    )
    return asked.join(answers, ["conv_id", "turn"])


def instructions(spark: SparkSession, folder: str) -> DataFrame:
    """Exchanges with the first system text of the conversation as input, or an empty one."""
    pairs = exchanges(spark, folder).select(
        "conv_id", "turn", F.col("prompt").alias("instruction"), F.col("response").alias("output")
    )
    return pairs.join(system_texts(spark, folder), "conv_id", "left").withColumn(
        "input", F.coalesce("system", F.lit(""))
    ).drop("system")


def system_texts(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations").where("role = 'system'")
    return turns.groupBy("conv_id").agg(F.min_by("text", "turn").alias("system"))


def flat_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Exchanges; the rejected answer is the one at the same place of the next conversation, if there is one."""
    pairs = exchanges(spark, folder)
    others = pairs.select((F.col("conv_id") - 1).alias("conv_id"), "turn", F.col("response").alias("rejected"))
    return pairs.withColumnRenamed("response", "chosen").join(others, ["conv_id", "turn"], "left")


def nested_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Conversations as chosen side, the next ones as rejected side."""
    chats = messages(spark, folder)
    others = chats.select((F.col("conv_id") - 1).alias("conv_id"), "part", F.col("messages").alias("rejected"))
    return chats.withColumnRenamed("messages", "chosen").join(others, ["conv_id", "part"], "full")


def ab_records(spark: SparkSession, folder: str) -> DataFrame:
    """Each document against the next one; its quality label, if any, is the preference."""
    docs = table(spark, folder, "documents")
    following = docs.select((F.col("doc_id") - 1).alias("doc_id"), F.col("text").alias("response_b"))
    labels = table(spark, folder, "labels").select("doc_id", F.col("quality").alias("preference"))
    return (
        docs.select("doc_id", F.col("source").alias("prompt"), F.col("text").alias("response_a"))
        .join(following, "doc_id", "left")
        .join(labels, "doc_id", "left")
    )


def tagged_sources(spark: SparkSession, folder: str) -> DataFrame:
    """All documents with their language as source, whatever it is, and the benchmark: each table is scanned once."""
    docs = table(spark, folder, "documents").select(F.col("lang").alias("source"), F.col("doc_id").alias("key"), "text")
    bench = table(spark, folder, "benchmark").select(F.lit("benchmark").alias("source"), F.col("item_id").alias("key"), "text")
    return docs.unionByName(bench)


def blend_sources(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    docs = table(spark, folder, "documents")
    frames = {
        lang: docs.where(F.col("lang") == lang).select(F.col("doc_id").alias("key"), "text")
        for lang in ("en", "de", "fr", "es")
    }
    frames["benchmark"] = table(spark, folder, "benchmark").select(F.col("item_id").alias("key"), "text")
    return frames


def metrics(spark: SparkSession, folder: str) -> DataFrame:
    return metric_rows(table(spark, folder, "events"))


def metric_rows(events: DataFrame) -> DataFrame:
    return events.select(
        (F.col("event_id") + 1).alias("step"), F.col("event_type").alias("key"), "value"
    )


def tensors(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "embeddings").select(
        F.concat(F.lit("layers."), F.col("label").cast("string")).alias("name"), F.col("embedding").alias("values")
    )


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").cast("string").alias("name"),
        F.when(F.col("label") % 5 == 0, F.lit("buffer")).otherwise(F.lit("parameter")).alias("kind"),
        F.size("embedding").cast("bigint").alias("numel"),
        F.lit(4).alias("element_size"),
        (F.col("label") % 2 == 0).alias("requires_grad"),
    )


def checkpoints(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        F.col("user_id").alias("run"),
        F.concat(F.lit("checkpoint-"), F.col("event_id").cast("string")).alias("path"),
        F.col("value").alias("loss"),
    )


def run_plans(spark: SparkSession, folder: str) -> DataFrame:
    """One run per document source, with as many samples as the source has characters."""
    return (
        table(spark, folder, "documents")
        .groupBy("source")
        .agg(F.sum("n_chars").alias("num_samples"), F.count(F.lit(1)).alias("epochs"))
        .withColumns({"batch_size": F.lit(4), "accumulation": F.lit(8), "sec_per_step": F.lit(0.5)})
    )


def texts(spark: SparkSession, folder: str) -> DataFrame:
    """Documents for work that is heavy per row."""
    return spread(table(spark, folder, "documents").select("doc_id", "text"))


def token_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Code points of whole documents, as token ids that SQL can compute too."""
    return texts(spark, folder).select(
        F.col("doc_id").alias("key"), code_points(F.col("text")).alias("input_ids")
    )


def vocabulary(spark: SparkSession, folder: str) -> Vocabulary:
    """A vocabulary trained on all documents, once per session and set of files."""
    files = table(spark, folder, "documents").inputFiles()
    at = (spark.sparkContext.applicationId, "\n".join(sorted(files)))
    if at not in _VOCABULARIES:
        _VOCABULARIES[at] = train_vocabulary(texts(spark, folder))
    return _VOCABULARIES[at]


def character_vocabulary(spark: SparkSession, folder: str) -> DataFrame:
    """The characters of all documents as tokens. The alphabet is bounded, so numbering it in one task is fine."""
    from pyspark.sql.window import Window

    chars = texts(spark, folder).select(F.explode(F.array_distinct(F.split("text", ""))).alias("token"))
    distinct = chars.where("token <> ''").groupBy("token").agg(F.count(F.lit(1)).alias("n")).drop("n")
    return distinct.withColumn(
        "id", F.row_number().over(Window.orderBy(F.ascii("token"))).cast("bigint") - 1
    ).withColumn("special", F.lit(False))


def joined_ids(ids: Column | str) -> Column:
    """Token ids, none of which is NULL, with commas between them; there is no string object for each."""
    listed = F.to_json(F.col(ids) if isinstance(ids, str) else ids)
    return F.substring(F.substring_index(listed, "]", 1), 2, 2**31 - 1)
