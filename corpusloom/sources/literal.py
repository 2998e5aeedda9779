"""Built-in preference pairs for runs whose preference source cannot be read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Prompt, chosen and rejected answer of the built-in pairs.
TEMPLATES = (
    ("What is 2 + 2?", "2 + 2 equals 4.", "I don't know."),
    (
        "Explain quantum computing.",
        "Quantum computing uses quantum mechanical phenomena like superposition and entanglement to process information "
        "in ways classical computers cannot.",
        "It's complicated.",
    ),
    (
        "Write a haiku about coding.",
        "Lines of code flow down\nBugs hide in the logic maze\nDebugger awaits",
        "Poetry is hard.",
    ),
)
REPEATS = 100


def with_templates(rows: DataFrame, number: Column) -> DataFrame:
    """Give every row the built-in pair ``number mod 3``."""
    sides = F.array(*[F.struct(*[F.lit(t).alias(n) for t, n in zip(row, SIDES, strict=True)]) for row in TEMPLATES])
    return rows.withColumn("__pair", F.get(sides, F.pmod(number, F.lit(len(TEMPLATES))).cast("int"))).select(
        *rows.columns, "__pair.*"
    )


SIDES = ("prompt", "chosen", "rejected")


def fallback_pairs(spark: SparkSession) -> DataFrame:
    """The 300 built-in pairs."""
    return with_templates(spark.range(len(TEMPLATES) * REPEATS), F.col("id")).drop("id")
