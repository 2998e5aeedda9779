"""Flat chat turns and the nested record layouts that renderers read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A nested record holds at most this many turns. Longer conversations continue in further records (`part` 1, 2, …), so no
# task ever gathers one unbounded conversation. Rendering is concatenation: the texts of the parts, in order, are the
# text of the conversation.
TURNS_PER_PART = 1024


def part_of(turn: str, turns_per_part: int | None = None) -> Column:
    return F.floor(F.col(turn) / F.lit(turns_per_part or TURNS_PER_PART)).cast("bigint")


def nest_turns(
    turns: DataFrame,
    column: str,
    role_field: str,
    content_field: str,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    turns_per_part: int | None = None,
) -> DataFrame:
    """Rows ``(conv, part, column ARRAY<STRUCT<role_field, content_field>>)`` from one row per turn."""
    entry = F.struct(F.col(turn).alias("at"), F.col(role).alias("r"), F.col(text).alias("c"))
    return (
        turns.select(conv, part_of(turn, turns_per_part).alias("part"), entry.alias("entry"))
        .groupBy(conv, "part")
        .agg(F.array_sort(F.collect_list("entry")).alias("entries"))
        .select(
            conv,
            "part",
            F.transform(
                "entries", lambda e: F.struct(e["r"].alias(role_field), e["c"].alias(content_field))
            ).alias(column),
        )
    )


def element_fields(df: DataFrame, column: str) -> list[str]:
    """Field names of the records inside an array column; empty when the column is no array of records."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
        return kind.elementType.fieldNames()
    return []


def first_field(turn: Column, fields: list[str], names: tuple[str, ...], default: str | None) -> Column:
    """The first of ``names`` that the records have, or the default. Absent fields are settled when the plan is built."""
    present = [turn[name].cast("string") for name in names if name in fields]
    if default is not None:
        present.append(F.lit(default))
    return F.coalesce(*present) if present else F.lit(None).cast("string")
