"""Preference pairs: prompt, chosen and rejected answer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.text import joined, marked_turn, or_empty
from corpusloom.functions.turns import element_fields, first_field
from corpusloom.operators.rendering import ASSISTANT_ROLES

# Roles whose turns make up the context of a nested pair.
CONTEXT_ROLES = ("user", "human", "system")

SIDES = ("prompt", "chosen", "rejected")


def resolve_prompt(df: DataFrame) -> Column:
    """``prompt``; without it ``question`` (after the system text, if any); without both an empty text."""
    if "prompt" in df.columns:
        return F.col("prompt")
    if "question" in df.columns:
        question = F.col("question")
        if "system" in df.columns:
            led = F.concat(F.col("system"), F.lit("\n\n"), or_empty(question))
            return F.when(F.length("system") > 0, led).otherwise(question)
        return question
    return F.lit("")


def assistant_text(df: DataFrame, column: str) -> Column:
    """Contents of all assistant turns, joined without a separator. A plain string is already the answer."""
    if isinstance(df.schema[column].dataType, T.StringType):
        return F.col(column)
    fields = element_fields(df, column)
    spoken = F.filter(column, lambda t: first_field(t, fields, ("role", "from"), "assistant").isin(*ASSISTANT_ROLES))
    return joined(F.transform(spoken, lambda t: first_field(t, fields, ("content", "value"), "")))


def context_text(df: DataFrame, column: str) -> Column:
    """User and system turns as marked text, roles as they are. A plain string has no context."""
    if isinstance(df.schema[column].dataType, T.StringType):
        return F.lit("")
    fields = element_fields(df, column)

    def role(turn: Column) -> Column:
        return first_field(turn, fields, ("role", "from"), "user")

    asked = F.filter(column, lambda t: role(t).isin(*CONTEXT_ROLES))
    return joined(F.transform(asked, lambda t: marked_turn(role(t), first_field(t, fields, ("content", "value"), ""))))


def preferred(df: DataFrame) -> tuple[Column, Column]:
    """Chosen and rejected side of an A/B record: A only for preference 1, B for anything else. No column means A."""
    if "preference" not in df.columns:
        return F.col("response_a"), F.col("response_b")
    a_wins = F.col("preference") == 1
    return (
        F.when(a_wins, F.col("response_a")).otherwise(F.col("response_b")),
        F.when(a_wins, F.col("response_b")).otherwise(F.col("response_a")),
    )


def pair_columns(df: DataFrame) -> list[Column]:
    """The three sides by the layout of the frame."""
    names = df.columns
    if "chosen" in names and "rejected" in names:
        if isinstance(df.schema["chosen"].dataType, T.ArrayType):
            sides = context_text(df, "chosen"), assistant_text(df, "chosen"), assistant_text(df, "rejected")
        else:
            sides = resolve_prompt(df), F.col("chosen"), F.col("rejected")
    elif "response_a" in names and "response_b" in names:
        if "prompt" not in names:
            raise ValueError("A/B records need a prompt column")
        sides = F.col("prompt"), *preferred(df)
    else:
        raise ValueError(f"no preference layout among {names}")
    return [side.alias(name) for side, name in zip(sides, SIDES, strict=True)]


def all_filled(columns: Sequence[str] = SIDES) -> Column:
    """Whether every side has at least one character; NULL counts as empty."""
    test = F.lit(True)
    for c in columns:
        test = test & F.coalesce(F.length(c) > 0, F.lit(False))
    return test


def nonempty(df: DataFrame, columns: Sequence[str] = SIDES) -> DataFrame:
    """Rows without an empty side."""
    return df.where(all_filled(columns))


def build_pairs(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Prepared pairs: three text sides, rows with an empty side left out. One narrow stage, no shuffle."""
    return nonempty(df.select(*keep, *pair_columns(df)))


def load_pairs(df: DataFrame) -> DataFrame:
    """The lighter form of the loader: other columns stay, nothing is filtered, chat is not unpacked."""
    names = df.columns
    if "chosen" in names and "rejected" in names:
        return df if "prompt" in names else df.withColumn("prompt", F.lit(""))
    if "prompt" in names and "response_a" in names:
        chosen, rejected = preferred(df)
        return df.withColumns({"chosen": chosen, "rejected": rejected})
    raise ValueError(f"no preference layout among {names}")


def nonempty_by(df: DataFrame, key: str, columns: Sequence[str] = SIDES) -> DataFrame:
    """As ``nonempty`` for pairs stored in several parts: a side counts as empty when all its parts are."""
    filled = df.groupBy(key).agg(*[F.max(F.length(c)).alias(c) for c in columns])
    kept = filled.where(" AND ".join(f"`{c}` > 0" for c in columns)).select(key)
    return df.join(kept, key, "left_semi")
