"""Rendering of chat, instruction and plain records to one training text.

All rules are column expressions. Which layout a frame has is read from its schema when the plan is built, once per
source, so no row is inspected and no Python runs per row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.python_form import python_form
from corpusloom.functions.text import (
    ASSISTANT_OPEN,
    END,
    joined,
    marked_turn,
    or_empty,
    plain_turn,
    strip,
    tag,
)
from corpusloom.functions.turns import element_fields, first_field, part_of

# Column names that hold raw text, in order of preference.
TEXT_COLUMNS = ("content", "text", "code", "input")

# Role names of the two speakers.
USER_ROLES = ("user", "human")
ASSISTANT_ROLES = ("assistant", "gpt", "bot")


# Plain records ------------------------------------------------------------------------------------------------------


def pick_text(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The text column of a raw source: the first of ``content, text, code, input`` that it has."""
    name = next((c for c in TEXT_COLUMNS if c in df.columns), None)
    if name is None:
        raise ValueError(f"no text column among {df.columns}")
    return df.select(*keep, F.col(name).alias("text"))


# Layout rules without end markers -----------------------------------------------------------------------------------


def sharegpt_text(df: DataFrame, column: str = "conversations") -> Column:
    return _plain_turns(df, column, "from", "value")


def messages_text(df: DataFrame, column: str = "messages") -> Column:
    return _plain_turns(df, column, "role", "content")


def _plain_turns(df: DataFrame, column: str, role: str, content: str) -> Column:
    fields = element_fields(df, column)

    def turn(t: Column) -> Column:
        return plain_turn(F.lower(first_field(t, fields, (role,), "user")), first_field(t, fields, (content,), ""))

    return joined(F.transform(column, turn))


def prompt_response_text() -> Column:
    return F.concat(plain_turn("user", F.col("prompt")), plain_turn("assistant", F.col("response")))


def instruction_text(df: DataFrame) -> Column:
    extra = or_empty(F.col("input")) if "input" in df.columns else F.lit("")
    prompt = strip(F.concat(or_empty(F.col("instruction")), F.lit("\n"), extra))
    return F.concat(plain_turn("user", prompt), plain_turn("assistant", F.col("output")))


def unknown_text(df: DataFrame, columns: Sequence[str]) -> Column:
    """A record of no known layout, written as a Python dictionary."""
    record = T.StructType([df.schema[c] for c in columns])
    return python_form(F.struct(*[df[c] for c in columns]), record)


def chat_text(df: DataFrame, ignore: Sequence[str] = ()) -> Column:
    """Text of a record by the first layout that its columns fit."""
    names = [c for c in df.columns if c not in ignore]
    if "conversations" in names:
        return sharegpt_text(df)
    if "messages" in names:
        return messages_text(df)
    if "prompt" in names and "response" in names:
        return prompt_response_text()
    if "instruction" in names and "output" in names:
        return instruction_text(df)
    if "text" in names:
        return F.col("text")
    return unknown_text(df, names)


def render_chat(df: DataFrame, keep: Sequence[str] = (), renderer: str = "plain") -> DataFrame:
    """Replace all columns by ``text``; ``keep`` names key columns that pass through and are no part of the record."""
    rule = {"plain": chat_text, "marked": marked_text}[renderer]
    return df.select(*keep, rule(df, ignore=keep).alias("text"))


# Layout rules with end markers --------------------------------------------------------------------------------------


def marked_conversation_text(df: DataFrame, column: str = "conversations") -> Column:
    """Role aliases are mapped to user, assistant and system; turns of other roles are left out."""
    fields = element_fields(df, column)

    def speaker(turn: Column) -> Column:
        role = first_field(turn, fields, ("role", "from"), "user")
        return (
            F.when(role.isin(*USER_ROLES), F.lit("user"))
            .when(role.isin(*ASSISTANT_ROLES), F.lit("assistant"))
            .when(role == "system", F.lit("system"))
        )

    known = F.filter(column, lambda t: speaker(t).isNotNull())
    return joined(
        F.transform(known, lambda t: marked_turn(speaker(t), first_field(t, fields, ("content", "value"), "")))
    )


def marked_messages_text(df: DataFrame, column: str = "messages") -> Column:
    """Roles are kept as they are."""
    fields = element_fields(df, column)
    return joined(
        F.transform(
            column,
            lambda t: marked_turn(first_field(t, fields, ("role",), "user"), first_field(t, fields, ("content",), "")),
        )
    )


def marked_exchange(prompt: Column, response: Column) -> Column:
    return F.concat(marked_turn("user", prompt), tag("assistant"), or_empty(response), F.lit(END))


def marked_instruction_text(df: DataFrame) -> Column:
    answer = next((F.col(c) for c in ("output", "response") if c in df.columns), F.lit(""))
    prompt = or_empty(F.col("instruction"))
    if "input" in df.columns:
        extra = F.concat(prompt, F.lit("\n\nInput: "), F.col("input"))
        prompt = F.when(F.length("input") > 0, extra).otherwise(prompt)
    return marked_exchange(prompt, answer)


def first_long_text(df: DataFrame, columns: Sequence[str], minimum: int = 10) -> Column:
    """The first string column, in column order, with more than ``minimum`` characters; an error if there is none."""
    texts = [c for c in columns if isinstance(df.schema[c].dataType, T.StringType)]
    failure = F.raise_error(F.lit(f"no text field among {list(columns)}")).cast("string")
    return F.coalesce(*[F.when(F.length(c) > minimum, F.col(c)) for c in texts], failure)


def marked_text(df: DataFrame, ignore: Sequence[str] = ()) -> Column:
    names = [c for c in df.columns if c not in ignore]
    if "conversations" in names:
        return marked_conversation_text(df)
    if "messages" in names:
        return marked_messages_text(df)
    if "prompt" in names and "response" in names:
        return marked_exchange(F.col("prompt"), F.col("response"))
    if "instruction" in names:
        return marked_instruction_text(df)
    if "text" in names:
        return F.col("text")
    return first_long_text(df, names)


# Generation prompts -------------------------------------------------------------------------------------------------


def template_text(df: DataFrame, column: str = "messages", generation_prompt: bool | Column = False) -> Column:
    """Chat template: only system, user and assistant turns, optionally followed by an opened assistant turn."""
    known = F.filter(column, lambda t: t["role"].isin("system", "user", "assistant"))
    text = joined(F.transform(known, lambda t: marked_turn(t["role"], t["content"])))
    flag = F.lit(generation_prompt) if isinstance(generation_prompt, bool) else generation_prompt
    return F.concat(text, F.when(flag, F.lit(ASSISTANT_OPEN)).otherwise(F.lit("")))


def single_prompt(prompt: Column) -> Column:
    return F.concat(marked_turn("user", prompt), F.lit(ASSISTANT_OPEN))


def history_prompts(
    turns: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    turns_per_part: int | None = None,
) -> DataFrame:
    """For every user turn the prompt that holds all turns so far: rows ``(conv, turn, part, prompt)``.

    Turns are rendered once per conversation part, and each prompt is a cut of that text, so the turns of one
    conversation are never paired with each other. The prompt of a turn in part ``p`` has one row for each part up to
    ``p``; conversations of ordinary length have part 0 only.
    """
    user = F.col(role) == "user"
    piece = marked_turn(F.when(user, F.lit("user")).otherwise(F.lit("assistant")), F.col(text))
    entry = F.struct(F.col(turn).alias("at"), user.alias("user"), piece.alias("piece"))
    parts = (
        turns.select(conv, part_of(turn, turns_per_part).alias("part"), entry.alias("entry"))
        .groupBy(conv, "part")
        .agg(F.array_sort(F.collect_list("entry")).alias("entries"))
        .withColumn("whole", joined(F.transform("entries", lambda e: e["piece"])))
    )
    ends = F.aggregate(
        "entries",
        F.struct(F.lit(0).alias("sum"), F.array().cast("array<struct<at:bigint,user:boolean,end:int>>").alias("ends")),
        lambda acc, e: F.struct(
            (acc["sum"] + F.length(e["piece"])).alias("sum"),
            F.array_append(
                acc["ends"],
                F.struct(
                    e["at"].cast("bigint").alias("at"),
                    e["user"].alias("user"),
                    (acc["sum"] + F.length(e["piece"])).alias("end"),
                ),
            ).alias("ends"),
        ),
        lambda acc: F.filter(acc["ends"], lambda e: e["user"]),
    )
    asked = parts.select(conv, "part", "whole", F.explode(ends).alias("e"))
    own = asked.select(
        conv,
        F.col("e.at").alias(turn),
        "part",
        F.concat(F.expr("substring(whole, 1, e.end)"), F.lit(ASSISTANT_OPEN)).alias("prompt"),
    )
    later = asked.where(F.col("part") > 0).select(conv, F.col("e.at").alias(turn), F.col("part").alias("last"))
    earlier = parts.select(conv, "part", F.col("whole").alias("prompt")).join(later, conv).where("part < last")
    return own.unionByName(earlier.select(conv, turn, "part", "prompt"))


def completion_text(full: Column, prompt: Column) -> Column:
    """What follows the prompt's characters, without surrounding whitespace."""
    return strip(F.substring(full, F.length(prompt) + 1, F.length(full)))


def completion_ids(full: Column, prompt: Column) -> Column:
    """What follows the prompt's tokens."""
    return F.slice(full, F.size(prompt) + 1, F.greatest(F.size(full) - F.size(prompt), F.lit(0)))
