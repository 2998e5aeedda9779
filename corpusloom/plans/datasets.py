"""The data side of the three training stages, from source frames to prepared frames.

Each function only composes operators; nothing runs before the result is written (apart from the small aggregates that
place the cut points of the mix). Source frames carry a numeric order key, see ``sources.readers.with_order_key``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.operators.batching import cap_pairs, collate, pack
from corpusloom.operators.mixing import interleave, row_budget, union_sources
from corpusloom.operators.preference import SIDES, build_pairs, nonempty_by, pair_columns
from corpusloom.operators.rendering import pick_text, render_chat
from corpusloom.operators.tokens import Vocabulary, encode
from corpusloom.sources.catalogue import Source
from corpusloom.sources.literal import fallback_pairs
from corpusloom.sources.readers import load_sources, with_order_key

PAD_ID = 0
END_ID = 2


def pretrain_dataset(
    frames: Mapping[str, DataFrame],
    weights: Mapping[str, float],
    vocabulary: Vocabulary,
    max_length: int = 2048,
    batch_size: int = 4,
    seed: int = 42,
    key: str = "key",
    packed: bool = False,
) -> DataFrame:
    """Text pick per source, weighted mix, encoding, then padded batches or packed sequences in mix order."""
    picked = {name: pick_text(df, keep=[key]) for name, df in frames.items()}
    mixed = interleave(union_sources(picked), weights, seed, key=key, position="position")
    coded = encode(mixed, vocabulary, None if packed else max_length, keep=["position", "source", key])
    if packed:
        return pack(coded, max_length, END_ID, key="position")
    # Positions are row numbers already, so batches are plain arithmetic and nothing is numbered again.
    batched = coded.withColumn("batch_id", F.floor((F.col("position") - 1) / batch_size))
    return collate(batched, PAD_ID)


def sft_dataset(
    frames: Mapping[str, DataFrame],
    weights: Mapping[str, float],
    renderer: str = "plain",
    max_steps: int = -1,
    per_device_batch: int = 4,
    accumulation: int = 8,
    replicas: int = 1,
    unbounded: bool = False,
    seed: int = 42,
    key: str = "key",
    vocabulary: Vocabulary | None = None,
    max_length: int = 2048,
) -> DataFrame:
    """Rendering per source by its own layout, weighted mix, and the rows that the run will consume.

    With a vocabulary the texts are encoded, laid end to end in mix order and cut into sequences of ``max_length``.
    """
    rendered = {name: render_chat(df, keep=[key], renderer=renderer) for name, df in frames.items()}
    mixed = interleave(union_sources(rendered), weights, seed, key=key, position="position")
    rows = row_budget(mixed, max_steps, per_device_batch, accumulation, replicas, unbounded)
    if vocabulary is None:
        return rows
    return pack(encode(rows, vocabulary, keep=["position"]), max_length, END_ID, key="position")


def loaded_blend(read: Callable[[Source], DataFrame], blend: list[Source]) -> tuple[dict[str, DataFrame], dict[str, float]]:
    """Frames and weights of the sources of a blend that can be opened, each by itself or its fallback.

    Frames without a ``key`` get one in file order, so they must be plain parquet scans.
    """
    entries = [e for e in load_sources(read, blend) if e.frame is not None]
    frames = {e.source.name: e.frame if "key" in e.frame.columns else with_order_key(e.frame) for e in entries}
    return frames, {e.source.name: e.source.weight for e in entries}


def pretrain_from_blend(read: Callable[[Source], DataFrame], blend: list[Source], vocabulary: Vocabulary, **options) -> DataFrame:
    """From a blend to prepared batches: load with fallback, order key, text pick, mix, encoding, and batches or packing."""
    frames, weights = loaded_blend(read, blend)
    return pretrain_dataset(frames, weights, vocabulary, **options)


def sft_from_blend(read: Callable[[Source], DataFrame], blend: list[Source], **options) -> DataFrame:
    """From a blend to the rows of a fine-tuning run, as ``sft_dataset`` prepares them."""
    frames, weights = loaded_blend(read, blend)
    return sft_dataset(frames, weights, **options)


def encoded_pairs(
    pairs: DataFrame, vocabulary: Vocabulary, key: str, max_length: int | None = None, max_prompt_length: int | None = None
) -> DataFrame:
    """Token ids of prepared pairs ``(key, prompt, chosen, rejected)`` under the length limits of ``cap_pairs``.

    Each side is encoded by itself and joined on the key, which must be unique.
    """
    ids = pairs.select(key)
    for side in SIDES:
        coded = encode(pairs.select(key, side), vocabulary, column=side, keep=[key])
        ids = ids.join(coded.select(key, F.col("input_ids").alias(side)), key)
    return cap_pairs(ids, PAD_ID, max_length, max_prompt_length)


def preference_dataset(frame: DataFrame | None, spark=None, conversation: str | None = None) -> DataFrame:
    """Prepared pairs of a source, or the built-in pairs where the source could not be read.

    ``conversation`` names the key of nested pairs that are stored in several parts: a pair is dropped when one of its sides
    is empty in all parts, and the parts that remain keep the key and their number.
    """
    rows = fallback_pairs(spark) if frame is None else frame
    if conversation is None:
        return build_pairs(rows)
    return nonempty_by(rows.select(conversation, "part", *pair_columns(rows)), conversation)
