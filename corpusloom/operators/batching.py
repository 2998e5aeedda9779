"""Length caps, padding, fixed-size batches and packing of token sequences."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from corpusloom.operators.ordering import MAX_BUCKETS, bucket_count, bucket_of, constants, numbered, running_total
from corpusloom.session import landed

IGNORED_LABEL = -100  # fixed value: target positions that carry no loss
PAD_MULTIPLE = 8  # fixed value: batch widths are multiples of this


def fixed_batches(
    df: DataFrame, batch_size: int, order: list[str], out: str = "batch_id", rows_per_bucket: int | None = None
) -> DataFrame:
    """Consecutive rows in ``order`` form batches of ``batch_size``; the last one may be smaller."""
    rows = numbered(df, order, out="__n", rows_per_bucket=rows_per_bucket)
    return rows.withColumn(out, F.floor((F.col("__n") - 1) / batch_size)).withColumn(
        "place", ((F.col("__n") - 1) % batch_size).cast("int")
    ).drop("__n")


RANGE = "__range"  # the task of a row: a stretch of whole chunks or batches
PLACES_PER_TASK = 1 << 25


def dealt_by_place(
    df: DataFrame, key: str, size: Column, unit: int, out: str, rows_per_bucket: int | None = None
) -> DataFrame:
    """Lay rows end to end in key order and deal them out to tasks of whole units of ``unit`` places, moving each row once.

    Adds where a row starts (``out``) and its task (``__range``), and sets the task's stretch apart as ``__from`` and ``__to``. Keys and
    sizes are numbered by themselves first, which gives the first key of every task and the place where that row starts: one
    row per task for the driver. The rows themselves are then dealt by their keys. A row over the end of a stretch stands in
    the next task too, so that every unit is whole in one task.
    """
    sizes = landed(df.select(key, size.cast("bigint").alias("size")).where("size > 0"), "sizes")
    total, rows, keyed = sizes.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1)), F.count(key)).first()
    if keyed < rows:
        raise ValueError(f"rows without {key} have no place")
    tasks = min(MAX_BUCKETS, max(bucket_count(df, rows, rows_per_bucket), -(-total // PLACES_PER_TASK)))
    stretch = max(1, -(-total // (unit * tasks))) * unit
    placed = running_total(sizes, F.col("size"), [key], out="stop", rows_per_bucket=rows_per_bucket)
    first, last = F.ceil((F.col("stop") - F.col("size")) / stretch), F.floor((F.col("stop") - 1) / stretch)
    begun = placed.where(first <= last).select(key, (F.col("stop") - F.col("size")).alias("start"), first.alias("first"), last.alias("last"))
    heads = sorted(tuple(r) for r in begun.collect()) or [(0, 0, 0, 0)]
    keys = [k for k, *_ in heads]
    # Of a row in which stretches begin: the task before them, unless the row starts with the first of them.
    before = [max(0, one - (start < one * stretch)) for _, start, one, _ in heads]
    starts = [start for _, start, one, end in heads for _ in range(one, end + 1)]
    at = bucket_of(F.col(key), keys) - 1
    own = F.get(constants([end for *_, end in heads], "bigint"), at)
    kind = "bigint" if all(isinstance(k, int) for k in keys) else "double"
    since = F.when(F.col(key) == F.get(constants(keys, kind), at), F.get(constants(before, "bigint"), at)).otherwise(own)
    rows = df.where(F.col(key) >= F.lit(keys[0])).withColumn(RANGE, F.explode(F.sequence(since, own))).repartition(tasks, RANGE)
    ahead = Window.partitionBy(RANGE).orderBy(key).rowsBetween(Window.unboundedPreceding, 0)
    start = F.get(constants(starts, "bigint"), F.col(RANGE)) + F.sum(size.cast("bigint")).over(ahead) - size
    return rows.withColumns({out: start, "__from": F.col(RANGE) * stretch, "__to": (F.col(RANGE) + 1) * stretch})


def dealt_batches(df: DataFrame, batch_size: int, key: str, out: str = "batch_id", rows_per_bucket: int | None = None) -> DataFrame:
    """As ``fixed_batches`` by one key, with the rows of a batch in one task, which ``__range`` names: ``collate`` and
    ``collate_groups`` need no further move when they get it as ``within``."""
    rows = dealt_by_place(df, key, F.lit(1), batch_size, "__n", rows_per_bucket)
    return rows.withColumns(
        {out: F.floor(F.col("__n") / batch_size), "place": (F.col("__n") % batch_size).cast("int")}
    ).drop("__n", "__from", "__to")


def repeated(value: int | Column, times: Column) -> Column:
    return F.array_repeat(F.lit(value) if isinstance(value, int) else value, times)


def pad_right(ids: Column, width: Column, pad: int) -> Column:
    return F.concat(ids, repeated(pad, width - F.size(ids)))


def pad_left(ids: Column, width: Column, pad: int) -> Column:
    return F.concat(repeated(pad, width - F.size(ids)), ids)


def rounded_width(longest: Column, multiple: int = PAD_MULTIPLE) -> Column:
    return (F.ceil(longest / multiple) * multiple).cast("int")


def collate(
    df: DataFrame, pad_id: int, batch: str = "batch_id", ids: str = "input_ids", within: Sequence[str] = ()
) -> DataFrame:
    """Pad every sequence to the width of its batch and add attention mask and labels.

    The width is the longest sequence of the batch, rounded up to a multiple of 8. A batch has a fixed number of rows,
    so the window over it is bounded. Labels repeat the ids, with pad positions (and pad ids) ignored. ``within`` names columns
    that the batches are dealt by already.
    """
    width = rounded_width(F.max(F.size(ids)).over(Window.partitionBy(*within, batch)))
    sized = df.withColumn("width", width)
    blank = F.col("width") - F.size(ids)
    ignored = F.transform(ids, lambda i: F.when(i == pad_id, F.lit(IGNORED_LABEL)).otherwise(i))
    return sized.withColumns(
        {
            ids: pad_right(F.col(ids), F.col("width"), pad_id),
            "attention_mask": F.concat(repeated(1, F.size(ids)), repeated(0, blank)),
            "labels": F.concat(
                F.when(F.array_contains(ids, pad_id), ignored).otherwise(F.col(ids)),
                repeated(IGNORED_LABEL, blank),
            ),
        }
    )


def collate_groups(
    df: DataFrame, pad_id: int, batch: str = "batch_id", key: str = "key", ids: str = "input_ids", within: Sequence[str] = ()
) -> DataFrame:
    """One row per batch with the padded matrix, rows in key order. A batch is fixed in number."""
    gathered = df.groupBy(*within, batch).agg(
        F.array_sort(F.collect_list(F.struct(F.col(key).alias("k"), F.col(ids).alias("v")))).alias("rows"),
        rounded_width(F.max(F.size(ids))).alias("width"),
    )
    matrix = F.transform("rows", lambda r: pad_right(r["v"], F.col("width"), pad_id))
    return gathered.select(F.col(batch).cast("bigint").alias(batch), "width", matrix.alias(ids))


def attention_mask(ids: Column) -> Column:
    return repeated(1, F.size(ids))


def truncated(ids: Column, max_length: int) -> Column:
    return F.slice(ids, 1, max_length)


def cap_pairs(
    df: DataFrame, pad_id: int, max_length: int | None = None, max_prompt_length: int | None = None
) -> DataFrame:
    """Length limits of token pairs ``prompt, chosen, rejected``; both limits are off unless given.

    The prompt keeps its last ``max_prompt_length`` tokens. Each answer follows it and is cut where prompt and answer
    reach ``max_length``. The shorter of the two sequences is padded on the left to the length of the longer.
    """
    prompt = F.col("prompt")
    if max_prompt_length is not None:
        start = F.greatest(F.size(prompt) - max_prompt_length, F.lit(0)) + 1
        prompt = F.slice(prompt, start, F.lit(max_prompt_length))
    rows = df.withColumn("prompt", prompt)
    for side in ("chosen", "rejected"):
        whole = F.concat("prompt", side)
        rows = rows.withColumn(f"{side}_ids", whole if max_length is None else F.slice(whole, 1, max_length))
    width = F.greatest(F.size("chosen_ids"), F.size("rejected_ids"))
    return rows.withColumn("width", width).withColumns(
        {f"{side}_ids": pad_left(F.col(f"{side}_ids"), F.col("width"), pad_id) for side in ("chosen", "rejected")}
    )


def packing_offsets(
    df: DataFrame,
    length: int,
    key: str = "key",
    ids: str = "input_ids",
    end_tokens: int = 1,
    rows_per_bucket: int | None = None,
) -> DataFrame:
    """Where each sequence starts and ends when all are laid end to end, and which packed chunks it touches."""
    size = (F.size(ids) + end_tokens).cast("bigint")
    sizes = df.select(key, size.alias("size"))  # sequences stay where they are
    rows = running_total(sizes, F.col("size"), [key], out="stop", rows_per_bucket=rows_per_bucket)
    return rows.withColumn("start", F.col("stop") - F.col("size")).where("stop > start").drop("size").withColumns(
        {
            "first_chunk": F.floor(F.col("start") / length),
            "last_chunk": F.floor((F.col("stop") - 1) / length),
        }
    )


def pack(
    df: DataFrame,
    length: int,
    end_id: int,
    key: str = "key",
    ids: str = "input_ids",
    keep_last: bool = True,
    rows_per_bucket: int | None = None,
) -> DataFrame:
    """Rows ``(chunk, input_ids)`` of exactly ``length`` tokens: all sequences end to end, each closed by ``end_id``.

    A sequence that crosses a boundary is cut there. The last chunk may be shorter; ``keep_last=False`` leaves it out.
    A chunk gathers at most ``length`` tokens. Token arrays are moved once.
    """
    # Sequences are dealt by the chunks they fall in, so that chunks are put together where their pieces are.
    rows = dealt_by_place(df.select(key, ids), key, F.size(ids) + 1, length, "start", rows_per_bucket)
    rows = rows.withColumns({ids: F.concat(F.col(ids), F.array(F.lit(end_id))), "stop": F.col("start") + F.size(ids) + 1})
    since, until = F.greatest("start", "__from"), F.least("stop", "__to")
    rows = rows.withColumns({"since": since, "until": until}).where("since < until")
    cuts = F.transform(
        F.sequence(F.floor(F.col("since") / length), F.floor((F.col("until") - 1) / length)),
        lambda c: F.struct(
            c.alias("chunk"),
            F.greatest(c * length, F.col("since")).alias("at"),
            F.slice(
                ids,
                (F.greatest(c * length, F.col("since")) - F.col("start") + 1).cast("int"),
                (F.least((c + 1) * length, F.col("until")) - F.greatest(c * length, F.col("since"))).cast("int"),
            ).alias("piece"),
        ),
    )
    pieces = rows.select(RANGE, F.explode(cuts).alias("p")).select(RANGE, "p.*")
    chunks = pieces.groupBy(RANGE, "chunk").agg(F.array_sort(F.collect_list(F.struct("at", "piece"))).alias("pieces")).select(
        "chunk", F.flatten(F.transform("pieces", lambda p: p["piece"])).alias(ids)
    )
    return chunks if keep_last else chunks.where(F.size(ids) == length)


def map_batches(df: DataFrame, function, schema: T.StructType | str) -> DataFrame:
    """Apply a function from column batches to column batches, in as many workers as there are partitions."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield function(batch)

    return df.mapInPandas(run, schema)
