"""Packing: documents become pieces of at most ``LENGTH`` tokens, and pieces share sequences with little padding.

A document is cut into whole sequences and one remainder. The remainders are packed shortest-pack-first over the
histogram of their lengths: lengths are placed longest first, each into the packs that hold least so far and still have
room, and what is kept is only how many packs follow which pattern. The histogram has at most ``LENGTH`` entries, so this
is done on the driver, however many documents there are. Pieces are then joined to their places by their rank among
the pieces of equal length.

Defined results: a NULL or empty text is the end token alone; a NULL doc_id is kept and sorts first; repeated rows are each
packed; an empty table gives an empty result. Only ``doc_id`` and ``text`` are read, so other columns cannot clash.

Token ids are those that the given ``tokenizers`` file gives without adding special tokens; a special token's own string in a text is
that token, as for any user of the file. Where the file is a byte-level BPE whose ids are in
merge order, the same merges are run by tiktoken, which is four times as fast; any other file is run by ``tokenizers``.
"""

from __future__ import annotations

import heapq
import json
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import landed, ranked, travels

LENGTH, END, FILE = 1024, 0, "byte_bpe_50k.json"
LONG_BLANK = re.compile(r"\s{10000}")  # tiktoken's pattern engine gives up on longer runs

travels(__name__)


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies, and the byte."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def encoder(path: str | None = None) -> Callable[[str], list[int]]:
    """A function from a text to its ids; ``path`` defaults to the public file ``FILE``."""
    import public_tokenizers

    path = path or public_tokenizers.path(FILE)
    with open(path, encoding="utf-8") as file:
        model = json.load(file)
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(path)

    def slow(text: str) -> list[int]:
        return whole.encode(text, add_special_tokens=False).ids

    special = {t["content"] for t in model["added_tokens"]}
    vocabulary = model["model"].get("vocab", {})
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["model"].get("merges", [])]
    ids = [vocabulary.get("".join(m), -1) for m in merges] if isinstance(vocabulary, dict) else [-1]
    split = model.get("pre_tokenizer") or {}
    usual = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
    if model.get("normalizer") or not usual or ids != sorted(set(ids)) or -1 in ids:
        return slow
    import tiktoken

    symbols = byte_symbols()
    ranks = {bytes(symbols[c] for c in token): i for token, i in vocabulary.items() if token not in special}
    fast = tiktoken.Encoding("same", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    named = re.compile("|".join(re.escape(t) for t in sorted(special)) or r"(?!)")
    return lambda text: slow(text) if named.search(text) or LONG_BLANK.search(text) else fast.encode_ordinary(text)


def pieces(docs: DataFrame, path: str | None = None, length: int = LENGTH, end: int = END, with_ids: bool = True) -> DataFrame:
    """Rows ``(doc_id, start, length, ids_crc32, doc_tokens[, ids])``: whole sequences and one remainder per document."""
    fields = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64())]
    schema = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
    if with_ids:
        fields, schema = [*fields, ("ids", pa.list_(pa.int32()))], schema + ", ids array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows: list[list] = [[] for _ in fields]
                part = batch.slice(at, 256)
                for doc, text in zip(part.column(0).to_pylist(), part.column(1), strict=True):
                    ids = np.array([*encode(text.as_py() or ""), end], dtype="<u4")
                    for start in range(0, len(ids), length):
                        piece = ids[start : start + length]
                        row = (doc, start, len(piece), zlib.crc32(piece.tobytes()), len(ids), piece.astype(np.int32))
                        for column, value in zip(rows, row, strict=False):
                            column.append(value)
                yield pa.record_batch([pa.array(v, f[1]) for v, f in zip(rows, fields, strict=True)], [f[0] for f in fields])

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(run, schema)


def patterns(histogram: dict[int, int], length: int = LENGTH) -> list[tuple[int, tuple[int, ...]]]:
    """``(packs, lengths in the pack)`` by shortest-pack-first: each length goes where most room is left, if it fits.

    Open patterns are kept by the room they leave. One step serves as many pieces as a pattern has packs.
    """
    rooms: dict[int, list[list]] = {}
    heap: list[int] = []

    def put(room: int, packs: int, pattern: tuple[int, ...]) -> None:
        if room not in rooms or not rooms[room]:
            rooms[room] = []
            heapq.heappush(heap, -room)
        rooms[room].append([packs, pattern])

    for size in sorted(histogram, reverse=True):
        left, grown = histogram[size], []
        while left:
            while heap and not rooms[-heap[0]]:
                heapq.heappop(heap)
            if not heap or -heap[0] < size:
                grown.append((length - size, left, (size,)))
                break
            group = rooms[-heap[0]]
            room, found = -heap[0], group[-1]
            packs = min(left, found[0])
            found[0] -= packs
            if not found[0]:
                group.pop()
            put(room - size, packs, (*found[1], size))
            left -= packs
        for room, packs, pattern in grown:
            put(room, packs, pattern)
    return [(n, p) for groups in rooms.values() for n, p in groups]


def places(found: list[tuple[int, tuple[int, ...]]]) -> list[tuple]:
    """Rows ``(length, first rank, end rank, pieces per pack, first sequence, offset)``: which ranks go to which packs."""
    rows, next_rank, sequence = [], {}, 0
    for packs, pattern in found:
        offset = 0
        for size in sorted(set(pattern), reverse=True):
            each = pattern.count(size)
            first = next_rank.get(size, 0)
            next_rank[size] = first + each * packs
            rows.append((size, first, first + each * packs, each, sequence, offset))
            offset += each * size
        sequence += packs
    return rows


def packed(rows: DataFrame, length: int = LENGTH) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces ``(doc_id, start, length, …)``.

    ``rows`` should be landed, as it is read twice. The table of places is broadcast: it has a row for each length
    of each pattern, which depends on ``length`` and not on the number of pieces.
    """
    spark = rows.sparkSession
    counts = {r[0]: r[1] for r in rows.groupBy("length").count().collect()}
    by_rank, _ = ranked(rows, ["length", "doc_id", "start"], "__rank", "pieces-by-length")
    before, total = [], 0
    for size in sorted(counts):
        before.append((size, total))
        total += counts[size]
    table = "__size bigint, __first bigint, __end bigint, __each bigint, __sequence bigint, __offset bigint"
    spots = spark.createDataFrame(places(patterns(counts, length)), table)
    starts = spark.createDataFrame(before, "__size bigint, __before bigint")
    grouped = spots.groupBy("__size").agg(F.array_sort(F.collect_list(F.struct(*[c for c in spots.columns if c != "__size"]))).alias("__spots"))
    joined = by_rank.join(F.broadcast(starts.join(grouped, "__size")), F.col("length") == F.col("__size"))
    own = joined.withColumn("__own", F.col("__rank") - F.col("__before"))
    spot = own.withColumn("__spot", F.filter("__spots", lambda s: (s["__first"] <= F.col("__own")) & (F.col("__own") < s["__end"]))[0])
    among = F.col("__own") - F.col("__spot.__first")
    return spot.select(
        *rows.columns,
        (F.col("__spot.__sequence") + F.floor(among / F.col("__spot.__each"))).cast("bigint").alias("sequence_id"),
        (F.col("__spot.__offset") + among % F.col("__spot.__each") * F.col("length")).cast("bigint").alias("offset"),
    )


def pack(docs: DataFrame, path: str | None = None, length: int = LENGTH, end: int = END, with_ids: bool = True) -> DataFrame:
    """All pieces of the documents with their places."""
    return packed(landed(pieces(docs, path, length, end, with_ids), "pieces"), length)


def sequences(rows: DataFrame, length: int = LENGTH, pad: int = END) -> DataFrame:
    """One row per sequence ``(sequence_id, ids, doc_ids, tokens)``, padded on the right; a sequence has at most ``length`` pieces."""
    parts = rows.groupBy("sequence_id").agg(
        F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids"))).alias("parts"), F.sum("length").alias("tokens")
    )
    ids = F.flatten(F.transform("parts", lambda p: p["ids"]))
    blank = F.array_repeat(F.lit(pad), (F.lit(length) - F.col("tokens")).cast("int"))
    return parts.select("sequence_id", F.concat(ids, blank).alias("ids"), F.transform("parts", lambda p: p["doc_id"]).alias("doc_ids"), "tokens")
