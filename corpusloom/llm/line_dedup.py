"""Line dedup: lines that many documents share stay only in one of them.

Each line's key is the line without white space at its ends and with A-Z lower-cased. Keys of at least ``MIN_CHARS`` code
points that are found in at least ``MIN_DOCS`` documents lose all their lines except in the largest doc_id that holds
them. Texts are cut at ``\\n`` and joined by it again.

Defined results: a NULL or empty text is one empty line; rows with a NULL doc_id are returned unchanged, and their lines do
not count; invalid UTF-8 passes through unchanged; rows that share a doc_id are one document and lose the same keys; an empty table gives an empty result.
Further columns of the input are passed through by ``dedup_lines``; the names ``n_lines``, ``n_dropped`` and ``__drop`` are
replaced.

The keys move as 128-bit hashes. Both aggregations combine on the map side, so a line that stands in a third of all
documents is one row per task and shuffle; the join back is dealt again by Spark where one key has most rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.common import landed, travels

MIN_CHARS, MIN_DOCS = 20, 3
SPACE = b" \t\n\x0b\x0c\r"

travels(__name__)


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """The 16-byte hash of a line's key, or nothing for a short key."""
    key = line.strip(SPACE).lower()  # bytes: only A-Z change
    if len(key) < min_chars or (len(key) < 4 * min_chars and len(key.decode(errors="replace")) < min_chars):
        return None
    return xxhash.xxh3_128_digest(key)


def _keys(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found = {line_key(line, min_chars) for line in (text.as_py() or b"").split(b"\n")} - {None}
                ids += [doc] * len(found)
                keys += found
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(keys, pa.binary())], ["doc_id", "key"])

    return run


def shared_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """Rows ``(doc_id, key)`` of the lines that each document loses."""
    rows = docs.where("doc_id is not null").select(F.col("doc_id").cast("bigint"), F.col("text").cast("binary").alias("text"))
    keys = landed(rows.mapInArrow(_keys(min_chars), "doc_id bigint, key binary"), "line-keys")
    often = (
        keys.groupBy("key").agg(F.count_distinct("doc_id").alias("docs"), F.max("doc_id").alias("last"))
        .where(F.col("docs") >= min_docs)
    )
    # Landed, so that both sides of the join are dealt out for it alone and Spark may split a key that most documents have.
    often = landed(often.select("key", "last"), "shared-keys")
    return keys.join(often, "key").where("doc_id < last").select("doc_id", "key")


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """The documents with their remaining text, and ``n_lines`` (before) and ``n_dropped``."""
    lost = shared_lines(docs, min_chars, min_docs).groupBy("doc_id").agg(F.collect_set("key").alias("__drop"))
    added = T.StructType([T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])
    rest = [c for c in docs.columns if c not in ("n_lines", "n_dropped", "__drop")]
    # Texts pass as bytes, so that invalid UTF-8 comes out as it went in.
    fields = [T.StructField(c, T.BinaryType()) if c == "text" else docs.schema[c] for c in rest]
    schema = T.StructType(fields + added.fields)
    place = rest.index("text")

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, before, dropped = [], [], []
            for text, drop in zip(batch.column(place), batch.column(len(rest)), strict=True):
                value = text.as_py()
                gone = set(drop.as_py() or ())
                lines = (value or b"").split(b"\n")
                kept = [x for x in lines if line_key(x, min_chars) not in gone] if gone else lines
                texts.append(value if len(kept) == len(lines) else b"\n".join(kept))
                before.append(len(lines))
                dropped.append(len(lines) - len(kept))
            columns = [pa.array(texts, pa.binary()) if i == place else batch.column(i) for i in range(len(rest))]
            yield pa.record_batch([*columns, pa.array(before), pa.array(dropped)], schema.names)

    read = [F.col(c).cast("binary").alias(c) if c == "text" else c for c in rest]
    rows = docs.select(*read).join(lost, "doc_id", "left").select(*rest, "__drop").mapInArrow(rebuild, schema)
    return rows.withColumn("text", F.col("text").cast("string"))
