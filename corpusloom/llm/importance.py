"""Importance resampling: documents are drawn by how much likelier the target makes them than the whole corpus does.

Two generative models count hashed word 1- and 2-grams: one over all documents (raw), one over labelled good documents
(target: quality 1 and not toxic). A document's log weight is the sum of the logarithms of their ratio over its n-grams. The
draw uses the mean per n-gram, so that length alone neither helps nor hurts. Adding Gumbel noise, drawn by hash of doc_id, and
taking the largest keys draws without replacement in proportion to the mean weights raised to ``1 / temperature``.

The raw counts cover every document. The target is fitted on at most ``LABELLED_ROWS`` labelled documents, chosen by hash of
their ids; the ratio of a bucket is drawn towards 1 by ``PRIOR`` expected occurrences, so rare n-grams of the labelled texts do not
favour those texts.

Defined results: a NULL or empty text has log weight 0; without a labelled target all weights are 0 and the draw is uniform; NULL or
repeated labels do no harm (the lowest quality and highest toxicity count); a NULL doc_id draws the noise of its text's hash; repeated
rows get equal keys and are drawn independently of each other at the edge; an empty table gives an empty result. Only ``doc_id``
and ``text`` are read, so other columns cannot clash.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.hashing import uniform
from corpusloom.llm.common import landed, ranked, travels

BUCKETS, LABELLED_ROWS, PRIOR, TEMPERATURE, SEED = 1 << 17, 20_000, 5.0, 0.003, 17
TOKEN = re.compile(r"\w+|[^\w\s]+")
MOST_CACHED = 200_000

travels(__name__)


class Hasher:
    """N-gram buckets of texts; the hashes of recent words are kept."""

    def __init__(self) -> None:
        self.known: dict[str, int] = {}

    def buckets(self, text: str) -> np.ndarray:
        words = TOKEN.findall(text.lower())
        new = set(words).difference(self.known)
        if len(self.known) + len(new) > MOST_CACHED:
            self.known.clear()
            new = set(words)
        self.known.update((w, xxhash.xxh3_64_intdigest(w.encode("utf-8", "replace"))) for w in new)
        one = np.fromiter(map(self.known.__getitem__, words), dtype=np.uint64, count=len(words))
        two = (one[:-1] * np.uint64(0x9E3779B97F4A7C15) + one[1:]) * np.uint64(0xC2B2AE3D27D4EB4F)
        return (np.concatenate((one, two)) >> np.uint64(64 - 17)).astype(np.int64)


def gram_counts(docs: DataFrame, target: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Counts of each bucket over all documents and over the target ``(doc_id)``, which is bounded and broadcast."""
    marked = docs.select("doc_id", "text").join(F.broadcast(target.withColumn("__target", F.lit(True))), "doc_id", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, counts = Hasher(), np.zeros((2, BUCKETS), dtype=np.int64)
        for batch in batches:
            for text, good in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                found = np.bincount(ids, minlength=BUCKETS) if len(ids := hasher.buckets(text.as_py() or "")) > BUCKETS else None
                for row in (0, 1) if good else (0,):
                    if found is None:
                        np.add.at(counts[row], ids, 1)
                    else:
                        counts[row] += found
        some = np.flatnonzero(counts[0])
        yield pa.record_batch([pa.array(some, pa.int64()), pa.array(counts[0][some]), pa.array(counts[1][some])], ["bucket", "raw", "target"])

    parts = marked.select("text", "__target").mapInArrow(run, "bucket bigint, raw bigint, target bigint")
    total = np.zeros((2, BUCKETS), dtype=np.int64)
    for bucket, raw, good in parts.groupBy("bucket").agg(F.sum("raw"), F.sum("target")).collect():  # at most BUCKETS rows
        total[:, bucket] = raw, good
    return total[0], total[1]


def log_ratios(raw: np.ndarray, target: np.ndarray, prior: float = PRIOR) -> np.ndarray:
    """Logarithm of target over raw probability of each bucket, drawn towards 0 where little is expected."""
    if not target.sum():
        return np.zeros(len(raw))
    expected = raw * (target.sum() / max(1, raw.sum()))
    return np.log((target + prior) / (expected + prior))


def weighed(docs: DataFrame, ratios: np.ndarray) -> DataFrame:
    """Rows ``(doc_id, n_grams, log_weight, text_hash)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            sizes, weights, hashes = [], [], []
            for text in batch.column(1):
                value = text.as_py() or ""
                ids = hasher.buckets(value)
                sizes.append(len(ids))
                weights.append(float(ratios[ids].sum()))
                hashes.append(xxhash.xxh3_64_intdigest(value.encode("utf-8", "replace")) >> 1)
            yield pa.record_batch(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(weights, pa.float64()), pa.array(hashes, pa.int64())],
                ["doc_id", "n_grams", "log_weight", "text_hash"],
            )

    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id bigint, n_grams bigint, log_weight double, text_hash bigint")


def good_labels(labels: DataFrame, bound: int = LABELLED_ROWS) -> tuple[DataFrame, float]:
    """The ids of the target among at most ``bound`` labelled documents, and their share."""
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(
        F.min("quality").alias("quality"), F.max(F.coalesce("toxic", F.lit(0))).alias("toxic")
    )
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
    rows = [(r.doc_id, r.quality == 1 and r.toxic == 0) for r in chosen.collect()]
    good = [(i,) for i, fine in rows if fine]
    return labels.sparkSession.createDataFrame(good, "doc_id bigint"), len(good) / len(rows) if rows else 0.0


def resampled(docs: DataFrame, labels: DataFrame, share: float | None = None, temperature: float = TEMPERATURE, seed: int = SEED) -> DataFrame:
    """Rows ``(doc_id, n_grams, log_weight, gumbel_key, kept)``; the ``share`` of documents with the largest keys is kept.

    ``share`` defaults to the share of the target among the labelled documents.
    """
    target, found = good_labels(labels)
    share = (found or 1.0) if share is None else share
    # Landed: range partitioning reads its input twice.
    rows = landed(weighed(docs, log_ratios(*gram_counts(docs, target))), "weights")
    noise = -F.log(-F.log(uniform(seed, F.coalesce("doc_id", "text_hash"))))
    keyed = rows.withColumn("gumbel_key", F.col("log_weight") / F.greatest("n_grams", F.lit(1)) / temperature + noise).withColumn("__down", -F.col("gumbel_key"))
    placed, total = ranked(keyed, ["__down", "doc_id", "text_hash"], "__rank", "gumbel")
    wanted = int(np.ceil(share * total))
    return placed.select("doc_id", "n_grams", "log_weight", "gumbel_key", (F.col("__rank") < wanted).alias("kept"))
