"""Language of a text: a string kernel on n-gram presence, Nyström landmarks, and one-versus-rest kernel ridge regression.

A text's blended spectrum is the set of its 1- to 4-grams of letters (lower case, everything else one blank), hashed to
``BUCKETS``. The kernel of two texts is the size of the common set over the geometric mean of both sizes. Some training texts
are landmarks; ridge regression on the Nyström features gives one score per language, and since all of that is linear in
the presence vector, it folds into one ``BUCKETS`` x languages matrix: a batch is scored by one product.

Learning knows every language. It takes at most ``PER_LANGUAGE`` documents of each and ``LEARNED`` of all, in equal shares and at least
``FEWEST`` each, chosen by hash of their ids, each as a whole and as a short excerpt so that short texts are known too.
Landmarks are shared out in the same way. The driver gets two bytes per n-gram present in these, and the matrix has
``BUCKETS`` numbers per language; neither depends on the number or length of documents.

Defined results: a text that is NULL or has no letter is ``und`` with score 0, as is every text if nothing could be learned;
a NULL doc_id is not held out and not learned from; repeated rows are predicted alike (and learned once); an empty table gives an
empty result. Only ``doc_id``, ``text`` and, for learning, ``lang`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusloom.llm.common import landed, travels

GRAMS, BUCKETS, UNKNOWN = 4, 1 << 16, "und"
PER_LANGUAGE, LEARNED, FEWEST = 300, 30_000, 8
PER_LANGUAGE_LANDMARKS, LANDMARKS, RIDGE = 24, 2_400, 1e-3
CHUNK = 1 << 20  # characters that are hashed at a time; the sets of the chunks are united

travels(__name__)


#: Which code points are letters, as bits: the form that travels with the job.
LETTERS = np.packbits(np.char.isalpha(np.arange(0x110000, dtype="<u4").view("<U1")))


def spectrum(text: str, letters: np.ndarray) -> np.ndarray:
    """The buckets of a text's n-grams, each once, in order; empty if the text has no letter."""
    present = np.zeros(BUCKETS, dtype=bool)
    for at in range(0, len(text), CHUNK):
        part = text[max(0, at - GRAMS) : at + CHUNK].lower()
        codes = np.frombuffer(part.encode("utf-32-le", "replace"), dtype="<u4")
        codes = np.where(letters[codes], codes, 32).astype(np.uint64)
        codes = np.concatenate(([np.uint64(32)], codes, [np.uint64(32)]))
        codes = codes[np.concatenate(([True], (codes[1:] != 32) | (codes[:-1] != 32)))]
        if len(codes) < 3 and not (codes != 32).any():
            continue
        value = np.zeros(len(codes), dtype=np.uint64)
        for n in range(1, GRAMS + 1):
            if len(codes) < n:
                break
            value = value[: len(codes) - n + 1] * np.uint64(0x100000001B3) + codes[n - 1 :] + np.uint64(n)
            present[(value * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)] = True
    return np.flatnonzero(present)


def excerpt(text: str, words: int = 8) -> str:
    """Some words from the middle of a text."""
    all_words = text.split()
    middle = max(0, len(all_words) // 2 - words // 2)
    return " ".join(all_words[middle : middle + words])


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def share_of(languages: int, most: int, total: int, fewest: int) -> int:
    """How many of a bounded number each language gets."""
    return max(fewest, min(most, total // max(1, languages)))


def training_spectra(docs: DataFrame, per_language: int = PER_LANGUAGE) -> list[tuple[str, np.ndarray]]:
    """Language and spectrum of the chosen training texts; at most two per chosen document."""
    known = docs.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    languages = landed(known.groupBy("lang").agg(F.count(F.lit(1)).alias("__rows")), "languages")
    per_language = share_of(languages.count(), per_language, LEARNED, FEWEST)
    # About twice the wanted number passes by its hash, so that the window below is small for any language.
    chance = F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    ids = known.select("doc_id", "lang").join(languages, "lang").where(chance * F.col("__rows") < 2 * per_language + 50)
    first = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    ranks = ids.select("doc_id", "lang").distinct().withColumn("__n", F.row_number().over(first))
    chosen = ranks.where(F.col("__n") <= per_language).select(F.col("doc_id").alias("__id"), F.col("lang").alias("__lang"))
    texts = known.join(F.broadcast(chosen), (F.col("doc_id") == F.col("__id")) & (F.col("lang") == F.col("__lang")))
    once = texts.groupBy("doc_id", "lang").agg(F.min("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = np.unpackbits(LETTERS).astype(bool)
        for batch in batches:
            rows = [(lang, spectrum(x, letters)) for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for x in (text, excerpt(text))]
            rows = [r for r in rows if len(r[1])]
            yield pa.record_batch([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1].astype("<u2").tobytes() for r in rows], pa.binary())], ["lang", "grams"])

    found = once.select("lang", "text").mapInArrow(run, "lang string, grams binary")
    rows = [(r[0], np.frombuffer(r[1], "<u2")) for r in found.collect()]
    return sorted(rows, key=lambda r: (r[0], r[1].tolist()))


def learn(rows: list[tuple[str, np.ndarray]], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, the folded matrix (buckets x languages) and the constant of each language."""
    names = sorted({r[0] for r in rows})
    if not rows:
        return [], np.zeros((BUCKETS, 0), np.float32), np.zeros(0)
    landmarks = share_of(len(names), PER_LANGUAGE_LANDMARKS, landmarks, 1)
    by_name: dict[str, list[np.ndarray]] = {}
    for name, grams in rows:
        by_name.setdefault(name, []).append(grams)
    marks = [g for n in names for g in by_name[n][:: max(1, len(by_name[n]) // landmarks)][:landmarks]]
    basis = np.zeros((BUCKETS, len(marks)), np.float32)
    for j, grams in enumerate(marks):
        basis[grams, j] = 1 / np.sqrt(len(grams))
    between = (basis.T @ basis).astype(np.float64)
    values, vectors = np.linalg.eigh(between)
    good = values > 1e-6 * values.max()
    to_features = vectors[:, good] / np.sqrt(values[good])
    kernel = np.array([basis[g].sum(0) / np.sqrt(len(g)) for _, g in rows], dtype=np.float64)
    features = np.hstack([kernel @ to_features, np.ones((len(rows), 1))])
    target = np.array([[1.0 if r[0] == n else -1.0 for n in names] for r in rows])
    penalty = ridge * len(rows) * np.eye(features.shape[1])
    penalty[-1, -1] = 0
    weights = np.linalg.solve(features.T @ features + penalty, features.T @ target)
    return names, basis @ (to_features @ weights[:-1]).astype(np.float32), weights[-1]


def predicted(docs: DataFrame, names: list[str], matrix: np.ndarray, constant: np.ndarray) -> DataFrame:
    """Rows ``(doc_id, lang_pred, score)``: the language of the largest one-versus-rest value, and that value mapped to 0..1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = np.unpackbits(LETTERS).astype(bool)
        for batch in batches:
            grams = [spectrum(text.as_py() or "", letters) for text in batch.column(1)]
            sizes = np.array([len(g) for g in grams])
            some = np.flatnonzero(sizes) if names else np.array([], dtype=int)
            best, score = np.full(len(grams), -1), np.zeros(len(grams))
            if len(some):
                starts = np.concatenate(([0], np.cumsum(sizes[some])[:-1]))
                values = np.empty((len(some), len(names)))
                for a in range(0, len(some), 512):  # presence rows times matrix, batch by batch
                    ids = np.concatenate([grams[i] for i in some[a : a + 512]])
                    values[a : a + 512] = np.add.reduceat(matrix[ids], starts[a : a + 512] - starts[a], axis=0)
                values = values / np.sqrt(sizes[some])[:, None] + constant
                best[some] = values.argmax(1)
                score[some] = np.clip((values.max(1) + 1) / 2, 0, 1)
            found = [names[b] if b >= 0 else UNKNOWN for b in best]
            yield pa.record_batch([batch.column(0), pa.array(found, pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(run, "doc_id bigint, lang_pred string, score double")


def identify(docs: DataFrame) -> DataFrame:
    """Learn from the documents that are not held out and predict all: ``(doc_id, held_out, lang_pred, score)``."""
    rows = predicted(docs, *learn(training_spectra(docs)))
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
