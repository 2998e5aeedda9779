"""Fill-in-the-middle over seekable compressed texts.

A text is stored as independent zstandard frames of about ``FRAME`` bytes, each with the number of units (lines) and code points
up to its end. Frames are cut between code points, wherever a line ends. Whoever wants the place after the k-th line looks it up in
the counts and decompresses that one frame.

1. ``stored`` writes the frames of every document.
2. ``filled`` draws two cuts and a form per document from a digest of its id. Only the frames that hold a cut are decompressed, and
   their parts compressed again; all others move as they are. The output is again a list of frames, one after the other a valid
   zstandard stream: ``psm`` is ``<P>`` prefix ``<S>`` suffix ``<M>`` middle, ``spm`` is ``<S>`` suffix ``<P>`` prefix ``<M>`` middle.
3. ``restored`` puts the original's frames together from output and form alone: it streams the output to find the marks.
   ``digests`` streams the frames of output and restored text in order, one at a time, through SHA-256.

All stages are narrow: no row moves, and what a task holds is one document's compressed frames and one frame of text.

Defined results: a NULL text is empty; an empty text has no units and no frames, its form is ``plain``; texts with one of the marks
are ``plain`` too, so a mark in an output is always one of ours; a text of one line, or of one very long line over many frames, has
its cuts at its start and end; units are lines with their line break, a last line without one counts; a NULL doc_id draws by
the empty text in its place; rows that share a doc_id are drawn alike and each stands for itself; an empty table gives an empty
result. Code points are the bytes that begin one, so invalid UTF-8 passes through unchanged. Only ``doc_id`` and ``text`` are read, so
other columns cannot clash.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.hashing import digest_integer
from corpusloom.llm.common import landed, travels

FRAME = 1 << 16
LEVEL = 1  # of compression
SEED, RATE, SPM_RATE = 7, 100, 50  # per cent of documents with a cut, and of these in the form spm
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"  # fixed values: the marks of an output

travels(__name__)


# Frames -------------------------------------------------------------------------------------------------------------


def code_points(data: bytes) -> int:
    """Bytes that begin a code point."""
    return int(np.count_nonzero(np.frombuffer(data, np.int8) >= -64))  # continuation bytes are -128 to -65


def pieces(text: bytes, size: int) -> Iterator[bytes]:
    """The text in pieces of about ``size`` bytes that begin with a code point."""
    at = 0
    while at < len(text):
        end = min(len(text), at + size)
        while end < len(text) and end - at < size + 3 and text[end] & 0xC0 == 0x80:
            end += 1
        yield text[at:end]
        at = end


def stored(docs: DataFrame, frame: int = FRAME) -> DataFrame:
    """Rows ``(doc_id, units, marked, frames)``, written; a frame is ``(units, chars, data)`` with the counts up to its end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=LEVEL).compress
        entry = pa.struct([("units", pa.int64()), ("chars", pa.int64()), ("data", pa.binary())])
        for batch in batches:
            units, marked, frames = [], [], []
            for value in batch.column(1):
                text = value.as_py() or b""
                lines = chars = 0
                own = []
                for piece in pieces(text, frame):
                    lines += piece.count(b"\n")
                    chars += code_points(piece)
                    own.append({"units": lines, "chars": chars, "data": pack(piece)})
                units.append(lines + (bool(text) and not text.endswith(b"\n")))
                marked.append(any(m in text for m in (PREFIX, SUFFIX, MIDDLE)))
                frames.append(own)
            columns = [batch.column(0), pa.array(units, pa.int64()), pa.array(marked, pa.bool_()), pa.array(frames, pa.list_(entry))]
            yield pa.record_batch(columns, ["doc_id", "units", "marked", "frames"])

    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("binary").alias("text"))
    schema = "doc_id bigint, units bigint, marked boolean, frames array<struct<units: bigint, chars: bigint, data: binary>>"
    return landed(rows.mapInArrow(run, schema), "frames")


def stream(frames: Iterable[bytes]) -> Iterator[bytes]:
    """The text of frames, one at a time."""
    unpack = zstandard.ZstdDecompressor().decompress
    return map(unpack, frames)


def after_lines(piece: bytes, lines: int) -> int:
    """The place in a text after so many line breaks."""
    return int(np.flatnonzero(np.frombuffer(piece, np.uint8) == 10)[lines - 1]) + 1


class Stored:
    """One stored text. Places are ``(frame, byte)``; the frames that hold one are decompressed, each once."""

    def __init__(self, frames: list[dict], units: int) -> None:
        self.frames, self.units = frames, units
        self.ends = [f["units"] for f in frames]
        self.opened: dict[int, bytes] = {}

    def text(self, frame: int) -> bytes:
        if frame not in self.opened:
            self.opened[frame] = zstandard.ZstdDecompressor().decompress(self.frames[frame]["data"])
        return self.opened[frame]

    def after(self, units: int) -> tuple[int, int]:
        """The place after so many units."""
        if not units:
            return 0, 0
        if units == self.units:  # the last unit ends with the text
            return len(self.frames), 0
        frame = bisect_left(self.ends, units)
        at = after_lines(self.text(frame), units - (self.ends[frame - 1] if frame else 0))
        return (frame, at) if at < len(self.text(frame)) else (frame + 1, 0)

    def points(self, place: tuple[int, int]) -> int:
        """Code points before a place."""
        frame, at = place
        return (self.frames[frame - 1]["chars"] if frame else 0) + (code_points(self.text(frame)[:at]) if at else 0)

    def between(self, start: tuple[int, int], end: tuple[int, int]) -> list[bytes]:
        """The text between two places as frames: whole ones as they are, parts of cut ones compressed anew."""
        pack = zstandard.ZstdCompressor(level=LEVEL).compress
        (first, i), (last, j) = start, end
        if first == last:
            return [pack(self.text(first)[i:j])] if j > i else []
        head = [pack(self.text(first)[i:])] if i else []
        tail = [pack(self.text(last)[:j])] if j else []
        return [*head, *(f["data"] for f in self.frames[first + bool(i) : last]), *tail]


# Outputs ------------------------------------------------------------------------------------------------------------


def drawn(seed: int, number: int) -> Column:
    """The ``number``-th group of eight digits of the digest of seed and id, as an integer."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    return digest_integer(F.substring(digest, 8 * number - 7, 8), 8)


def filled(store: DataFrame, seed: int = SEED, rate: int = RATE, spm_rate: int = SPM_RATE) -> DataFrame:
    """Rows ``(doc_id, n, form, prefix_chars, middle_chars, output)``; ``output`` is a list of zstandard frames."""
    one, other = (F.pmod(drawn(seed, i), F.col("units") + 1) for i in (1, 2))
    plain = (F.col("units") == 0) | F.col("marked") | (drawn(seed, 3) % 100 >= rate)
    form = F.when(plain, F.lit("plain")).when(drawn(seed, 4) % 100 < spm_rate, F.lit("spm")).otherwise(F.lit("psm"))
    rows = store.select("doc_id", F.col("units").alias("n"), form.alias("form"), F.least(one, other).alias("a"), F.greatest(one, other).alias("b"), "frames")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=LEVEL).compress
        p, s, m = pack(PREFIX), pack(SUFFIX), pack(MIDDLE)
        for batch in batches:
            heads, middles, outputs = [], [], []
            n, forms, first, last = (batch.column(i).to_pylist() for i in range(1, 5))
            for i, value in enumerate(batch.column(5)):
                frames = value.as_py()
                if forms[i] == "plain":
                    heads.append(None)
                    middles.append(None)
                    outputs.append([f["data"] for f in frames])
                    continue
                text = Stored(frames, n[i])
                start, end = text.after(first[i]), text.after(last[i])
                prefix, middle, suffix = text.between((0, 0), start), text.between(start, end), text.between(end, (len(frames), 0))
                heads.append(text.points(start))
                middles.append(text.points(end) - heads[-1])
                outputs.append([p, *prefix, s, *suffix, m, *middle] if forms[i] == "psm" else [s, *suffix, p, *prefix, m, *middle])
            columns = [*batch.columns[:3], pa.array(heads, pa.int64()), pa.array(middles, pa.int64()), pa.array(outputs, pa.list_(pa.binary()))]
            yield pa.record_batch(columns, ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return rows.mapInArrow(run, "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output array<binary>")


# Reading outputs ----------------------------------------------------------------------------------------------------


def sections(chunks: Iterable[bytes], marks: tuple[bytes, ...]) -> Iterator[tuple[int, bytes]]:
    """The text between marks that follow each other in a known order, as ``(marks seen, text)``; a mark may lie across chunks."""
    seen, held = 0, b""
    for chunk in chunks:
        held += chunk
        while seen < len(marks) and (at := held.find(marks[seen])) >= 0:
            if at:
                yield seen, held[:at]
            held = held[at + len(marks[seen]) :]
            seen += 1
        keep = 2 if seen < len(marks) else 0  # these may be the beginning of the next mark
        if len(held) > keep:
            yield seen, held[: len(held) - keep]
            held = held[len(held) - keep :]
    if held:
        yield seen, held


def original(form: str, output: list[bytes]) -> Iterator[bytes]:
    """The text that an output was made of, in pieces, from the output's frames and form alone.

    One pass finds where the parts lie, as frames and bytes; then each part's frames are streamed in the order of the text.
    """
    if form == "plain":
        yield from stream(output)
        return
    marks = (PREFIX, SUFFIX, MIDDLE) if form == "psm" else (SUFFIX, PREFIX, MIDDLE)
    order = (1, 3, 2) if form == "psm" else (2, 3, 1)
    for wanted in order:
        # Frames are read again for each part rather than held: a part may be as long as the text.
        for section, piece in sections(stream(output), marks):
            if section == wanted:
                yield piece
            elif section > wanted:
                break


def restored(outputs: DataFrame) -> DataFrame:
    """Rows ``(doc_id, frames)``: the original text of rows ``(doc_id, form, output)``, as frames."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=LEVEL).compress
        for batch in batches:
            forms = batch.column(1).to_pylist()
            frames = [[pack(p) for p in original(f, o.as_py())] for f, o in zip(forms, batch.column(2), strict=True)]
            yield pa.record_batch([batch.column(0), pa.array(frames, pa.list_(pa.binary()))], ["doc_id", "frames"])

    return outputs.select("doc_id", "form", "output").mapInArrow(run, "doc_id bigint, frames array<binary>")


def digest(chunks: Iterable[bytes]) -> str:
    """SHA-256 of a text that arrives in chunks."""
    state = hashlib.sha256()
    for chunk in chunks:
        state.update(chunk)
    return state.hexdigest()


def digests(outputs: DataFrame) -> DataFrame:
    """The rows of ``filled`` without ``output``, but with ``output_sha256`` and ``restored_sha256``."""
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made, back = [], []
            for form, value in zip(batch.column(2).to_pylist(), batch.column(5), strict=True):
                frames = value.as_py()
                made.append(digest(stream(frames)))
                back.append(digest(original(form, frames)))
            yield pa.record_batch([*batch.columns[:5], pa.array(made), pa.array(back)], [*names, "output_sha256", "restored_sha256"])

    schema = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output_sha256 string, restored_sha256 string"
    return outputs.select(*names, "output").mapInArrow(run, schema)
