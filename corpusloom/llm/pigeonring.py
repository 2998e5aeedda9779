"""Near-duplicates by SimHash, candidates pruned by chains of segments on a ring.

A document is the multiset of its three-word shingles (words between white space, A-Z lower-cased). A bit of its 64-bit fingerprint
is 1 if more than half of the shingles' XXH64 values have it. Fingerprints link at ``RADIUS`` or fewer differing bits.

1. Documents of one fingerprint are one class from here on, so copies cost nothing further.
2. The 64 bits are four segments on a ring. If two fingerprints differ in at most ``RADIUS`` bits, there is a segment from which
   every chain of ``k`` consecutive segments differs in at most ``k * RADIUS / 4`` bits: the first segment in none, two
   in one, three in two. Classes are therefore dealt to four nodes, by the value of each segment, and a pair is looked at in
   the node of the segment where its chains begin; it is dropped at the first chain that is over its budget, and the full distance
   is only taken of what remains.
3. A node of more than ``NODE`` classes branches: of two segments only one bit may differ, so one half of the second segment is equal;
   after that, the bits not fixed yet are cut in ``RADIUS + 1`` pieces, one of which is equal. Each branching deals a class
   to a node per piece. As fingerprints of classes are distinct, nodes shrink until they are small, whatever the input: no
   pair is lost and no node is compared in more than ``NODE ** 2`` steps.
4. A node hands on one link per member, not its pairs, and the connected components of the links are the result.

Defined results: a document without words (NULL, empty, white space) has the fingerprint zero and is linked like any other; fewer than
three words are one shingle; repeated shingles count as often as they stand; a bit that exactly half of the values have is 0; rows
that share a doc_id are one document, which belongs to the classes of all its texts; a NULL doc_id is linked with nothing and has
a NULL component; an empty table gives an empty result. Invalid UTF-8 is hashed as the bytes it is. Texts of any length are read in
windows of ``WINDOW`` bytes. Only ``doc_id`` and ``text`` are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import landed, shuffle_parts, travels
from corpusloom.llm.components import components

WORDS, SEED, RADIUS = 3, 42, 3
SEGMENTS, BITS = 4, 64
NODE = 2048  # classes that are compared with each other
WINDOW = 1 << 18
SPACE = b" \t\n\x0b\x0c\r"
HOT_SHARE = 1000  # a class of more than this part of all rows is hot, so there are fewer hot classes than this

travels(__name__)


# Fingerprints -------------------------------------------------------------------------------------------------------


def windows(text: bytes, size: int = WINDOW) -> Iterator[list[bytes]]:
    """The words of a text in lists, one list per window of about ``size`` bytes; a window ends between words."""
    at = 0
    while at < len(text):
        end = at + size
        while end < len(text) and text[end] not in SPACE:
            end += 1
        yield text[at:end].split()  # of bytes: ASCII white space alone
        at = end


def shingle_hashes(text: bytes) -> Iterator[np.ndarray]:
    """The hashes of all shingles, one array per window; a window goes on with the last words of the one before it."""
    held: list[bytes] = []
    none = True
    for words in windows(text.lower()):  # of bytes: A-Z alone
        held += words
        if len(held) < WORDS:
            continue
        none = False
        joined = b" ".join(held)
        sizes = np.fromiter(map(len, held), np.int64, len(held))
        ends = np.cumsum(sizes + 1) - 1
        starts = (ends - sizes)[: 1 - WORDS].tolist()
        hashed = [xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, ends[WORDS - 1 :].tolist(), strict=True)]
        yield np.array(hashed, np.uint64)
        held = held[1 - WORDS :]
    if none and held:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(held), SEED)], np.uint64)


def fingerprint(text: bytes) -> int:
    """The bits that more than half of the hashes have, as a signed integer."""
    counts, total = np.zeros(BITS, np.int64), 0
    for hashed in shingle_hashes(text):
        for at in range(0, len(hashed), 1 << 14):
            rows = hashed[at : at + (1 << 14)].astype(">u8").view(np.uint8)
            counts += np.unpackbits(rows).reshape(-1, BITS).sum(axis=0, dtype=np.int64)
        total += len(hashed)
    return int(np.packbits(2 * counts > total).view(">i8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """Rows ``(doc_id, print)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(text.as_py() or b"") for text in batch.column(1)]
            yield pa.record_batch([batch.column(0), pa.array(prints, pa.int64())], ["doc_id", "print"])

    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, print bigint")


# Nodes --------------------------------------------------------------------------------------------------------------


def segment_masks() -> list[int]:
    """The bits of the segments, in ring order."""
    width = BITS // SEGMENTS
    return [((1 << width) - 1) << (width * i) for i in range(SEGMENTS)]


def chain_masks(first: int) -> list[tuple[int, int]]:
    """Bits and budget of the chains of two and more segments from a segment on; the last one is the full distance."""
    segments = segment_masks()
    chain, out = segments[first], []
    for k in range(2, SEGMENTS + 1):
        chain |= segments[(first + k - 1) % SEGMENTS]
        out.append((chain, k * RADIUS // SEGMENTS))
    return out


def next_pieces(first: int, fixed: int) -> list[int]:
    """Sets of bits, of which one at least is equal for every pair of a node whose fixed bits are ``fixed``.

    Directly after its first segment a node is cut by halves of the second segment, where one bit may differ at most.
    """
    segments = segment_masks()
    if fixed == segments[first]:
        free, parts = segments[(first + 1) % SEGMENTS], RADIUS * 2 // SEGMENTS + 1
    else:
        free, parts = ~fixed & ((1 << BITS) - 1), RADIUS + 1
    bits = [1 << b for b in range(BITS) if free >> b & 1]
    return [sum(bits[len(bits) * i // parts : len(bits) * (i + 1) // parts]) for i in range(parts)]


def hashed(*parts: np.ndarray) -> np.ndarray:
    """One 64-bit value per row of some columns."""
    value = np.zeros(len(parts[0]), np.uint64)
    for part in parts:
        value = (value ^ part) * np.uint64(0x9E3779B97F4A7C15)
        value ^= value >> np.uint64(29)
        value *= np.uint64(0xBF58476D1CE4E5B9)
        value ^= value >> np.uint64(32)
    return value


NODE_SCHEMA = "node bigint, first int, fixed bigint, print bigint, doc bigint"


def node_rows(node: np.ndarray, first: np.ndarray, fixed: np.ndarray, prints: np.ndarray, docs: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array(node.view(np.int64)), pa.array(first, pa.int32()), pa.array(fixed.view(np.int64)), pa.array(prints.view(np.int64)), pa.array(docs)]
    return pa.record_batch(columns, ["node", "first", "fixed", "print", "doc"])


def unsigned(batch: pa.RecordBatch, column: str) -> np.ndarray:
    return batch.column(column).to_numpy(zero_copy_only=False).view(np.uint64)


def roots(classes: DataFrame) -> DataFrame:
    """Every class ``(print, doc)`` in its four nodes, one per segment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints, docs = unsigned(batch, "print"), batch.column("doc").to_numpy(zero_copy_only=False)
            for first, mask in enumerate(segment_masks()):
                fixed = np.full(len(prints), mask, np.uint64)
                yield node_rows(hashed(fixed, prints & fixed), np.full(len(prints), first), fixed, prints, docs)

    return classes.select("print", "doc").mapInArrow(run, NODE_SCHEMA)


def branched(large: DataFrame) -> DataFrame:
    """The classes of large nodes in the nodes of the next level, one per piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces: dict[tuple[int, int], list[int]] = {}
        for batch in batches:
            parent, fixed, prints = (unsigned(batch, c) for c in ("node", "fixed", "print"))
            first, docs = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("first", "doc"))
            for start, mask in sorted(set(zip(first.tolist(), fixed.tolist()))):
                if (start, mask) not in pieces:
                    pieces[start, mask] = next_pieces(start, mask)
                own = (first == start) & (fixed == np.uint64(mask))
                for piece in pieces[start, mask]:
                    part, whole = np.full(own.sum(), piece, np.uint64), np.full(own.sum(), mask | piece, np.uint64)
                    yield node_rows(hashed(parent[own], part, prints[own] & part), first[own], whole, prints[own], docs[own])

    return large.mapInArrow(run, NODE_SCHEMA)


def linked_in_node(prints: np.ndarray, first: int) -> list[tuple[int, int]]:
    """For each connected group of a node, links of its members to its first member, by their places.

    A pair counts if each chain from the node's segment on keeps its budget; what a chain rejects is not looked at again.
    """
    chains = [(np.uint64(mask), budget) for mask, budget in chain_masks(first)]
    left, out = np.arange(len(prints)), []
    while len(left):
        root, left = left[0], left[1:]
        edge = [root]
        while edge and len(left):
            differs = prints[left] ^ prints[edge.pop()]
            near = np.arange(len(left))
            for mask, budget in chains:
                near = near[np.bitwise_count(differs[near] & mask) <= budget]
            if len(near):
                found = left[near].tolist()
                out += [(i, int(root)) for i in found]
                edge += found
                left = np.delete(left, near)
    return out


def compared(small: DataFrame) -> DataFrame:
    """Links ``(u, v)`` within nodes of at most ``NODE`` classes."""

    def links(held: list[pa.RecordBatch]) -> pa.RecordBatch | None:
        group = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        docs = group.column("doc").to_numpy(zero_copy_only=False)
        found = linked_in_node(unsigned(group, "print"), group.column("first")[0].as_py())
        if not found:
            return None
        u, v = np.array(found).T
        return pa.record_batch([pa.array(docs[u]), pa.array(docs[v])], ["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            nodes = batch.column("node").to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(nodes[1:] != nodes[:-1]) + 1).tolist(), len(nodes)]
            for a, b in zip(cuts, cuts[1:]):
                if held and b > a and held[-1].column("node")[0].as_py() != nodes[a]:
                    if sum(h.num_rows for h in held) > 1 and (found := links(held)) is not None:
                        yield found
                    held = []
                if b > a:
                    held.append(batch.slice(a, b - a))
        if sum(h.num_rows for h in held) > 1 and (found := links(held)) is not None:
            yield found

    parts = shuffle_parts(small.sparkSession)
    return small.repartition(parts, "node").sortWithinPartitions("node").mapInArrow(run, "u bigint, v bigint")


def print_links(classes: DataFrame) -> DataFrame:
    """Links between classes ``(print, doc)`` of distinct fingerprints, enough to connect all that are linked."""
    rows, found = landed(roots(classes), "nodes"), None
    while True:
        sizes = rows.groupBy("node").agg(F.count(F.lit(1)).alias("n"))
        large = landed(sizes.where(F.col("n") > NODE).select("node"), "large-nodes")
        # A large node stands here 16 times, so that its rows, however many, meet it in 16 tasks.
        salted = large.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(15)))).withColumn("large", F.lit(True))
        joined = rows.withColumn("salt", F.pmod(F.xxhash64("doc"), F.lit(16)).cast("int")).join(salted, ["node", "salt"], "left")
        names = ["node", "first", "fixed", "print", "doc"]
        if large.isEmpty():
            new = compared(rows)
            return new if found is None else found.unionByName(new)
        new = compared(joined.where("large is null").select(*names))
        found = new if found is None else found.unionByName(new)
        rows = landed(branched(joined.where("large").select(*names)), "nodes")


def grouped(docs: DataFrame) -> DataFrame:
    """Rows ``(doc_id, fingerprint, component_id)``, one per row of ``docs``; a fingerprint is 16 hexadecimal digits."""
    rows = landed(fingerprints(docs), "fingerprints")
    known = rows.where("doc_id is not null")
    classes = landed(known.groupBy("print").agg(F.min("doc_id").alias("doc"), F.count(F.lit(1)).alias("n")), "classes")
    # A doc_id that stands on several texts joins their classes.
    repeated = known.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id")
    shared = known.join(repeated, "doc_id").join(classes, "print").select(F.col("doc_id").alias("u"), F.col("doc").alias("v"))
    found = components(print_links(classes).unionByName(shared))
    root = classes.join(found, classes["doc"] == found["u"], "left").select("print", "n", F.coalesce("v", "doc").alias("component_id"))
    root = landed(root, "roots")
    total = known.count()
    hot = root.where(F.col("n") * HOT_SHARE > total).select("print", F.col("component_id").alias("often"))
    marked = rows.join(F.broadcast(hot), "print", "left")  # fewer than HOT_SHARE rows
    rare = marked.where("often is null and doc_id is not null").join(root.select("print", "component_id"), "print", "left")
    common = marked.where("often is not null or doc_id is null").withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.col("often")))
    names = ["doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"]
    return rare.select(*names).unionByName(common.select(*names))
