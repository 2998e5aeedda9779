"""Near-duplicates by chosen-path trees over minwise tokens, confirmed on whole shingle sets.

A document is the set of its distinct five-word shingles (hashed to 64 bits; A-Z lower-cased, words between white space). Two are
linked if ``100 * intersection >= percent * union``.

1. Each set becomes ``TOKENS`` minwise tokens. Equal sets are one class from here on, so exact copies cost nothing further.
2. Each of several trees deals the classes to nodes by its first token. Nodes of more than ``LEAF`` (classes, or as much text as so many
   of ``LONG`` shingles) branch by further tokens: all levels of their classes are counted at once, and a class goes to the first
   node on its path that is small. No two trees share a token.
3. Small nodes are compared exhaustively, first by their tokens (a pair whose tokens agree too rarely is not
   linked) and what remains by whole sets. A node hands on one link per member, not its pairs.
4. What no token divides are classes that agree in all tokens of their path. In the first trees, some members chosen by hash
   are compared with all others of such a node, in chunks. That finds the component of a large group of near copies.
5. The other trees are dealt once the links of the first are known. A node of one component is done, and its classes are not listed.
   A node need not branch if it is one component but for at most ``LEAF // 2`` classes. The others, and those that no token divides, are cut in blocks: the classes outside the largest
   component meet each other and each member of it, a pair of blocks being a small node. This is exact, and takes one pass.
6. Classes whose trees branched so often that a link may have been lost are dealt by further trees, with new tokens.
7. The links' connected components are the result. New links are added to the components found before as links between those.

A pair of similarity s is together in a node that n tokens lead to with probability ``s ** n``, so the trees miss it with the
product of their ``1 - s ** n``. Each class keeps that product for the similarity that is asked for, and is done when it is at
most ``TREE_MISS``. A pair is missed by the trees with at most twice that probability (either end may be done first), and by the
comparison of tokens in 3 with at most ``TOKEN_MISS``: 1 of 10,000 pairs at exactly the threshold in all, whatever the percent and
the depth. Later trees only look at nodes with documents of several components.

Defined results: documents without words are linked with nothing; fewer than five words are one shingle; rows that share a
doc_id are one document; rows with a NULL doc_id are linked with nothing and have a NULL component; an empty table gives an
empty result. Only ``doc_id`` and ``text`` are read, so other columns cannot clash.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import landed, shuffle_parts, travels
from corpusloom.llm.components import components

WORDS, PERCENT = 5, 85
TOKENS, LEAF = 64, 1024
LEVELS = 9  # a tree branches so often at most, and not more often than it has tokens
TREE_MISS, TOKEN_MISS = 4e-5, 2e-5  # recall of a pair: 1 - 2 * TREE_MISS - TOKEN_MISS
FIRST_TREES = 2  # trees that are compared before any link is known
LONG = 4096  # shingles; a longer text counts as several classes where the size of nodes is bounded
BROADCAST_ROWS = 1_000_000  # of two integers each, which take at most 100 bytes with their list
MOST_CACHED = 200_000

travels(__name__)


def factors(sketch: int) -> np.ndarray:
    """The hash functions of a sketch; those of different sketches have nothing in common."""
    seed = [85, sketch] if sketch else 85
    return np.random.default_rng(seed).integers(1 << 62, size=TOKENS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class Shingler:
    """Sorted sets of 64-bit shingle hashes; the hashes of recent words are kept."""

    def __init__(self) -> None:
        self.known: dict[bytes, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").encode("utf-8", "replace").lower().split()  # bytes: only A-Z change, only ASCII white space cuts
        new = set(words).difference(self.known)
        if len(self.known) + len(new) > MOST_CACHED:
            self.known.clear()
            new = set(words)
        self.known.update((w, xxhash.xxh3_64_intdigest(w)) for w in new)
        one = np.fromiter(map(self.known.__getitem__, words), dtype=np.uint64, count=len(words))
        if not len(one):
            return one
        size = min(WORDS, len(one))
        value = np.full(len(one) - size + 1, size, dtype=np.uint64)
        for k in range(size):
            value = (value ^ one[k : len(one) - size + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
            value ^= value >> np.uint64(29)
        value *= np.uint64(0xBF58476D1CE4E5B9)
        return np.unique(value ^ (value >> np.uint64(32)))


def minwise(values: np.ndarray, factor: np.ndarray) -> np.ndarray:
    """The smallest value of the set under each hash function."""
    least = np.full(TOKENS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(values), 2048):
        np.minimum(least, (values[at : at + 2048, None] * factor).min(axis=0), out=least)
    return (least >> np.uint64(33)).astype(np.int32)


def sketches(docs: DataFrame, sketch: int = 0) -> DataFrame:
    """Rows ``(doc_id, n_shingles, key, tokens)``; ``key`` stands for the whole set, and is NULL for an empty one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, factor = Shingler(), factors(sketch)
        for batch in batches:
            sizes, keys, tokens = [], [], []
            for text in batch.column(1):
                values = shingles(text.as_py())
                sizes.append(len(values))
                keys.append(xxhash.xxh3_128_digest(values.tobytes()) if len(values) else None)
                tokens.append(minwise(values, factor) if len(values) else None)
            columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(tokens, pa.list_(pa.int32()))]
            yield pa.record_batch(columns, ["doc_id", "n_shingles", "key", "tokens"])

    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id bigint, n_shingles bigint, key binary, tokens array<int>")


def in_groups(rows: DataFrame, key: str, function: Callable[[pa.Table], pa.RecordBatch | None], schema: str) -> DataFrame:
    """Apply a function to each group of rows. Groups must be small; many of them pass through one stream of batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(key).to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
            if held and held[-1].column(key)[0].as_py() != keys[0]:
                found = function(pa.Table.from_batches(held))
                held = []
                if found is not None:
                    yield found
            for a, b in zip(cuts, cuts[1:]):
                held.append(batch.slice(a, b - a))
                if b < len(keys):
                    found = function(pa.Table.from_batches(held))
                    held = []
                    if found is not None:
                        yield found
        if held and (found := function(pa.Table.from_batches(held))) is not None:
            yield found

    parts = shuffle_parts(rows.sparkSession)
    return rows.repartition(parts, key).sortWithinPartitions(key).mapInArrow(run, schema)


def log_miss(percent: int, tokens: int) -> float:
    """Logarithm of the probability that a tree parts a pair at the threshold on a path of so many tokens."""
    return math.log(max(1e-300, 1 - (percent / 100) ** tokens))


def trees_for(percent: int) -> int:
    """Trees of a sketch: enough for classes whose nodes need not branch once the first trees' links are known."""
    return min(TOKENS, FIRST_TREES + math.ceil(math.log(TREE_MISS) / log_miss(percent, 1)))


def weighed(rows: DataFrame, by: list[str]) -> DataFrame:
    """Number and weight of the classes of each group."""
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.sum("weight").alias("weight"))


def chunked(rows: DataFrame) -> DataFrame:
    """Large nodes ``(node, doc, weight)`` as small ones: chunks of their classes, each with the classes that are chosen by hash."""
    half = max(1, LEAF // 2)
    sizes = landed(weighed(rows, ["node"]), "sizes")
    chunks = F.ceil(F.col("size") / half)
    chosen = F.pmod(F.xxhash64("doc", F.lit(1)), 2 * chunks) == 0  # about a quarter of LEAF
    own, every = F.pmod(F.xxhash64("doc"), chunks), F.sequence(F.lit(0).cast("bigint"), chunks - 1)
    placed = rows.join(sizes.select("node", F.col("weight").alias("size")), "node")
    cut = placed.select("node", "doc", F.explode(F.when(chosen, every).otherwise(F.array(own))).alias("chunk"))
    return cut.select(F.xxhash64("node", "chunk").alias("node"), "doc")


def in_blocks(rows: DataFrame) -> DataFrame:
    """Large nodes ``(node, doc, root, weight)`` as small ones, which bring together all pairs but those of the largest component.

    A class outside it stands with each block of such classes, and with each block of the component's members.
    """
    half = max(1, LEAF // 2)
    counts = weighed(rows, ["node", "root"])
    mains = counts.groupBy("node").agg(F.sum("weight").alias("size"), F.max(F.struct("weight", "root")).alias("main"))
    others = F.col("size") - F.col("main.weight")
    mains = landed(mains.where(others > 0), "mains")
    placed = rows.join(mains, "node").withColumns(
        {
            "is_main": F.col("root") == F.col("main.root"),
            "outer": F.ceil(others / half),
            "inner": F.ceil(F.col("main.weight") / half),
        }
    )
    first = F.lit(0).cast("bigint")
    b = F.pmod(F.xxhash64("doc"), F.when(F.col("is_main"), F.col("inner")).otherwise(F.col("outer")))
    placed = placed.withColumn("b", b)
    among = F.transform(F.sequence(first, F.col("outer") - 1), lambda j: F.struct(F.least("b", j).alias("i"), F.greatest("b", j).alias("j")))
    # Blocks of members are numbered from -1 downwards.
    across = F.transform(F.sequence(first, F.col("inner") - 1), lambda j: F.struct(F.col("b").alias("i"), (-1 - j).alias("j")))
    member = F.transform(F.sequence(first, F.col("outer") - 1), lambda i: F.struct(i.alias("i"), (-1 - F.col("b")).alias("j")))
    cut = placed.select("node", "doc", F.explode(F.when(F.col("is_main"), member).otherwise(F.concat(among, across))).alias("at"))
    return cut.select(F.xxhash64("node", "at.i", "at.j").alias("node"), "doc")


def dealt(classes: DataFrame, trees: Sequence[int]) -> tuple[DataFrame, DataFrame | None]:
    """Rows ``(node, doc)`` of the small nodes that the first tokens of the trees give, and rows of the large ones.

    The latter are ``(node, tree, doc, root, weight, apart)``; ``apart`` says that the node is nearly one component. Nodes whose
    classes ``(doc, root, weight, tokens)`` are one component are done and left out.
    """
    roots = [F.struct(F.xxhash64(F.lit(t), F.get("tokens", F.lit(t))).alias("node"), F.lit(t).alias("tree")) for t in trees]
    rows = classes.select("doc", "root", "weight", F.explode(F.array(*roots)).alias("n")).select("n.node", "n.tree", "doc", "root", "weight")
    sizes = weighed(rows, ["node", "root"]).groupBy("node")
    sizes = sizes.agg(F.count(F.lit(1)).alias("parts"), F.sum("weight").alias("size"), F.max("weight").alias("main")).where("parts > 1")
    sizes = landed(sizes.select("node", "size", (F.col("size") - F.col("main") <= max(1, LEAF // 2)).alias("apart")), "sizes")
    rows = landed(rows.join(sizes, "node"), "nodes")
    large = rows.where(F.col("size") > LEAF).drop("size")
    return rows.where(F.col("size") <= LEAF).select("node", "doc"), None if large.isEmpty() else large


def divided(large: DataFrame, classes: DataFrame, percent: int, linked: bool) -> tuple[DataFrame, DataFrame | None, DataFrame]:
    """Rows ``(node, doc)`` of the small nodes below large ones, and ``(node, doc, weight)`` of nodes that no token is left for.

    Also rows ``(doc, more)``: what its branchings add to a class's ``log_miss``. ``classes`` are ``(doc, root, weight, tokens)``; ``linked``
    says that some links are known, in which case those nodes are cut in blocks and not returned.
    """
    many, half = trees_for(percent), max(1, LEAF // 2)
    levels = 1 + min(LEVELS, TOKENS // many - 1)
    top, settled = large, None
    if linked:
        # What is nearly one component needs no further level.
        settled, top = large.where("apart").select("node", "doc", "root", "weight"), large.where("not apart")
    top = top.join(classes.select("doc", "tokens"), "doc")
    path = [F.col("node")]
    for level in range(1, levels):
        path.append(F.xxhash64(path[-1], F.get("tokens", F.col("tree") + level * many)))
    paths = landed(top.select("doc", "root", "weight", F.array(*path).alias("path"), path[-1].alias("leaf")), "paths")
    # Every level below the large node. What is done stays so further down, so the last open level gives where a class's path ends.
    deep = paths.select("doc", "root", "weight", "leaf", F.posexplode(F.slice("path", 2, levels)).alias("level", "node"))
    nodes = weighed(deep, ["node", "root"]).groupBy("node").agg(
        F.sum("n").alias("n"), F.sum("weight").alias("size"), F.max("weight").alias("main")
    )
    small = F.col("size") <= LEAF
    apart = F.col("size") - F.col("main") <= half if linked else F.lit(False)
    nodes = landed(nodes.select("node", "n", small.alias("small"), (small | apart).alias("done")), "path-nodes")
    last = deep.join(nodes.where("not done").select("node"), "node").groupBy("doc", "leaf").agg(F.max("level").alias("last"))
    level = F.coalesce(F.col("last") + 2, F.lit(1))
    found = paths.distinct().join(last, ["doc", "leaf"], "left").select("doc", "root", "weight", "path", level.alias("level"))
    found = landed(found.select("doc", "root", "weight", "level", F.get("path", F.least("level", F.lit(levels - 1))).alias("node")), "path-ends")
    ends = landed(found.where(F.col("level") < levels).join(nodes.select("node", "n", "small"), "node"), "ends")
    rest = found.where(F.col("level") == levels).withColumn("level", F.lit(levels - 1))
    leaves = ends.where("small and n > 1").select("node", "doc")
    added = F.array(*[F.lit(log_miss(percent, i + 1) - log_miss(percent, 1)) for i in range(levels)])
    more = ends.select("doc", "level").unionByName(rest.select("doc", "level")).where("level > 0").select("doc", F.get(added, "level").alias("more"))
    cut = ends.where("not small").select("node", "doc", "root", "weight")
    if linked:
        whole = settled.unionByName(cut).unionByName(rest.select("node", "doc", "root", "weight"))
        return leaves.unionByName(in_blocks(whole)), None, more
    return leaves.unionByName(chunked(rest.select("node", "doc", "weight"))), rest.select("node", "doc", "weight"), more


def agreeing(percent: int) -> int:
    """Tokens of a linked pair that agree, at the least: fewer do with a probability of at most ``TOKEN_MISS``."""
    p, least, below = percent / 100, 0, 0.0
    while least < TOKENS and (below := below + math.comb(TOKENS, least) * p**least * (1 - p) ** (TOKENS - least)) <= TOKEN_MISS:
        least += 1
    return max(1, least)


def likely(leaves: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The rows of small nodes whose tokens agree often enough with those of a class of another component there."""
    least = agreeing(percent)

    def run(group: pa.Table) -> pa.RecordBatch | None:
        group = group.combine_chunks()
        if group.num_rows < 2:
            return None
        tokens = group.column("tokens").chunk(0).flatten().to_numpy().reshape(-1, TOKENS)
        root = group.column("root").to_numpy()
        some = np.zeros(len(root), dtype=bool)
        for i in range(len(root)):
            some[i] = (((tokens == tokens[i]).sum(axis=1) >= least) & (root != root[i])).any()
        if not some.any():
            return None
        kept = group.select(["node", "doc"]).filter(pa.array(some)).combine_chunks()
        return kept.to_batches()[0]

    rows = leaves.join(classes.select("doc", "root", "tokens"), "doc").select("node", "doc", "root", "tokens")
    return in_groups(rows, "node", run, "node bigint, doc bigint")


def linked_pairs(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Boolean matrix: which sets are linked."""
    n = len(sets)
    common = np.zeros((n, n), dtype=np.int64)
    if n <= 4:
        for i in range(n):
            for j in range(i + 1, n):
                common[i, j] = common[j, i] = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
    else:
        owner = np.repeat(np.arange(n), [len(s) for s in sets])
        values, place, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        shared = often[place] > 1
        owner, place = owner[shared], np.unique(place[shared], return_inverse=True)[1]
        order = np.argsort(place, kind="stable")
        owner, place = owner[order], place[order]
        total = int(place[-1]) + 1 if len(place) else 0
        for at in range(0, total, 4096):
            a, b = np.searchsorted(place, (at, at + 4096))
            block = np.zeros((n, min(4096, total - at)), dtype=np.float32)
            block[owner[a:b], place[a:b] - at] = 1
            common += (block @ block.T).astype(np.int64)  # counts below 4,096 are exact in single precision
    size = np.array([len(s) for s in sets])
    found = 100 * common >= percent * (size[:, None] + size[None, :] - common)
    np.fill_diagonal(found, False)
    return found


def stars(docs: np.ndarray, found: np.ndarray) -> list[tuple[int, int]]:
    """For each connected group of a link matrix, links of its members to the smallest."""
    left, out = set(range(len(docs))), []
    while left:
        group, edge = set(), [left.pop()]
        while edge:
            i = edge.pop()
            group.add(i)
            new = left.intersection(np.flatnonzero(found[i]).tolist())
            left -= new
            edge += new
        least = min(docs[i] for i in group)
        out += [(int(docs[i]), int(least)) for i in group if docs[i] != least]
    return out


def with_texts(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """Add the text to landed rows ``(doc, …)`` of integers. Up to a checked number of them, and so of bytes, they are broadcast, and
    texts move once, to their node."""
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc"), F.col("text").cast("string").alias("text"))
    rest = [c for c in rows.columns if c != "doc"]
    places = rows.groupBy("doc").agg(F.collect_list(F.struct(*rest)).alias("places"))
    if rows.count() <= BROADCAST_ROWS:
        places = F.broadcast(places)
    return texts.join(places, "doc").select("doc", "text", F.explode("places").alias("p")).select("doc", "text", "p.*")


def leaf_links(rows: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """Links ``(u, v)`` within small nodes ``(node, doc)``, on whole sets."""

    def compare(group: pa.Table) -> pa.RecordBatch | None:
        if group.num_rows < 2:
            return None
        shingles = Shingler()
        sets = [shingles(t) for t in group.column("text").to_pylist()]
        some = [i for i, s in enumerate(sets) if len(s)]
        links = stars(group.column("doc").to_numpy()[some], linked_pairs([sets[i] for i in some], percent)) if some else []
        if not links:
            return None
        return pa.record_batch([pa.array([x[0] for x in links], pa.int64()), pa.array([x[1] for x in links], pa.int64())], ["u", "v"])

    return in_groups(with_texts(rows, docs), "node", compare, "u bigint, v bigint")


def joined_components(found: DataFrame | None, new: DataFrame) -> DataFrame:
    """Components ``(u, root)`` after new links: those are first drawn between the components known so far."""
    if found is None:
        return components(new)
    for side in ("u", "v"):
        known = found.select(F.col("u").alias(side), F.col("v").alias("known"))
        new = new.join(known, side, "left").withColumn(side, F.coalesce("known", side)).drop("known")
    between = landed(new.where("u <> v").select("u", "v").distinct(), "between")
    if between.isEmpty():
        return found
    joined = components(between)
    moved = found.join(joined.select(F.col("u").alias("v"), F.col("v").alias("to")), "v", "left").select("u", F.coalesce("to", "v").alias("v"))
    return landed(moved.unionByName(joined), "components")


def rooted(classes: DataFrame, found: DataFrame | None) -> DataFrame:
    """The classes with the component they are in so far."""
    if found is None:
        return classes.withColumn("root", F.col("doc"))
    known = found.select(F.col("u").alias("doc"), F.col("v").alias("known"))
    return landed(classes.join(known, "doc", "left").withColumn("root", F.coalesce("known", "doc")).drop("known"), "roots")


def links(docs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Components ``(u, v)`` of the links between classes ``(doc, weight, tokens)``; ``v`` is the smallest of ``u``'s component."""
    if percent < 1:
        raise ValueError("percent must be 1 or more")
    trees, found, sketch = trees_for(percent), None, 0
    missed = classes.select("doc", F.lit(0.0).alias("miss"))
    while True:
        more = []

        def compared(leaves: DataFrame, roots: DataFrame, found: DataFrame | None) -> DataFrame:
            rows = landed(likely(leaves, roots, percent), "likely")
            return joined_components(found, landed(leaf_links(rows, docs, percent), "links"))

        begun, undivided = found is None, None
        roots = rooted(classes, found)
        if begun:
            leaves, large = dealt(roots, range(FIRST_TREES))
            if large is not None:
                below, undivided, deeper = divided(large, roots, percent, False)
                leaves, more = leaves.unionByName(below), [deeper]
            found = compared(leaves, roots, None)
            roots = rooted(classes, found)
        # The other trees, of which only nodes of several components are left.
        leaves, large = dealt(roots, range(FIRST_TREES if begun else 0, trees))
        if large is not None:
            below, _, deeper = divided(large, roots, percent, True)
            leaves = leaves.unionByName(below)
            more.append(deeper)
        if undivided is not None:
            # Of these nodes of the first trees only chosen members were compared.
            leaves = leaves.unionByName(in_blocks(undivided.join(roots.select("doc", "root").distinct(), "doc")))
        found = compared(leaves, roots, found)
        every = trees * log_miss(percent, 1)
        if not more and every <= math.log(TREE_MISS):
            return found
        for rows in more:
            missed = missed.unionByName(rows.withColumnRenamed("more", "miss"))
        # Each row of a class that has several counts in full, which errs on the side of more trees.
        missed = missed.groupBy("doc").agg((F.sum("miss") + every).alias("miss"))
        missed = landed(missed.where(F.col("miss") > math.log(TREE_MISS)), "missed")
        if missed.isEmpty():
            return found
        sketch += 1
        texts = with_texts(missed, docs).select(F.col("doc").alias("doc_id"), "text")
        again = sketches(texts, sketch).where("key is not null")
        classes = landed(again.select(F.col("doc_id").alias("doc"), weight().alias("weight"), "tokens").distinct(), "classes")


def weight() -> Column:
    """As how many classes a text of ``n_shingles`` counts."""
    return F.greatest(F.lit(1).cast("bigint"), F.ceil(F.col("n_shingles") / LONG))


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Rows ``(doc_id, n_shingles, component_id, kept)``, one per row of ``docs``."""
    rows = landed(sketches(docs), "sketches")
    members = rows.where("doc_id is not null and key is not null")
    classes = members.groupBy("key").agg(F.min(F.struct("doc_id", "n_shingles", "tokens")).alias("s"))
    classes = landed(classes.select("key", "s.*").select("key", F.col("doc_id").alias("doc"), weight().alias("weight"), "tokens"), "classes")
    found = links(docs, classes.select("doc", "weight", "tokens"), percent)
    # A doc_id that stands on several texts links their classes.
    reps = landed(members.select("doc_id", "key").join(classes.select("key", "doc"), "key").select("doc_id", "doc").distinct(), "reps")
    twice = reps.groupBy("doc_id").agg(F.min("doc").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1")
    joined = reps.join(twice, "doc_id").select(F.col("doc").alias("u"), F.col("least").alias("v"))
    if not joined.isEmpty():
        found = joined_components(found, joined)
    root = found.select(F.col("u").alias("doc"), F.col("v").alias("root"))
    ids = reps.join(root, "doc", "left").groupBy("doc_id").agg(F.min(F.coalesce("root", "doc")).alias("component_id"))
    out = rows.select("doc_id", "n_shingles").join(ids, "doc_id", "left")
    out = out.withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
