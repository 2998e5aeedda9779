"""Byte-level BPE: word counts, training of merges, encoding and decoding.

During training every symbol is one character, so a word is a string and the order of pairs is the order of strings. The word
table stays on the cluster; the driver ranks a bounded number of pairs and receives a bounded number of stretches where they overlap.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators.ordering import first_n
from corpusloom.session import scratch_path

# Fixed value: the published GPT-2 pre-tokenization pattern.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# Reserved tokens, in id order.
RESERVED_TOKENS = ("<|pad|>", "<|bos|>", "<|end|>", "<|user|>", "<|assistant|>", "<|system|>")

# Tokens that loading adds when the vocabulary has no token for the part.
DEFAULT_SPECIALS = (("pad", "<|pad|>"), ("bos", "<|startoftext|>"), ("eos", "<|endoftext|>"))

VOCAB_SIZE = 32_768
MIN_FREQUENCY = 2
SYMBOL_BASE = 0x100  # character of id 0; the others follow in order, past the surrogates
SURROGATES = range(0xD800, 0xE000)
SYMBOL_LIMIT = 0x110000 - SYMBOL_BASE - len(SURROGATES)
SAMPLE_SIZE = 1_000_000
PAIRS_AT_FIRST = 32  # that the first round takes
PAIRS_PER_ROUND = 2048  # that a round takes at most
CHAINS = 50_000  # stretches of words that the driver receives in a round, at most
CANDIDATES = 65_536  # pairs that the driver ranks during training
FIRST_SNAPSHOT = 1024  # merges, after which the word table is written anew; sooner at first
ROUND_TASKS = 4  # that add up the changed pairs of a round
BLOCK_SYMBOLS = 2_000_000  # that a task works on at once
SEPARATOR = ord("\n")  # between the words of a block; no symbol
INDEXED_LENGTH = 64  # characters of a word whose ids are kept while encoding
CACHED_WORDS = 200_000  # each with its ids, per task
SLICED_WORDS = 250_000  # words, and characters by eight, that are turned into ids at once


def byte_characters() -> list[str]:
    """The visible character that stands for each byte in a token's name.

    Printable Latin-1 bytes stand for themselves; the others take the code points from 256 on, in byte order.
    """
    shown, spare = [], 256
    for byte in range(256):
        if 33 <= byte <= 126 or 161 <= byte <= 255 and byte != 173:
            shown.append(chr(byte))
        else:
            shown.append(chr(spare))
            spare += 1
    return shown


def symbol(token_id: int) -> str:
    """The character that stands for a token during training; characters sort like ids."""
    point = SYMBOL_BASE + token_id
    return chr(point if point < SURROGATES.start else point + len(SURROGATES))


def symbol_id(character: str) -> int:
    point = ord(character)
    return point - SYMBOL_BASE - (len(SURROGATES) if point >= SURROGATES.stop else 0)


@dataclass
class Vocabulary:
    """A trained vocabulary: reserved tokens, byte symbols, ranked merges, and tokens that were added after training.

    Its size is bounded by ``VOCAB_SIZE``.
    """

    merges: list[tuple[int, int]]
    reserved: tuple[str, ...] = RESERVED_TOKENS
    added: tuple[str, ...] = ()
    names: list[str] = field(init=False)
    data: list[bytes] = field(init=False)

    def __post_init__(self):
        shown = byte_characters()
        by_name = sorted(range(256), key=lambda b: shown[b])
        self.names = [*self.reserved, *[shown[b] for b in by_name]]
        self.data = [*[t.encode() for t in self.reserved], *[bytes([b]) for b in by_name]]
        for left, right in self.merges:
            self.names.append(self.names[left] + self.names[right])
            self.data.append(self.data[left] + self.data[right])
        self.names += self.added
        self.data += [t.encode() for t in self.added]

    def special_ids(self) -> dict[str, int]:
        """Tokens that stand for themselves in a text."""
        first = len(self.names) - len(self.added)
        return {t: i for i, t in enumerate(self.reserved)} | {t: first + i for i, t in enumerate(self.added)}

    def with_specials(self, assigned: Sequence[str] = (), defaults: Sequence[tuple[str, str]] = DEFAULT_SPECIALS) -> Vocabulary:
        """The vocabulary with the defaults of the parts that have no token yet, as ``ensure_specials`` adds them."""
        new = [t for part, t in defaults if part not in assigned and t not in self.names]
        return Vocabulary(self.merges, self.reserved, (*self.added, *new))

    def byte_ids(self) -> list[int]:
        """Id of every byte."""
        first = len(self.reserved)
        ids = {self.data[i][0]: i for i in range(first, first + 256)}
        return [ids[b] for b in range(256)]

    def vocab_frame(self, spark: SparkSession) -> DataFrame:
        special = set(self.special_ids().values())
        rows = [(n, i, i in special) for i, n in enumerate(self.names)]
        return spark.createDataFrame(rows, "token string, id int, special boolean")

    def merges_frame(self, spark: SparkSession) -> DataFrame:
        rows = [(r, self.names[a], self.names[b]) for r, (a, b) in enumerate(self.merges)]
        return spark.createDataFrame(rows, "rank int, left string, right string")

    def tokenizer_json(self) -> str:
        """The vocabulary as a tokenizer file of the public ``tokenizers`` format."""
        byte_level = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
        flags = {"single_word": False, "lstrip": False, "rstrip": False, "normalized": False, "special": True}
        return json.dumps(
            {
                "version": "1.0",
                "truncation": None,
                "padding": None,
                "added_tokens": [{"id": i, "content": t, **flags} for t, i in self.special_ids().items()],
                "normalizer": None,
                "pre_tokenizer": byte_level,
                "post_processor": None,
                "decoder": byte_level,
                "model": {
                    "type": "BPE",
                    "dropout": None,
                    "unk_token": None,
                    "continuing_subword_prefix": "",
                    "end_of_word_suffix": "",
                    "fuse_unk": False,
                    "byte_fallback": False,
                    "ignore_merges": False,
                    "vocab": {n: i for i, n in enumerate(self.names)},
                    "merges": [[self.names[a], self.names[b]] for a, b in self.merges],
                },
            },
            ensure_ascii=False,
        )

    def config_json(self) -> str:
        # The tokenizer settings that go with the file.
        return json.dumps(
            {
                "model_type": "gpt2",
                "tokenizer_class": "PreTrainedTokenizerFast",
                "pad_token": "<|pad|>",
                "bos_token": "<|bos|>",
                "eos_token": "<|end|>",
                "unk_token": "<unk>",
            },
            indent=2,
        )


def save_vocabulary(vocabulary: Vocabulary, spark: SparkSession, path: str) -> None:
    """Vocabulary and merges as tables, and both tokenizer files as text, below ``path``."""
    vocabulary.vocab_frame(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/vocab")
    vocabulary.merges_frame(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/merges")
    for name, content in (("tokenizer", vocabulary.tokenizer_json()), ("tokenizer_config", vocabulary.config_json())):
        spark.createDataFrame([(content,)], "value string").coalesce(1).write.mode("overwrite").option(
            "lineSep", "\n"
        ).text(f"{path}/{name}.json")


def load_vocabulary(spark: SparkSession, path: str) -> Vocabulary:
    """A vocabulary that ``save_vocabulary`` wrote. Its tables have at most ``VOCAB_SIZE`` rows."""
    rows = sorted((r["id"], r["token"], r["special"]) for r in spark.read.parquet(f"{path}/vocab").collect())
    ids = {token: i for i, token, _ in rows}
    merges = [(ids[r["left"]], ids[r["right"]]) for r in spark.read.parquet(f"{path}/merges").orderBy("rank").collect()]
    leading = next((i for i, (_, _, special) in enumerate(rows) if not special), len(rows))
    reserved = tuple(token for _, token, _ in rows[:leading])
    return Vocabulary(merges, reserved, tuple(token for _, token, special in rows[leading:] if special))


# Training -----------------------------------------------------------------------------------------------------------


def split_words(text: str | Column, pattern: str = WORD_PATTERN) -> Column:
    """Pre-tokens of a text. White space is Unicode white space."""
    return F.regexp_extract_all(text, F.lit("(?U)" + pattern), F.lit(0))


def word_counts(texts: DataFrame, column: str = "text", pattern: str = WORD_PATTERN) -> DataFrame:
    """How often each pre-token occurs: counted on the map side first, then once per distinct word."""
    return texts.select(F.explode(split_words(column, pattern)).alias("word")).groupBy("word").agg(
        F.count(F.lit(1)).alias("freq")
    )


def as_symbols(word: Column, byte_ids: Sequence[int]) -> Column:
    """The word's UTF-8 bytes, one symbol character each."""
    symbols = F.array(*[F.lit(symbol(i)) for i in byte_ids])
    digits = F.regexp_extract_all(F.hex(F.encode(word, "UTF-8")), F.lit(".."), F.lit(0))
    return F.array_join(F.transform(digits, lambda d: F.get(symbols, F.conv(d, 16, 10).cast("int"))), "")


def pair_counts(words: DataFrame, symbols: str = "symbols", freq: str = "freq") -> DataFrame:
    """Weighted counts of adjacent symbol pairs; a pair is a string of two symbols."""
    listed = words.select(F.explode(_pairs(symbols)).alias("pair"), F.col(freq).alias("freq"))
    return listed.groupBy("pair").agg(F.sum("freq").alias("freq"))


def _pairs(symbols: str) -> Column:
    """All adjacent pairs of a word of symbols."""
    places = F.sequence(F.lit(1), F.length(symbols) - 1)
    return F.when(F.length(symbols) > 1, F.transform(places, lambda i: F.substring(F.col(symbols), i, F.lit(2))))


def independent_prefix(pairs: Sequence[str], room: int) -> list[str]:
    """The longest head of the ranked pairs that may be merged in one round with the result of merging one at a time.

    As long as no symbol is the right half of one pair and the left half of another, the pairs of the head never overlap
    in a word, so no merge changes the count of another one. A pair that a merge creates is at most as frequent as some
    old pair behind the head and loses ties to it by its larger id. A pair of equal symbols may create a frequent pair
    of itself, so the head ends after it.
    """
    chosen, lefts, rights = [], set(), set()
    for left, right in pairs[:room]:
        if left in rights or right in lefts:
            break
        chosen.append(left + right)
        lefts.add(left)
        rights.add(right)
        if left == right:
            break
    return chosen


def settled_merges(ranked: Sequence[tuple[str, int]], chains: Sequence[tuple[str, int]], first: int, room: int, min_frequency: int) -> list[str]:
    """The merges, one at a time, up to the rank of the last of the ranked pairs; new symbols are numbered from ``first``.

    ``chains`` are the stretches of words in which ranked pairs overlap, with how often they occur. A merge changes the count of
    another ranked pair only where the two overlap, and a pair that it creates beside a ranked one is whole in the chains too. Any
    other pair that it creates takes the place of an old pair behind the last one, is at most as frequent and loses ties to
    it by its larger id, so no pair that is unknown here comes before the last one.
    """
    counts = dict(ranked)
    last = (-ranked[-1][1], ranked[-1][0])
    words = [text for text, _ in chains]
    holding: dict[str, set[int]] = {}
    for i, word in enumerate(words):
        for pair in map(str.__add__, word, word[1:]):
            holding.setdefault(pair, set()).add(i)
    heap = sorted((-n, pair) for pair, n in ranked)
    merges: list[str] = []
    while heap and len(merges) < room:
        n, pair = heapq.heappop(heap)
        if counts.get(pair) != -n:
            continue  # an outdated entry
        if (n, pair) > last or -n < min_frequency:
            break
        new = symbol(first + len(merges))
        merges.append(pair)
        changed = set()
        for i in holding.pop(pair, ()):
            old, freq = words[i], chains[i][1]
            words[i] = now = old.replace(pair, new)
            for p in map(str.__add__, old, old[1:]):
                counts[p] = counts.get(p, 0) - freq
                changed.add(p)
            for p in map(str.__add__, now, now[1:]):
                counts[p] = counts.get(p, 0) + freq
                changed.add(p)
                if new in p:
                    holding.setdefault(p, set()).add(i)
        del counts[pair]
        for p in changed:
            if counts.get(p, 0) > 0:
                heapq.heappush(heap, (-counts[p], p))
    return merges


class RankedPairs:
    """The best pairs with their counts, ranked by count and then by pair: ``CANDIDATES`` of them, and at most twice that.

    ``behind`` is the rank up to which they are complete (None: there are no others). Counts of old pairs only fall, and a pair that
    a merge creates has its whole count at once, so no pair behind that rank gets before it unnoticed.
    """

    def __init__(self, found: list[tuple[str, int]], complete: bool) -> None:
        self.counts = dict(found)
        self.heap = sorted((-n, pair) for pair, n in found)
        self.behind = None if complete else self.heap[-1]

    def change(self, deltas: list[tuple[str, int]]) -> None:
        for pair, delta in deltas:
            now = self.counts.get(pair, 0) + delta
            if now > 0 and (pair in self.counts or delta > 0) and (self.behind is None or (-now, pair) <= self.behind):
                self.counts[pair] = now
                heapq.heappush(self.heap, (-now, pair))
            else:
                self.counts.pop(pair, None)
        if len(self.counts) > 2 * CANDIDATES or len(self.heap) > 8 * CANDIDATES:
            self.heap = sorted((-n, pair) for pair, n in self.counts.items())
            if len(self.heap) > 2 * CANDIDATES:
                self.heap = self.heap[:CANDIDATES]
                self.behind = self.heap[-1]
            self.counts = {pair: -n for n, pair in self.heap}

    def best(self, wanted: int, min_frequency: int) -> list[tuple[str, int]]:
        """The pairs that rank first, with their counts."""
        best: list[tuple[int, str]] = []
        while self.heap and len(best) < wanted:
            n, pair = heapq.heappop(self.heap)
            if self.counts.get(pair) == -n and (not best or best[-1][1] != pair):  # an entry may be outdated or stand twice
                best.append((n, pair))
                if -n < min_frequency:
                    break
        for entry in best:
            heapq.heappush(self.heap, entry)
        return [(pair, -n) for n, pair in best if -n >= min_frequency]

    def short(self) -> bool:
        """Whether pairs must be counted again: few are left, and there are others."""
        return self.behind is not None and len(self.counts) <= CANDIDATES // 16


def numbered_merges(merges: Sequence[str], first: int, end: int, size: int) -> list[tuple[int, int, int]]:
    """Some of the merges as code points ``(left, right, new symbol)``; ``size`` is the number of tokens before any merge."""
    return [(ord(merges[i][0]), ord(merges[i][1]), ord(symbol(size + i))) for i in range(first, end)]


def word_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The words of a task in stretches of about ``BLOCK_SYMBOLS``: their symbols as code points, with a separator before, between
    and after the words, and how often each word occurs."""
    words: list[str] = []
    freqs: list[np.ndarray] = []
    long = 0

    def block() -> tuple[np.ndarray, np.ndarray]:
        text = f"\n{'\n'.join(words)}\n"
        return np.frombuffer(text.encode("utf-32-le"), np.int32), np.concatenate(freqs)

    for batch in batches:
        some = batch.column(0).to_pylist()
        words += some
        freqs.append(batch.column(1).to_numpy(zero_copy_only=False))
        long += sum(map(len, some))
        if long >= BLOCK_SYMBOLS:
            yield block()
            words, freqs, long = [], [], 0
    if words:
        yield block()


def pair_codes(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return left.astype(np.int64) << 32 | right


def pair_code(pair: str) -> int:
    return ord(pair[0]) << 32 | ord(pair[1])


def words_of(points: np.ndarray) -> np.ndarray:
    """The number of the word that each symbol of a block is in."""
    return np.cumsum(points == SEPARATOR, dtype=np.int32) - 1


def among(codes: np.ndarray, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of a block where one of some distinct pairs begins, and which one it is."""
    size = int(max(points.max(), (codes >> 32).max(), (codes & 0xFFFFFFFF).max())) + 1
    starts, ends = np.zeros(size, bool), np.zeros(size, bool)
    starts[codes >> 32], ends[codes & 0xFFFFFFFF] = True, True
    near = np.flatnonzero(starts[points[:-1]] & ends[points[1:]])
    order = np.argsort(codes)
    found = pair_codes(points[near], points[near + 1])
    at = order[np.minimum(np.searchsorted(codes, found, sorter=order), len(codes) - 1)]
    hit = codes[at] == found
    return near[hit], at[hit]


def merged_block(
    points: np.ndarray, merges: Sequence[tuple[int, int, int]], changed: Callable[[np.ndarray, np.ndarray, np.ndarray, int], None] | None = None
) -> np.ndarray:
    """A block's symbols after some merges in order, from left to right within a word.

    Symbols are linked, and the places of the pairs are listed once, so a merge costs by the places it is made at. ``changed``
    gets the pairs that a merge takes (-1) and makes (1): place, left and right symbol.
    """
    if not merges:
        return points
    codes = np.array([a << 32 | b for a, b, _ in merges], np.int64)
    near, number = among(codes, points)
    by = np.argsort(number, kind="stable")
    near, bounds = near[by], np.searchsorted(number[by], np.arange(len(merges) + 1))
    made = {new for _, _, new in merges}
    rank = {code: i for i, code in enumerate(codes.tolist())}
    uses: dict[int, set[int]] = {}
    for a, b, _ in merges:
        for part in {a, b} & made:
            uses.setdefault(part, set()).add(a << 32 | b)
    later: dict[int, list[np.ndarray]] = {}  # places of pairs that came up on the way
    symbols = points.copy()  # 0: part of the symbol before
    after = np.arange(1, len(points) + 1, dtype=np.int32)
    before = np.arange(-1, len(points) - 1, dtype=np.int32)
    for i, (a, b, new) in enumerate(merges):
        place = near[bounds[i] : bounds[i + 1]]
        if i in later:
            place = np.unique(np.concatenate([place, *later.pop(i)]))
        place = place[symbols[place] == a]
        other = after[place]
        both = symbols[other] == b
        place, other = place[both], other[both]
        if a == b and len(place) > 1:  # of a run, every second pair
            here = np.arange(len(place))
            run = np.maximum.accumulate(np.where(np.concatenate([[True], place[1:] != other[:-1]]), here, 0))
            place, other = place[(here - run) % 2 == 0], other[(here - run) % 2 == 0]
        if not len(place):
            continue
        if changed:
            links = np.unique(np.concatenate([before[place], place, other]))
            changed(links, symbols[links], symbols[after[links]], -1)
        behind = after[other]
        symbols[place], symbols[other] = new, 0
        after[place], before[behind] = behind, place
        if changed or new in uses:
            links = np.unique(np.concatenate([before[place], place]))
            left, right = symbols[links], symbols[after[links]]
            if changed:
                changed(links, left, right, 1)
            if new in uses:
                found = pair_codes(left, right)
                for code in uses[new]:
                    some = links[found == code]
                    if len(some):
                        later.setdefault(rank[code], []).append(some)
    return symbols[symbols > 0]


def paired(codes: np.ndarray, weights: np.ndarray, name: str) -> pa.RecordBatch:
    """Sums of weights by pair, but zeros, as rows of the pair's string and the sum."""
    pairs, place = np.unique(codes, return_inverse=True)
    total = np.bincount(place, weights, len(pairs)).astype(np.int64)  # whole numbers far below 2 ** 53
    some = np.flatnonzero(total)
    names = [chr(c >> 32) + chr(c & 0xFFFFFFFF) for c in pairs[some].tolist()]
    return pa.record_batch([pa.array(names, pa.string()), pa.array(total[some], pa.int64())], ["pair", name])


def brought_up(words: DataFrame, merges: Sequence[tuple[int, int, int]]) -> DataFrame:
    """The word table after some merges, without the words that are a single symbol by now."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for points, freq in word_blocks(batches):
            now = merged_block(points, merges).tobytes().decode("utf-32-le")[1:-1].split("\n")
            for first in range(0, len(now), 10_000):
                part = slice(first, first + 10_000)
                yield pa.record_batch([pa.array(now[part], pa.string()), pa.array(freq[part], pa.int64())], ["symbols", "freq"])

    return words.mapInArrow(run, "symbols string, freq bigint").where(F.length("symbols") > 1)


def all_pairs(words: DataFrame, merges: Sequence[tuple[int, int, int]]) -> DataFrame:
    """Counts ``(pair, freq)`` of all pairs after some merges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for points, freq in word_blocks(batches):
            now = merged_block(points, merges)
            inside = (now[:-1] != SEPARATOR) & (now[1:] != SEPARATOR)
            weights = freq[words_of(now)[:-1][inside]]
            yield paired(pair_codes(now[:-1][inside], now[1:][inside]), weights, "freq")

    return words.mapInArrow(run, "pair string, freq bigint").groupBy("pair").agg(F.sum("freq").alias("freq"))


def overlaps(words: DataFrame, merges: Sequence[tuple[int, int, int]], pairs: Sequence[str]) -> DataFrame:
    """Stretches of words, after some merges, in which two or more of some pairs overlap: ``(chain, freq)``."""
    codes = np.array([pair_code(p) for p in pairs], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for points, freq in word_blocks(batches):
            now = merged_block(points, merges)
            hit = np.zeros(len(now) + 1, bool)
            hit[among(codes, now)[0]] = True
            hit[:-1] &= np.concatenate([[False], hit[:-2]]) | hit[1:]
            inside = hit[:-1] | np.concatenate([[False], hit[:-2]])
            place = np.flatnonzero(inside)
            if not len(place):
                continue
            ends = ~hit[place]
            out = np.full(len(place) + int(ends.sum()), SEPARATOR, np.int32)
            out[np.arange(len(place)) + np.cumsum(ends) - ends] = now[place]
            chains = out.tobytes().decode("utf-32-le")[:-1].split("\n")
            rows = pa.table({"chain": pa.array(chains, pa.string()), "freq": freq[words_of(now)[place[ends]]]})
            rows = rows.group_by("chain").aggregate([("freq", "sum")]).select(["chain", "freq_sum"])
            yield from rows.rename_columns(["chain", "freq"]).to_batches(10_000)

    return words.mapInArrow(run, "chain string, freq bigint").groupBy("chain").agg(F.sum("freq").alias("freq"))


def count_changes(
    words: DataFrame, before: Sequence[tuple[int, int, int]], head: Sequence[tuple[int, int, int]], known: Sequence[str]
) -> DataFrame:
    """How the counts of new pairs and of some known old ones change when a head is merged after others: rows ``(pair, delta)``."""
    wanted = np.array(sorted(pair_code(p) for p in known), np.int64)
    new = min(made for _, _, made in head)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for points, freq in word_blocks(batches):
            now = merged_block(points, before)
            weights = freq[np.minimum(words_of(now), len(freq) - 1)]
            codes, deltas = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]

            def changed(place: np.ndarray, left: np.ndarray, right: np.ndarray, sign: int) -> None:
                inside = (left != SEPARATOR) & (right != SEPARATOR)
                pairs = pair_codes(left[inside], right[inside])
                old = (left[inside] < new) & (right[inside] < new)
                kept = ~old
                kept[old] = wanted[np.minimum(np.searchsorted(wanted, pairs[old]), len(wanted) - 1)] == pairs[old]
                codes.append(pairs[kept])
                deltas.append(sign * weights[place[inside][kept]])

            merged_block(now, head, changed)
            yield paired(np.concatenate(codes), np.concatenate(deltas), "delta")

    changes = words.mapInArrow(run, "pair string, delta bigint").groupBy("pair").agg(F.sum("delta").alias("delta"))
    return changes.where("delta <> 0")


def train_merges(
    words: DataFrame,
    vocab_size: int = VOCAB_SIZE,
    min_frequency: int = MIN_FREQUENCY,
    reserved: Sequence[str] = RESERVED_TOKENS,
) -> Vocabulary:
    """Merges from a table ``word, freq``: each time the most frequent pair, ties to the smaller left, then right id.

    A round makes hundreds of merges in two jobs that write nothing. The first returns the stretches of words in which the pairs
    that rank first overlap; with them the driver settles the merges up to the last of these pairs. The second returns how these
    merges change the counts. Stretches are at most ``CHAINS``; if there are more, the round makes the merges that need none,
    and the next one takes fewer pairs. Whenever enough merges were made, the word table is written anew, which is the only
    state, and in the shared folder. The driver holds the merges and the best pairs.
    """
    if vocab_size > SYMBOL_LIMIT:
        raise ValueError(f"vocab_size may be at most {SYMBOL_LIMIT}")
    spark = words.sparkSession
    base = Vocabulary([], tuple(reserved))
    size = len(base.names)
    folder = scratch_path(spark, "merges")
    table = _dealt(words).select(as_symbols(F.col("word"), base.byte_ids()).alias("symbols"), "freq")
    # Rounds are small jobs: what they move fits a few tasks, and planning it anew at runtime costs more than it saves.
    rounds = spark.newSession()
    rounds.conf.set("spark.sql.adaptive.enabled", "false")
    rounds.conf.set("spark.sql.shuffle.partitions", str(ROUND_TASKS))
    rounds.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    since, ranked, wanted = 0, None, PAIRS_AT_FIRST  # the merges that the table has seen, and the pairs of a round
    table = _landed(table, f"{folder}/0")
    current = rounds.read.schema(table.schema).parquet(f"{folder}/0")
    merges: list[str] = []
    while (done := len(merges)) < vocab_size - size:
        if done - since >= min(FIRST_SNAPSHOT, max(PAIRS_AT_FIRST, since)):
            table = _landed(brought_up(table, numbered_merges(merges, since, done, size)), f"{folder}/{done}")
            current, since = rounds.read.schema(table.schema).parquet(f"{folder}/{done}"), done
        before = numbered_merges(merges, since, done, size)
        if ranked is None or ranked.short():
            counts = all_pairs(table, before).where(F.col("freq") >= min_frequency)
            found = [tuple(r) for r in counts.orderBy(F.col("freq").desc(), "pair").limit(CANDIDATES).collect()]
            if not found:
                break
            ranked = RankedPairs(found, len(found) < CANDIDATES)
        best = ranked.best(wanted, min_frequency)
        if not best:
            if ranked.behind is None:
                break
            ranked = None
            continue
        room = vocab_size - size - done
        chains = [tuple(r) for r in overlaps(current, before, [p for p, _ in best]).limit(CHAINS + 1).collect()]
        if len(chains) > CHAINS:
            head, wanted = independent_prefix([p for p, _ in best], room), max(1, len(best) // 2)
        else:
            head = settled_merges(best, chains, size + done, room, min_frequency)
            wanted = min(PAIRS_PER_ROUND, 2 * wanted) if 4 * len(chains) <= CHAINS else wanted
        merges += head
        changed = count_changes(current, before, numbered_merges(merges, done, len(merges), size), list(ranked.counts))
        if ranked.behind is not None:
            n, pair = -ranked.behind[0], ranked.behind[1]
            changed = changed.where((F.col("delta") < 0) | (F.col("delta") > n) | ((F.col("delta") == n) & (F.col("pair") <= pair)))
        ranked.change([tuple(r) for r in changed.collect()])
    return Vocabulary([(symbol_id(p[0]), symbol_id(p[1])) for p in merges], tuple(reserved))


def _landed(df: DataFrame, path: str) -> DataFrame:
    """The frame as a table in the shared folder, which ends its lineage and outlives any executor."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _dealt(words: DataFrame) -> DataFrame:
    """Words dealt out evenly, since the size of the table has little to do with that of the corpus.

    Words of a single byte have no pairs and are left out. Spark filters before it counts, so the filter is a cheap one on the word.
    """
    spark = words.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return words.where(F.octet_length("word") > 1).repartition(tasks, "word")


def train_vocabulary(
    texts: DataFrame,
    column: str = "text",
    key: str | None = None,
    sample_size: int = SAMPLE_SIZE,
    pattern: str = WORD_PATTERN,
    **options,
) -> Vocabulary:
    """Merges from texts: from all of them, or from the first ``sample_size`` by an order key."""
    sample = texts if key is None else first_n(texts, sample_size, key)
    return train_merges(word_counts(sample, column, pattern), **options)


# Special tokens -----------------------------------------------------------------------------------------------------


def ensure_specials(
    vocab: DataFrame, assigned: dict[str, str] | None = None, defaults: Sequence[tuple[str, str]] = DEFAULT_SPECIALS
) -> DataFrame:
    """Vocabulary with a token for each of pad, bos and eos.

    ``assigned`` names the parts that already have a token. For each other part its default is used, and appended after
    the largest id if the vocabulary does not contain it yet.
    """
    assigned = assigned or {}
    wanted = [(i, token) for i, (part, token) in enumerate(defaults) if part not in assigned]
    if not wanted:
        return vocab
    spark = vocab.sparkSession
    names = [token for _, token in wanted]
    seen = vocab.agg(F.max("id").alias("top"), F.collect_set(F.when(F.col("token").isin(names), F.col("token"))).alias("present")).first()
    top, present = -1 if seen["top"] is None else seen["top"], set(seen["present"])
    missing = [token for _, token in wanted if token not in present]
    if not missing:
        return vocab.withColumn("special", F.col("special") | F.col("token").isin(names))
    added = spark.createDataFrame(
        [(token, top + 1 + i, True) for i, token in enumerate(missing)], "token string, id bigint, special boolean"
    )
    marked = vocab.withColumn("special", F.col("special") | F.col("token").isin(names))
    return marked.unionByName(added.withColumn("id", F.col("id").cast(vocab.schema["id"].dataType)))


def pad_or_eos(pad_id: Column, eos_id: Column) -> Column:
    """The padding id: that of pad, or of eos where there is none."""
    return F.coalesce(pad_id, eos_id)


def vocab_size_check(vocab: DataFrame, declared: int) -> DataFrame:
    """Compare the declared size with the number of tokens; the actual number is adopted."""
    return vocab.agg(F.count(F.lit(1)).alias("actual"), F.max("id").alias("max_id")).select(
        F.lit(declared).cast("bigint").alias("declared"),
        "actual",
        "max_id",
        (F.col("actual") != declared).alias("resized"),
        F.col("actual").alias("adopted"),
    )


# Encoding -----------------------------------------------------------------------------------------------------------


def merge_word(symbols: list[int], ranks: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """Apply merges ``pair -> (rank, new symbol)`` to one word, lowest rank first and from left to right.

    Pairs wait in a heap and symbols are linked, so a long word costs its length times a logarithm.
    """
    size = len(symbols)
    word: list[int | None] = list(symbols)
    after, before = list(range(1, size + 1)), list(range(-1, size - 1))
    heap = [(ranks[p][0], i) for i, p in enumerate(zip(symbols, symbols[1:])) if p in ranks]
    heapq.heapify(heap)
    while heap:
        rank, i = heapq.heappop(heap)
        j = after[i]
        if word[i] is None or j >= size:
            continue
        found = ranks.get((word[i], word[j]))
        if found is None or found[0] != rank:
            continue  # one of the two was merged meanwhile
        word[i], word[j], after[i] = found[1], None, after[j]
        if after[i] < size:
            before[after[i]] = i
        for left in (before[i], i):
            if left >= 0 and after[left] < size and (new := ranks.get((word[left], word[after[left]]))):
                heapq.heappush(heap, (new[0], left))
    return [s for s in word if s is not None]


def encode(
    texts: DataFrame,
    vocabulary: Vocabulary,
    max_length: int | None = None,
    column: str = "text",
    keep: Sequence[str] = (),
    pattern: str = WORD_PATTERN,
) -> DataFrame:
    """``input_ids`` cut to ``max_length``, ``attention_mask`` and the uncut number of tokens ``n_tokens``.

    Words are split by Spark; an Arrow stage looks up each distinct word of a stretch of rows and keeps what it learned for the
    task. The stage is narrow: no shuffle. Reserved tokens in a text become their ids.
    """
    spark = texts.sparkSession
    first = len(vocabulary.reserved) + 256
    tables = spark.sparkContext.broadcast(
        (
            vocabulary.byte_ids(),
            {pair: (rank, first + rank) for rank, pair in enumerate(vocabulary.merges)},
            vocabulary.special_ids(),
        )
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        byte_ids, ranks, reserved = tables.value
        known: dict[str, list[int]] = {}

        def ids_of(word: str) -> list[int]:
            found = known.get(word)
            if found is None:
                if word in reserved:
                    found = [reserved[word]]
                else:
                    found = merge_word([byte_ids[b] for b in word.encode()], ranks)
                if len(known) >= CACHED_WORDS:
                    known.clear()
                if len(word) <= INDEXED_LENGTH:
                    known[word] = found
            return found

        for batch in batches:
            for part in sliced(batch, batch.num_columns - 1):
                ids, sizes = batch_ids(part.column(part.num_columns - 1), ids_of, max_length)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(sizes), ids], names)

    words = texts.select(*keep, split_reserved(column, list(vocabulary.special_ids()), pattern).alias("__words"))
    kept = "".join(f"`{c}` {texts.schema[c].dataType.simpleString()}, " for c in keep)
    names = [*keep, "n_tokens", "input_ids"]
    coded = words.mapInArrow(run, f"{kept}n_tokens bigint, input_ids array<int>")
    return coded.withColumn("attention_mask", F.array_repeat(F.lit(1), F.size("input_ids")))


def sliced(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Stretches of a batch that hold about ``SLICED_WORDS`` words in a list column, or one row.

    Working memory follows the number of ids of a stretch, and not the size of Spark's batches.
    """
    words = batch.column(column)
    counts = words.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    long = np.concatenate([[0], np.cumsum(pc.binary_length(words.flatten()).to_numpy(zero_copy_only=False).astype(np.int64))])
    ends = np.cumsum(counts)
    weights = ends + long[ends] // 8
    first = 0
    while first < batch.num_rows:
        before = weights[first - 1] if first else 0
        after = max(first + 1, int(np.searchsorted(weights, before + SLICED_WORDS, "right")))
        yield batch.slice(first, after - first)
        first = after


def batch_ids(
    words: pa.ListArray, ids_of: Callable[[str], list[int]], max_length: int | None
) -> tuple[pa.ListArray, np.ndarray]:
    """Token ids of lists of words, cut to ``max_length``, and the uncut numbers of tokens.

    Each distinct word is looked up once; the rest is index arithmetic on whole columns.
    """
    coded = words.flatten().dictionary_encode()
    pieces = [ids_of(w) for w in coded.dictionary.to_pylist()]
    place = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = np.array([len(p) for p in pieces], np.int64)
    table = np.array([i for p in pieces for i in p], np.int32)
    starts = np.cumsum(sizes) - sizes
    per_word = sizes[place] if len(place) else np.zeros(0, np.int64)
    ends = np.cumsum(per_word)
    total = int(ends[-1]) if len(ends) else 0
    ids = table[np.repeat(starts[place] - (ends - per_word), per_word) + np.arange(total)] if total else table[:0]
    counts = words.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
    lengths = np.diff(bounds)
    kept = lengths if max_length is None else np.minimum(lengths, max_length)
    if max_length is not None and total:
        ids = ids[np.arange(total) - np.repeat(bounds[:-1], lengths) < max_length]
    offsets = np.concatenate([[0], np.cumsum(kept)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids, pa.int32())), lengths


def split_reserved(column: str, reserved: Sequence[str], pattern: str = WORD_PATTERN) -> Column:
    """Pre-tokens in which each reserved token stands alone, between separately split stretches of text."""
    if not reserved:
        return split_words(column, pattern)
    names = "|".join(f"\\Q{t}\\E" for t in reserved)
    has_any = F.col(column).rlike(names)
    stretches = F.split(column, f"(?<={names})|(?={names})")
    by_stretch = F.flatten(
        F.transform(
            stretches,
            lambda s: F.when(s.isin(*reserved), F.array(s)).otherwise(split_words(s, pattern)),
        )
    )
    return F.when(has_any, by_stretch).otherwise(split_words(column, pattern))


def decode(ids: Column, vocabulary: Vocabulary, skip_special: bool = True) -> Column:
    """Text of token ids; malformed byte sequences become the replacement character. Stays inside the JVM."""
    # One string that the optimizer turns into a literal array, rather than one expression per token.
    table = F.split(F.lit(",".join(b.hex() for b in vocabulary.data)), ",")
    if skip_special:
        first, end = len(vocabulary.reserved), len(vocabulary.data) - len(vocabulary.added)
        ids = F.filter(ids, lambda i: (i >= first) & (i < end))
    digits = F.array_join(F.transform(ids, lambda i: F.get(table, i)), "")
    return F.call_function("make_valid_utf8", F.unhex(digits).cast("string"))
