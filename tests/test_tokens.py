import json
import random
import time

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusloom.operators import batching as b
from corpusloom.operators import tokens as k

TRICKY = [
    "a<|user|>\nhi  <|end|><|end|> x<|pad|", "", " ", "\n\n  tab\t x", "it's we'll don't I'M", "été 12３4 😀😀 日本語。",
    "​a b c", "<|system|>", "aaaaaaa", "á ë", "\x1c\x1f x", "x" * 300 + " " * 50,
]


@pytest.fixture(scope="module")
def corpus(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    extra = spark.createDataFrame([(10_000 + i, t) for i, t in enumerate(TRICKY)], "doc_id bigint, text string")
    return docs.unionByName(extra)


@pytest.fixture(scope="module")
def learned(corpus):
    return k.train_vocabulary(corpus, vocab_size=400)


@pytest.fixture(scope="module")
def library(corpus):
    from tokenizers import ByteLevelBPETokenizer

    made = ByteLevelBPETokenizer()
    texts = [x.text for x in corpus.orderBy("doc_id").collect()]
    made.train_from_iterator(texts, vocab_size=400, min_frequency=2, special_tokens=list(k.RESERVED_TOKENS))
    return made


def test_vocabulary_equals_the_library(learned, library):
    assert len(learned.merges) == 138
    assert {n: i for i, n in enumerate(learned.names)} == library.get_vocab()


def test_distinct_words(spark):
    assert k.word_counts(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")).count() == 24719


def test_encoding_equals_the_library(corpus, learned, library):
    rows = k.encode(corpus, learned, keep=["text"]).collect()
    assert len(rows) == corpus.count()
    for x in rows:
        assert x.input_ids == library.encode(x.text).ids
        assert x.n_tokens == len(x.input_ids) and x.attention_mask == [1] * len(x.input_ids)


def test_truncation(corpus, learned):
    whole = {x.doc_id: x for x in k.encode(corpus, learned, keep=["doc_id"]).collect()}
    for x in k.encode(corpus, learned, 16, keep=["doc_id"]).collect():
        assert x.input_ids == whole[x.doc_id].input_ids[:16] and x.n_tokens == whole[x.doc_id].n_tokens
        assert len(x.attention_mask) == len(x.input_ids) <= 16


def test_memory_of_encoding_follows_stretches_of_rows(monkeypatch):
    """A batch of any size is coded in stretches, with the same ids."""
    words = [["a", "bc"] * 50, [], None, ["d" * 900], ["a"], ["e"] * 7]
    batch = pa.record_batch([pa.array(range(6)), pa.array(words, pa.list_(pa.string()))], ["key", "words"])
    monkeypatch.setattr(k, "SLICED_WORDS", 100)
    for part in (batch, batch.slice(1, 4)):
        cut = list(k.sliced(part, 1))
        assert sum(x.num_rows for x in cut) == part.num_rows and len(cut) > 1
        assert pa.Table.from_batches(cut) == pa.Table.from_batches([part])
        coded = [k.batch_ids(x.column(1), lambda w: [ord(c) for c in w], 5) for x in cut]
        ids, sizes = k.batch_ids(part.column(1), lambda w: [ord(c) for c in w], 5)
        assert [r for x, _ in coded for r in x.to_pylist()] == ids.to_pylist()
        assert [n for _, x in coded for n in x.tolist()] == sizes.tolist()
    assert list(k.sliced(batch.slice(0, 0), 1)) == []


def test_decoding(corpus, learned, library):
    rows = k.encode(corpus, learned, keep=["text"])
    got = rows.select(
        "text", "input_ids", k.decode(F.col("input_ids"), learned).alias("plain"),
        k.decode(F.col("input_ids"), learned, skip_special=False).alias("whole"),
    ).collect()
    for x in got:
        assert x.whole == x.text
        assert x.plain == library.decode(x.input_ids, skip_special_tokens=True)


def test_decoding_cut_characters(spark):
    plain = k.Vocabulary([])
    df = k.encode(spark.createDataFrame([("aé",)], "text string"), plain, 2)
    assert df.select(k.decode(F.col("input_ids"), plain)).first()[0] == "a�"


def one_at_a_time(words, size, min_frequency=2):
    """Merges by the rule itself: count, take the best pair, rewrite, repeat."""
    base = k.Vocabulary([])
    ids = base.byte_ids()
    table = {tuple(ids[c] for c in w.encode()): f for w, f in words.items()}
    merges, new = [], len(base.names)
    while new < size:
        counts = {}
        for symbols, freq in table.items():
            for pair in zip(symbols, symbols[1:]):
                counts[pair] = counts.get(pair, 0) + freq
        counts = {p: c for p, c in counts.items() if c >= min_frequency}
        if not counts:
            break
        best = min(counts, key=lambda p: (-counts[p], p))
        rewritten = {}
        for symbols, freq in table.items():
            out = tuple(k.merge_word(list(symbols), {best: (0, new)}))
            rewritten[out] = rewritten.get(out, 0) + freq
        table, new = rewritten, new + 1
        merges.append(best)
    return merges


@pytest.mark.parametrize("seed", range(4))
def test_rounds_equal_single_merges(spark, seed):
    rng = random.Random(seed)
    words = {"".join(rng.choice("abcé"[: 2 + seed]) for _ in range(rng.randint(1, 9))): rng.randint(1, 4) for _ in range(40)}
    df = spark.createDataFrame(list(words.items()), "word string, freq bigint")
    assert k.train_merges(df, vocab_size=262 + 30).merges == one_at_a_time(words, 262 + 30)


@pytest.mark.parametrize("limits", [{"CANDIDATES": 40}, {"CANDIDATES": 12, "FIRST_SNAPSHOT": 20}, {"INDEXED_LENGTH": 3}])
def test_bounded_ranking_and_snapshots_change_nothing(spark, monkeypatch, limits):
    """Few pairs at the driver, frequent snapshots and words that are not indexed: the merges stay those of the rule."""
    for name, value in limits.items():
        monkeypatch.setattr(k, name, value)
    rng = random.Random(5)
    words = {"".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 12))): rng.randint(1, 30) for _ in range(120)}
    words["a" * 40] = 3
    df = spark.createDataFrame(list(words.items()), "word string, freq bigint")
    assert k.train_merges(df, vocab_size=262 + 60).merges == one_at_a_time(words, 262 + 60)


@pytest.mark.parametrize("limits", [{}, {"BLOCK_SYMBOLS": 50, "CHAINS": 6}, {"PAIRS_PER_ROUND": 3, "PAIRS_AT_FIRST": 1}])
def test_rounds_of_overlapping_pairs(spark, monkeypatch, limits):
    """A round settles pairs that overlap in words, so a vocabulary takes few rounds, and the merges stay those of the rule."""
    for name, value in limits.items():
        monkeypatch.setattr(k, name, value)
    rounds = []
    plain = k.count_changes
    monkeypatch.setattr(k, "count_changes", lambda *x: rounds.append(len(x[2])) or plain(*x))
    rng = random.Random(9)
    words = {"".join(rng.choice("abcdé") for _ in range(rng.randint(1, 14))): rng.randint(1, 30) for _ in range(150)}
    words |= {"a" * n: n for n in range(2, 12)} | {"ab" * 9: 2}
    df = spark.createDataFrame(list(words.items()), "word string, freq bigint").repartition(3)
    assert k.train_merges(df, vocab_size=262 + 80).merges == one_at_a_time(words, 262 + 80)
    assert sum(rounds) == 80 and (limits or len(rounds) <= 8), rounds


def test_words_are_counted_before_they_become_symbols(spark, corpus, monkeypatch):
    """Spark moves filters below a count, so none of them may spell out the symbols of every single word."""
    plans = []
    plain = k._landed
    monkeypatch.setattr(k, "_landed", lambda df, path: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or plain(df, path))
    k.train_vocabulary(corpus, vocab_size=263)
    filters = [line for line in plans[0].splitlines() if "Filter" in line]
    assert "conv(" in plans[0] and not any("conv(" in line for line in filters), plans[0]


def test_blocks_are_merged_like_words():
    rng = random.Random(3)
    for _ in range(60):
        words = ["".join(rng.choice("\u0106\u0107\u0108") for _ in range(rng.randint(1, 9))) for _ in range(12)]
        merges = []
        for i in range(9):
            pair = rng.choice("\u0106\u0107\u0108" + "".join(n for _, n in merges)) + rng.choice("\u0106\u0107\u0108" + "".join(n for _, n in merges))
            if pair not in [p for p, _ in merges]:
                merges.append((pair, chr(0x200 + i)))
        want = "\n".join(words)
        for pair, new in merges:
            want = want.replace(pair, new)
        batch = pa.record_batch([pa.array(words), pa.array([1] * 12)], ["symbols", "freq"])
        ((points, _),) = k.word_blocks([batch])
        got = k.merged_block(points, [(ord(p[0]), ord(p[1]), ord(n)) for p, n in merges])
        assert got.tobytes().decode("utf-32-le")[1:-1] == want


def test_training_ends_where_no_pair_is_left(spark):
    df = spark.createDataFrame([("abab", 5), ("x", 9), ("yz", 1)], "word string, freq bigint")
    assert k.train_merges(df).merges == one_at_a_time({"abab": 5, "x": 9, "yz": 1}, 400)
    assert k.train_merges(df.limit(0)).merges == []


def test_a_large_vocabulary_equals_the_library(spark, monkeypatch):
    """Thousands of merges, one by one the library's, with a ranking that is cut and filled again on the way."""
    from tokenizers import ByteLevelBPETokenizer

    monkeypatch.setattr(k, "CANDIDATES", 1000)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    mine = k.train_vocabulary(docs, vocab_size=900)
    library = ByteLevelBPETokenizer()
    library.train_from_iterator([x.text for x in docs.collect()], vocab_size=900, min_frequency=2, special_tokens=list(k.RESERVED_TOKENS))
    assert {n: i for i, n in enumerate(mine.names)} == library.get_vocab()
    listed = json.loads(library.to_str())["model"]["merges"]
    pairs = [tuple(x) if isinstance(x, list) else tuple(x.split(" ")) for x in listed]
    assert [(mine.names[a], mine.names[b]) for a, b in mine.merges] == pairs and len(pairs) == 638


def test_independent_prefix():
    assert k.independent_prefix(["ab", "cb", "ad", "bc"], 9) == ["ab", "cb", "ad"]
    assert k.independent_prefix(["ab", "cd", "aa"], 9) == ["ab", "cd"]
    assert k.independent_prefix(["aa", "cd"], 9) == ["aa"]
    assert k.independent_prefix(["ab", "cd", "ef"], 2) == ["ab", "cd"]
    assert k.independent_prefix([], 5) == []


def test_symbols_sort_like_ids():
    ids = [0, 5, 261, 5000, k.SURROGATES.start - k.SYMBOL_BASE - 1, k.SURROGATES.start - k.SYMBOL_BASE, 200_000]
    symbols = [k.symbol(i) for i in ids]
    assert symbols == sorted(symbols) and [k.symbol_id(s) for s in symbols] == ids
    assert [s.encode() for s in symbols] == sorted(s.encode() for s in symbols)


def test_tokenizer_files(spark, corpus, learned, tmp_path):
    from tokenizers import Tokenizer

    k.save_vocabulary(learned, spark, str(tmp_path / "v"))
    text = "\n".join(x.value for x in spark.read.text(str(tmp_path / "v" / "tokenizer.json")).collect())
    loaded = Tokenizer.from_str(text)
    for x in k.encode(corpus, learned, keep=["text"]).limit(40).collect():
        assert loaded.encode(x.text).ids == x.input_ids
    assert spark.read.parquet(str(tmp_path / "v" / "merges")).count() == 138
    vocab = spark.read.parquet(str(tmp_path / "v" / "vocab"))
    assert [x.token for x in vocab.where("special").orderBy("id").collect()] == list(k.RESERVED_TOKENS)
    assert json.loads(learned.config_json())["eos_token"] == "<|end|>"


def test_specials(spark):
    vocab = spark.createDataFrame([("<|bos|>", 0, True), ("x", 7, False)], "token string, id int, special boolean")
    got = k.ensure_specials(vocab, {"bos": "<|bos|>"}).orderBy("id").collect()
    assert [(x.token, x.id) for x in got] == [("<|bos|>", 0), ("x", 7), ("<|pad|>", 8), ("<|endoftext|>", 9)]
    everything = {"pad": "x", "bos": "<|bos|>", "eos": "x"}
    assert k.ensure_specials(vocab, everything).count() == 2
    pad = spark.createDataFrame([(None, 9), (3, 9)], "pad int, eos int")
    assert [x[0] for x in pad.select(k.pad_or_eos(F.col("pad"), F.col("eos"))).collect()] == [9, 3]


def test_vocab_size(spark):
    vocab = spark.createDataFrame([("a", 0), ("b", 5)], "token string, id int")
    assert tuple(k.vocab_size_check(vocab, 2).first()) == (2, 2, 5, False, 2)
    assert k.vocab_size_check(vocab, 3).first().resized


# Batches ------------------------------------------------------------------------------------------------------------


def sequences(spark, lengths, partitions=4):
    rows = [(i * 5, list(range(10, 10 + n))) for i, n in enumerate(lengths)]
    return spark.createDataFrame(rows, "key bigint, input_ids array<int>").repartition(partitions)


def test_collate(spark):
    df = b.collate(b.fixed_batches(sequences(spark, [3, 9, 5, 1]), 3, ["key"]), pad_id=0)
    rows = {x.key: x for x in df.collect()}
    assert [rows[i].width for i in (0, 5, 10, 15)] == [16, 16, 16, 8]
    assert rows[0].input_ids == [10, 11, 12] + [0] * 13
    assert rows[0].attention_mask == [1] * 3 + [0] * 13
    assert rows[0].labels == [10, 11, 12] + [-100] * 13


def test_collate_ignores_pad_ids_in_labels(spark):
    df = b.collate(b.fixed_batches(sequences(spark, [3]), 3, ["key"]), pad_id=11)
    assert df.first().labels == [10, -100, 12] + [-100] * 5


def test_ids_are_joined_without_strings_for_each(spark):
    """Long arrays become text at once, as the plain way writes them."""
    from corpusloom.plans import adapters as a

    rows = [([1, -100, 0, 2147483647, -2147483648],), ([],), (None,), ([7],), (list(range(5000)),)]
    df = spark.createDataFrame(rows, "ids array<int>")
    wide = df.select(F.col("ids").cast("array<bigint>").alias("ids"))
    for some in (df, wide):
        got = some.select(a.joined_ids("ids").alias("x"), a.joined_ids(F.col("ids")).alias("y"))
        assert "as array<string>" not in got._jdf.queryExecution().optimizedPlan().toString()
        want = [None if ids is None else ",".join(map(str, ids)) for ids, in rows]
        assert [tuple(r) for r in got.collect()] == [(w, w) for w in want]


def test_labels_are_searched_only_where_the_pad_id_occurs(spark):
    plain, padded = [(5 * i, list(range(10, 10 + i))) for i in (3, 9)], [(50, [0, 4, 0])]
    df = spark.createDataFrame([*plain, *padded, (60, [])], "key bigint, input_ids array<int>")
    got = b.collate(b.fixed_batches(df, 4, ["key"]), 0)
    rows = {x.key: x.labels for x in got.collect()}
    want = {key: [-100 if i == 0 else i for i in ids] for key, ids in [*plain, *padded, (60, [])]}
    assert rows == {key: ids + [-100] * (16 - len(ids)) for key, ids in want.items()}
    assert "array_contains" in got._jdf.queryExecution().optimizedPlan().toString()


def test_grouped_collate_is_the_same(spark):
    batches = b.fixed_batches(sequences(spark, [3, 9, 5, 1, 0]), 2, ["key"])
    flat = b.collate(batches, 0).orderBy("key").collect()
    for x in b.collate_groups(batches, 0).collect():
        assert x.input_ids == [y.input_ids for y in flat if y.batch_id == x.batch_id]


@pytest.mark.parametrize("rows_per_bucket", [None, 10])
def test_batches(spark, rows_per_bucket):
    rows = b.fixed_batches(sequences(spark, [1] * 50), 8, ["key"], rows_per_bucket=rows_per_bucket).collect()
    assert sorted((x.batch_id * 8 + x.place, x.key) for x in rows) == [(i, i * 5) for i in range(50)]


@pytest.mark.parametrize("length, rows_per_bucket", [(7, None), (7, 5), (1, 9), (1000, None)])
def test_packing(spark, length, rows_per_bucket):
    lengths = [3, 0, 40, 1, 7, 6, 20, 13, 2, 2, 5]
    got = sorted(b.pack(sequences(spark, lengths), length, end_id=2, rows_per_bucket=rows_per_bucket).collect())
    stream = [t for n in lengths for t in [*range(10, 10 + n), 2]]
    assert [t for x in got for t in x.input_ids] == stream
    assert [x.chunk for x in got] == list(range(len(got)))
    assert all(len(x.input_ids) == length for x in got[:-1])
    whole = b.pack(sequences(spark, lengths), length, end_id=2, keep_last=False)
    assert whole.count() == len(stream) // length


def id_exchanges(df):
    """Exchanges of the plan that carry token arrays."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "Exchange " in line and "BroadcastExchange" not in line], plan


@pytest.mark.parametrize("length, parts", [(1, 8), (7, 8), (64, 3), (100_000, 8)])
def test_packing_of_long_and_short_sequences(spark, length, parts):
    """Sequences over many tasks, some ending with a chunk, against one list; each is moved once."""
    rng = random.Random(length)
    lengths = [rng.choice([0, 1, length - 1, 2 * length - 1, rng.randrange(40)]) for _ in range(60)] + [900, 0, 6]
    if length > 1000:
        lengths = [n % 5000 for n in lengths]
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        packed = b.pack(sequences(spark, lengths), length, end_id=2)
        exchanges, plan = id_exchanges(packed)
        got = sorted(packed.collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)
    stream = [t for n in lengths for t in [*range(10, 10 + n), 2]]
    assert [x.input_ids for x in got] == [stream[i : i + length] for i in range(0, len(stream), length)]
    assert [x.chunk for x in got] == list(range(len(got)))
    # The test's own repartition, and one for all that follows.
    assert len(exchanges) == 2, plan


def test_dealt_batches(spark):
    df = sequences(spark, [3, 9, 5, 1, 0] * 20)
    want = {x.key: x for x in b.collate(b.fixed_batches(df, 8, ["key"]), 0).collect()}
    collated = b.collate(b.dealt_batches(df, 8, "key"), 0, within=[b.RANGE])
    assert len(id_exchanges(collated)[0]) == 2
    rows = collated.collect()
    assert len(rows) == len(want) == 100
    for x in rows:
        assert x.asDict() | {b.RANGE: None} == want[x.key].asDict() | {b.RANGE: None}
    groups = b.collate_groups(b.dealt_batches(df, 8, "key"), 0, within=[b.RANGE])
    assert len(id_exchanges(groups)[0]) == 2
    assert sorted(groups.collect()) == sorted(b.collate_groups(b.fixed_batches(df, 8, ["key"]), 0).collect())
    assert b.dealt_batches(df.limit(0), 8, "key").count() == 0 == b.pack(df.limit(0), 8, 2).count()
    with pytest.raises(ValueError):
        b.dealt_batches(df.unionByName(spark.createDataFrame([(None, [1])], df.schema)), 8, "key")


def test_pair_caps(spark):
    df = spark.createDataFrame([([1, 2, 3], [4, 5], [6, 7, 8, 9])], "prompt array<int>, chosen array<int>, rejected array<int>")
    off = b.cap_pairs(df, 0).first()
    assert (off.chosen_ids, off.rejected_ids) == ([0, 0, 1, 2, 3, 4, 5], [1, 2, 3, 6, 7, 8, 9])
    on = b.cap_pairs(df, 0, max_length=5, max_prompt_length=2).first()
    assert (on.prompt, on.chosen_ids, on.rejected_ids) == ([2, 3], [0, 2, 3, 4, 5], [2, 3, 6, 7, 8])


def test_map_batches(spark):
    def double(batch):
        batch["v"] = batch["v"] * 2
        return batch

    df = spark.createDataFrame([(i,) for i in range(20)], "v bigint").repartition(3)
    assert sorted(x.v for x in b.map_batches(df, double, "v bigint").collect()) == list(range(0, 40, 2))


def test_pretrain_dataset_packs_in_mix_order(spark):
    from corpusloom.operators.mixing import interleave, union_sources
    from corpusloom.plans.datasets import preference_dataset, pretrain_dataset

    frames = {
        "a": spark.createDataFrame([(i, f"a{i}") for i in range(40)], "key bigint, content string"),
        "b": spark.createDataFrame([(i, f"b{i}") for i in range(30)], "key bigint, text string"),
    }
    weights, plain = {"a": 0.6, "b": 0.4}, k.Vocabulary([])
    chunks = sorted(pretrain_dataset(frames, weights, plain, 16, packed=True).collect())
    texts = {n: df.toDF("key", "text") for n, df in frames.items()}
    mixed = sorted(interleave(union_sources(texts), weights, 42, position="p").collect(), key=lambda x: x.p)
    ids = plain.byte_ids()
    assert [t for x in chunks for t in x.input_ids] == [t for x in mixed for t in [*(ids[c] for c in x.text.encode()), 2]]
    assert preference_dataset(None, spark).count() == 300


def test_training_sample(spark):
    df = spark.createDataFrame([(i, "ab" if i < 10 else "cd") for i in range(100)], "id bigint, text string")
    a, b_, c, d = (k.Vocabulary([]).byte_ids()[x] for x in b"abcd")
    assert k.train_vocabulary(df, key="id", sample_size=10, vocab_size=300).merges == [(a, b_)]
    assert k.train_vocabulary(df, vocab_size=300).merges == [(c, d), (a, b_)]


def merge_by_rescan(symbols, ranks):
    """All occurrences of the lowest-ranked pair, again and again."""
    while True:
        pairs = [p for p in zip(symbols, symbols[1:]) if p in ranks]
        if not pairs:
            return symbols
        best = min(pairs, key=lambda p: ranks[p])
        out, i = [], 0
        while i < len(symbols):
            if tuple(symbols[i : i + 2]) == best:
                out.append(ranks[best][1])
                i += 2
            else:
                out.append(symbols[i])
                i += 1
        symbols = out


def test_heap_merges_like_rescanning():
    rng = random.Random(4)
    for _ in range(200):
        merges, size = {}, rng.randrange(2, 5)
        for rank in range(rng.randrange(1, 12)):
            pair = (rng.randrange(size + rank), rng.randrange(size + rank))
            if pair not in merges:
                merges[pair] = (rank, size + rank)
        word = [rng.randrange(size) for _ in range(rng.randrange(0, 40))]
        assert k.merge_word(list(word), merges) == merge_by_rescan(word, merges)


def test_long_word_is_quick():
    merges = {(i, i): (i, i + 1) for i in range(18)}
    start = time.perf_counter()
    assert k.merge_word([0] * (1 << 18), merges) == [18]
    assert time.perf_counter() - start < 20


def test_saved_vocabulary_and_added_tokens(spark, tmp_path):
    learned = k.Vocabulary([(6 + 68, 6 + 69), (262, 6 + 70)]).with_specials(["pad"])
    assert learned.added == ("<|startoftext|>", "<|endoftext|>")
    k.save_vocabulary(learned, spark, str(tmp_path / "v"))
    loaded = k.load_vocabulary(spark, str(tmp_path / "v"))
    assert (loaded.merges, loaded.reserved, loaded.added, loaded.names) == (learned.merges, learned.reserved, learned.added, learned.names)
    text = "<|startoftext|>efg efgh<|endoftext|>"
    rows = k.encode(spark.createDataFrame([(text,)], "text string"), loaded)
    ids = rows.first().input_ids
    assert ids[0] == len(loaded.names) - 2 and ids[-1] == len(loaded.names) - 1
    both = rows.select(k.decode(F.col("input_ids"), loaded).alias("a"), k.decode(F.col("input_ids"), loaded, False).alias("b")).first()
    assert (both.a, both.b) == ("efg efgh", text)


def test_full_size_vocabulary_decodes_quickly(spark):
    rng = random.Random(1)
    merges = [(rng.randrange(6, 262 + i), rng.randrange(6, 262)) for i in range(32_768 - 262)]
    merges = [(a if a < 262 or i % 50 else 6, b) for i, (a, b) in enumerate(merges)]
    learned = k.Vocabulary([(a if a < 262 else 6 + a % 256, b) for a, b in merges])
    rows = spark.createDataFrame([(list(range(6, 106)),)], "ids array<int>")
    start = time.perf_counter()
    rows.select(k.decode(F.col("ids"), learned)).collect()
    assert time.perf_counter() - start < 10
