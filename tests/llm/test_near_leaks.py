"""Near-duplicates and benchmark leaks against brute force."""

import random
import re

import pytest

from corpusloom.llm import components, leaks, near_dup

FOLDER = "/root/testdata/sf0.01"


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def expected(rows, percent):
    """doc_id -> smallest doc_id of its component, by comparing all pairs."""
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, (i, s) in enumerate(sets):
        for j, t in sets[a + 1 :]:
            if s and t and 100 * len(s & t) >= percent * len(s | t):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i: find(i) for i in root}


def edited(rng, words, n):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"x{rng.randrange(10**9)}"
    return out


def crowd(seed, size, words, chain):
    """Copies of copies: each differs from an earlier one in a word or two, or is an exact copy of it."""
    rng = random.Random(seed)
    texts = [[f"w{rng.randrange(400)}" for _ in range(words)]]
    while len(texts) < size:
        texts.append(edited(rng, texts[-1] if chain else rng.choice(texts), rng.choice((0, 1, 1, 2))))
    return [" ".join(t) for t in texts]


ODD = [
    (None, "one two three four five six"), (901, None), (902, ""), (903, " \t\n"), (904, "Few Words"), (905, "few\x0bwords "),
    (906, "é É"), (907, "É É"), (908, "a b c d e"), (908, "a b c d e"), (909, "A B C D E"), (910, "f g h i j"), (910, "k l m n o"),
    (911, "k l m n o"), (912, "f g h i j"), (913, "w " * 20_000),
]


@pytest.mark.parametrize(("percent", "leaf", "levels"), [(80, 1024, 9), (85, 4, 3), (85, 4, 1)])
def test_components(spark, monkeypatch, percent, leaf, levels):
    """Also with nodes so small that every level and the blocks of large nodes are used."""
    monkeypatch.setattr(near_dup, "LEAF", leaf)
    monkeypatch.setattr(near_dup, "LEVELS", levels)
    rows = list(enumerate(crowd(1, 30, 120, False) + crowd(2, 12, 60, True) + [f"own text number {i} " * 9 for i in range(10)])) + ODD
    random.Random(3).shuffle(rows)
    docs = spark.createDataFrame([(i, t, "k", 1) for i, t in rows], "doc_id long, text string, key string, node int")
    got = near_dup.near_duplicates(docs, percent).collect()
    want = expected(rows, percent)
    assert sorted(((r.doc_id, r.n_shingles) for r in got), key=repr) == sorted(((i, len(shingles(t))) for i, t in rows), key=repr)
    found = {r.doc_id: r.component_id for r in got if r.doc_id is not None}
    assert found == want
    assert all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in got)


@pytest.mark.parametrize(("percent", "core", "own", "tail"), [(80, 60, 20, 10), (85, 80, 22, 9)])
def test_no_pair_at_the_threshold_is_lost_on_deep_paths(spark, monkeypatch, percent, core, own, tail):
    """All texts share half of their shingles, so that small nodes are many branchings away."""
    monkeypatch.setattr(near_dup, "LEAF", 16)

    def new(name, n):
        return [f"{name}x{k}" for k in range(n)]

    texts = []
    for pair in range(80):
        shared = new("core", core + 4) + new(f"p{pair}", own)
        texts += [" ".join(shared + new(f"{side}{pair}", tail)) for side in "ab"]
    a, b, c = map(shingles, texts[:3])
    assert 100 * len(a & b) == percent * len(a | b) and 100 * len(a & c) < 60 * len(a | c)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near_dup.near_duplicates(docs, percent).collect()}
    assert got == {i: i // 2 * 2 for i in range(160)}


def landings(monkeypatch):
    """The tables that near_dup lands from now on."""
    seen, real = [], near_dup.landed
    monkeypatch.setattr(near_dup, "landed", lambda df, label: seen.append(label) or real(df, label))
    return seen


def test_a_template_family_under_the_threshold_takes_few_passes(spark, monkeypatch):
    """Texts of one template that are all just under the threshold, in nodes many times too large: as many jobs as ever, and exact."""
    monkeypatch.setattr(near_dup, "LEAF", 16)
    template = [f"core{k}" for k in range(304)]  # 300 shingles of all, and 27 of each: 300 of 354 in common
    texts = [" ".join(template + [f"d{i}x{k}" for k in range(27)]) for i in range(150)]
    texts += [texts[3] + " more", texts[140] + " end"]
    a, b, c = shingles(texts[0]), shingles(texts[1]), shingles(texts[150])
    assert 84 * len(a | b) <= 100 * len(a & b) < 85 * len(a | b) and 100 * len(shingles(texts[3]) & c) >= 85 * len(shingles(texts[3]) | c)
    seen = landings(monkeypatch)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near_dup.near_duplicates(docs).collect()}
    assert got == {i: i for i in range(150)} | {150: 3, 151: 140}
    assert seen.count("likely") <= 2 + 3  # two passes of the first sketch, and one for each further one


def test_nodes_are_bounded_by_the_length_of_texts(spark, monkeypatch):
    """Long texts count as several classes, so that a node of few of them is cut too; no link is lost."""
    monkeypatch.setattr(near_dup, "LEAF", 16)
    monkeypatch.setattr(near_dup, "LONG", 10)
    base = [[f"b{n}w{k}" for k in range(100)] for n in range(4)]
    texts = [" ".join(words[:90] + [f"e{i}"] + words[91:]) for n, words in enumerate(base) for i in range(6)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near_dup.near_duplicates(docs).collect()}
    assert got == {i: i // 6 * 6 for i in range(24)}


def test_a_group_of_near_copies_is_not_listed_in_every_tree(spark, monkeypatch):
    """Nodes of what the first trees have made one component have no rows in the other trees."""
    rows, real = [], near_dup.landed

    def counted(df, label):
        out = real(df, label)
        rows.extend([out.count()] if label == "nodes" else [])
        return out

    monkeypatch.setattr(near_dup, "landed", counted)
    rng = random.Random(7)
    base = [f"w{k}" for k in range(400)]
    texts = [" ".join(edited(rng, base, 1)) for _ in range(200)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.component_id for r in near_dup.near_duplicates(docs).collect()} == {0}
    assert sum(rows) <= near_dup.FIRST_TREES * len(texts), rows


def test_no_documents(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert near_dup.near_duplicates(docs).count() == 0


def test_star_and_chain(spark):
    pairs = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(5, 5), (300, 200), (200, 300)]
    got = {r.u: r.v for r in components.components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(1, 61)} | {i: 100 for i in range(101, 160)} | {300: 200}


def leaked(text, item):
    """Largest weighted similarity of the item with any window of its length."""
    def cut(words):
        return [tuple(words[i : i + 5]) for i in range(len(words) - 4)]

    words, wanted = re.findall(r"[^ \t-\r]+", (text or "").lower()), cut(re.findall(r"[^ \t-\r]+", item.lower()))
    best = 0.0
    for start in range(-len(wanted), len(words)):
        window = cut(words[max(0, start) : start + len(wanted) + 4])
        common = sum(min(window.count(s), wanted.count(s)) for s in set(window))
        best = max(best, common / max(1, len(window) + len(wanted) - common))
    return best


def test_leaks(spark):
    rng = random.Random(5)
    items = [[f"b{rng.randrange(300)}" for _ in range(n)] for n in (8, 20, 35, 50, 59)]
    docs = [None, "", "four words are few", " ".join(items[1]), " ".join(items[4]).upper()]
    for n in range(60):
        own = [f"d{rng.randrange(500)}" for _ in range(rng.randrange(5, 60))]
        item = rng.choice(items)
        part = edited(rng, item, 1) if n % 3 == 0 else item[: len(item) - n % 4] if n % 3 == 1 else item[len(item) // 2 :]
        docs.append(" ".join(own[:9] + part + own[9:]))
    frame = spark.createDataFrame([(i, t, "x") for i, t in enumerate(docs)] + [(None, None, "x"), (3, docs[3], "x")], "doc_id long, text string, item string")
    bench = [(i, " ".join(x)) for i, x in enumerate(items)]
    table = spark.createDataFrame([*bench, bench[0], (7, None), (8, "too short")], "item_id long, text string")
    got = leaks.marked(frame, table).collect()
    assert len(got) == len(docs) + 2
    for r in got:
        want = {i: leaked(docs[r.doc_id] if r.doc_id is not None else None, x) for i, x in bench}
        assert r.item_ids == [i for i, s in want.items() if s >= 0.8], (r, want)
        assert r.contaminated == bool(r.item_ids)
        if r.item_ids:
            assert abs(r.similarity - max(want.values())) < 1e-9
    assert leaks.marked(frame.limit(0), table).count() == 0
    assert not leaks.marked(frame, table.limit(0)).where("contaminated").count()


def test_reordered_passages(spark):
    """Halves and sentences in another order; cut by the text's start or end; long items with repeated shingles."""
    rng = random.Random(6)
    items = [[f"{k}b{rng.randrange(9000)}" for _ in range(n)] for k, n in enumerate((64, 90, 50))] + [[f"r{i % 20}" for i in range(70)]]
    docs = []
    for item in items:
        half, third = len(item) // 2, len(item) // 3
        for part in (item[half:] + item[:half], item[third : 2 * third] + item[2 * third :] + item[:third], item[5:], item[:-5]):
            own = [f"d{rng.randrange(500)}" for _ in range(40)]
            docs += [own + part + own, part + own, own[:9] + part[:-3]]
    docs = [" ".join(d) for d in docs]
    frame = spark.createDataFrame([*enumerate(docs), (0, docs[1])], "doc_id long, text string")
    table = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)], "item_id long, text string")
    got = {r.doc_id: r for r in leaks.marked(frame, table).collect() if r.doc_id}
    same = len(docs) // len(items)  # the items have no words in common
    want = {d: {d // same: leaked(t, " ".join(items[d // same]))} for d, t in enumerate(docs) if d}
    assert {d: r.item_ids for d, r in got.items()} == {d: [i for i, s in w.items() if s >= 0.8] for d, w in want.items()}
    assert sum(bool(r.item_ids) for r in got.values()) > 20
    assert all(abs(r.similarity - max(want[d].values())) < 1e-9 for d, r in got.items() if r.item_ids)


def test_all_planted_passages_are_found(spark):
    docs, bench = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "benchmark"))
    texts = [r.text for r in bench.collect()]
    want = {r.doc_id for r in docs.collect() if any(t in r.text for t in texts)}
    got = {r.doc_id for r in leaks.marked(docs, bench).where("contaminated").collect()}
    assert want <= got
    assert len(got - want) <= 0.005 * docs.count()  # those are copies of a passage with another case or a cut end
