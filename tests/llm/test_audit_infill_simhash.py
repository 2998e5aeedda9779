"""Filter audit, fill-in-the-middle and SimHash groups against plain Python."""

import hashlib
import itertools
import random
import re

import pytest
import xxhash
import zstandard
from pyspark.sql import functions as F

from corpusloom.llm import filter_audit, infill, pigeonring

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# Filter audit -------------------------------------------------------------------------------------------------------


def failed(text, doc_id, firsts):
    words = WORD.findall(text)
    marks = (
        len(words) < 200,
        100 * len(set(words)) < 50 * len(words),
        100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
        bool(re.search(r"[#$%&*|]", text)),
        doc_id is not None and doc_id > firsts[text],
    )
    return {f for f, m in zip("ABCDE", marks) if m}


def audit_by_hand(docs, labels):
    firsts = {}
    for doc_id, text, _ in docs:
        if doc_id is not None:
            firsts[text or ""] = min(doc_id, firsts.get(text or "", doc_id))
    good, toxic = ({d for d, *v in labels if d is not None and v[i] == 1} for i in (0, 1))
    rows = [(source or "", failed(text or "", d, firsts), d in good, d in toxic) for d, text, source in docs]
    out, taken = {}, {}
    for part in {r[0] for r in rows}:
        for order in itertools.permutations("ABCDE"):
            left = [r for r in rows if r[0] == part]
            for step, own in enumerate(order, 1):
                lost = [r for r in left if own in r[1]]
                gone = sum(own in r[1] and bool(r[1] & set(order[: step - 1])) for r in rows if r[0] == part)
                left = [r for r in left if own not in r[1]]
                alone = sum(r[1] == {own} for r in rows if r[0] == part)
                out[part, "".join(order), step] = [len(left), len(lost), gone, alone, sum(r[2] for r in lost), sum(r[3] for r in lost)]
                taken[part, own] = taken.get((part, own), 0) + len(lost)
    return {k: (*v, taken[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def audit_rows(spark, docs, labels):
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string")
    frame = frame.withColumns({"part": F.lit("x"), "mask": F.lit(9), "digest": F.lit("d"), "n": F.lit(1)})  # clashing names
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("source", F.lit("y"))
    rows = filter_audit.audit(frame, marks).collect()
    got = {(r.part, r.filter_order, r.step): tuple(r[3:]) for r in rows}
    assert len(got) == len(rows)
    return got


def test_audit(spark):
    rng = random.Random(1)
    texts = [None, "", " \t\n", "#", "A B c", "é" * 40 + " Ü", "w " * 200, " ".join(f"w{i}" for i in range(300)), " ".join(f"w{i}" for i in range(199))]
    texts += [" ".join(f"w{i}" for i in range(250)) + " $", "Word\x0bwith\x0call\x1dspaces " * 120, "x" * 300_000]
    docs = [(i, rng.choice(texts), rng.choice([None, "", "web", "code"])) for i in range(90)]
    docs += [(None, texts[0], "web"), (None, texts[7], None), (5, docs[5][1], "web"), (5, docs[6][1], "other"), (docs[3][0], docs[3][1], docs[3][2])]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 60)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1), (999, 1, 1)]
    got = audit_rows(spark, docs, labels)
    assert got == audit_by_hand(docs, labels)
    assert len(got) == 600 * len({p for p, _, _ in got})


def test_audit_of_few_rows(spark):
    assert audit_rows(spark, [], []) == {}
    got = audit_rows(spark, [(1, "short", "s")], [])
    assert len(got) == 600 and got["s", "EABCD", 1] == (1, 0, 0, 0, 0, 0, 0) and got["s", "EABCD", 2] == (0, 1, 0, 1, 0, 0, 120)


def test_audit_with_many_parts(spark):
    """More rows than the engine lets a recursion have by default, were it not told otherwise."""
    docs = spark.range(3500).select(F.col("id").alias("doc_id"), F.lit("one text").alias("text"), F.col("id").cast("string").alias("source"))
    rows = filter_audit.audit(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert rows.count() == 600 * 3500
    sums = rows.where("step = 5").agg(F.sum("kept"), F.min("shapley")).first()
    assert tuple(sums) == (0, 0)


# Fill-in-the-middle -------------------------------------------------------------------------------------------------


def transformed(doc_id, text, rate=100, spm=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return len(units), "plain", None, None, text
    prefix, middle, suffix = ("".join(u) for u in (units[:a], units[a:b], units[b:]))
    if h[3] % 100 < spm:
        return len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


TEXTS = [
    None, "", "\n", "\n\n\n", "one line", "two\nlines", "end\n", "ein\nÜberé\n\n日本語\n𝄞𝄞\n", "<P>", "a<S", "a<S>\nb", "<M", "M>\n<", "<\nP>\n<\n",
    "é" * 5000, "x" * 20_000 + "\n" + "y" * 9, "\n" * 3000, "a\r\nb\rc\n", "nul \x00 byte\n<S\n>",
]


@pytest.mark.parametrize("frame", [1, 2, 3, 7, 1 << 16])
def test_fill_in_middle(spark, frame):
    rng = random.Random(2)
    texts = TEXTS + ["".join(rng.choice(["a", "é", "\n", "日", "<", "S", ">"]) for _ in range(rng.randrange(60))) for _ in range(80)]
    docs = [(i, t, "x") for i, t in enumerate(texts)] + [(None, "no\nid", "x"), (None, None, "x"), (7, texts[7], "x"), (7, "other\ntext", "x")]
    frame_rows = spark.createDataFrame(docs, "doc_id long, text string, frames string").withColumn("units", F.lit(3))
    filled = infill.filled(infill.stored(frame_rows, frame))
    outputs = filled.collect()
    want = sorted(repr((d, *transformed(d, t))) for d, t, _ in docs)
    plain = [(r, b"".join(zstandard.ZstdDecompressor().decompress(f) for f in r.output).decode()) for r in outputs]
    assert sorted(repr((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, t)) for r, t in plain) == want
    got = infill.digests(filled).collect()
    assert sorted(repr((r.doc_id, r.output_sha256, r.restored_sha256)) for r in got) == sorted(
        repr((d, sha(transformed(d, t)[4]), sha(t or ""))) for d, t, _ in docs
    )
    back = infill.restored(filled).collect()
    texts_back = sorted(repr((r.doc_id, b"".join(zstandard.ZstdDecompressor().decompress(f) for f in r.frames).decode())) for r in back)
    assert texts_back == sorted(repr((d, t or "")) for d, t, _ in docs)


def test_fill_in_middle_rates_and_empty_table(spark):
    docs = spark.createDataFrame([(i, "a\nb\nc\n" * 3) for i in range(60)], "doc_id long, text string")
    store = infill.stored(docs)
    for rate, spm in ((0, 50), (40, 0), (40, 100)):
        got = {r.doc_id: r.form for r in infill.filled(store, rate=rate, spm_rate=spm).collect()}
        assert got == {i: transformed(i, "a\nb\nc\n" * 3, rate, spm)[1] for i in range(60)}
    assert infill.digests(infill.filled(infill.stored(docs.limit(0)))).count() == 0


def test_only_cut_frames_are_opened():
    """Of many frames the two that hold a cut are decompressed; the others move as they are."""
    text = b"".join(b"line %d\n" % i for i in range(50_000))
    pack = zstandard.ZstdCompressor().compress
    frames, lines, chars = [], 0, 0
    for piece in infill.pieces(text, 4096):
        lines, chars = lines + piece.count(b"\n"), chars + len(piece)
        frames.append({"units": lines, "chars": chars, "data": pack(piece)})
    own = infill.Stored(frames, lines)
    start, end = own.after(12_345), own.after(40_000)
    middle = own.between(start, end)
    assert len(own.opened) == 2 and len(frames) > 100
    assert b"".join(infill.stream(middle)) == b"".join(b"line %d\n" % i for i in range(12_345, 40_000))
    assert own.points(start) == len(b"".join(b"line %d\n" % i for i in range(12_345)))
    assert sum(m is f["data"] for m in middle for f in frames) == len(middle) - 2
    assert zstandard.ZstdDecompressor().stream_reader(b"".join(middle), read_across_frames=True).read() == b"".join(infill.stream(middle))


def test_invalid_bytes_pass_through(spark):
    docs = spark.sql("SELECT 1L AS doc_id, cast(x'61ff0a80e2820a62' AS string) AS text")
    got = infill.digests(infill.filled(infill.stored(docs))).first()
    assert got.n == 3 and got.restored_sha256 == hashlib.sha256(bytes.fromhex("61ff0a80e2820a62")).hexdigest()


# SimHash ------------------------------------------------------------------------------------------------------------


def print_of(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    cut = [words[i : i + 3] for i in range(len(words) - 2)] if len(words) >= 3 else [words] if words else []
    values = [xxhash.xxh64_intdigest(" ".join(s).encode(), seed=42) for s in cut]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in values) > len(values))


def classes_of(prints, ids=None):
    """Smallest id reachable over links of at most three bits; rows of one id are one vertex."""
    ids = list(range(len(prints))) if ids is None else ids
    root = {i: i for i in ids}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(range(len(prints)), 2):
        if (prints[a] ^ prints[b]).bit_count() <= 3 and top(ids[a]) != top(ids[b]):
            low, high = sorted((top(ids[a]), top(ids[b])))
            root[high] = low
    return {i: top(i) for i in ids}


def test_simhash_texts(spark, monkeypatch):
    rng = random.Random(3)
    base = [[f"w{rng.randrange(400)}" for _ in range(rng.randrange(1, 120))] for _ in range(25)]
    texts = [None, "", " \t\n", "one", "one two", "One TWO three", "É é É é", "a b c a b c a b c", "x\x1cy z\x0bq"]
    for words in base:
        for _ in range(4):
            own = list(words)
            own[rng.randrange(len(own))] = "edit"
            texts.append((" " if rng.random() < 0.5 else "\n").join(own if rng.random() < 0.7 else words))
    texts.append("long words " * 60_000 + "end")
    docs = [(i, t) for i, t in enumerate(texts)]
    extra = [(None, texts[20]), (12, texts[12]), (13, texts[40])]  # NULL id, a row twice, an id on two texts
    frame = spark.createDataFrame(docs + extra, "doc_id long, text string").withColumns({"print": F.lit("x"), "node": F.lit(1), "component_id": F.lit(2)})
    known = docs + [e for e in extra if e[0] is not None]
    want = classes_of([print_of(t) for _, t in known], [d for d, _ in known])
    expected = sorted(repr((d, f"{print_of(t):016x}", want.get(d))) for d, t in docs + extra)
    for share in (1000, 20):  # with and without hot classes
        monkeypatch.setattr(pigeonring, "HOT_SHARE", share)
        got = pigeonring.grouped(frame).select("doc_id", "fingerprint", "component_id").collect()
        assert sorted(repr(tuple(r)) for r in got) == expected
    assert pigeonring.grouped(frame.limit(0)).count() == 0


def test_windows_do_not_change_fingerprints(monkeypatch):
    text = " ".join(f"Wört{i % 97} {'y' * (i % 50)}" for i in range(3000))
    for size in (1, 7, 100, 1 << 18):
        monkeypatch.setattr(pigeonring, "WINDOW", size)
        monkeypatch.setattr(pigeonring.windows, "__defaults__", (size,))
        assert pigeonring.fingerprint(text.encode()) & (1 << 64) - 1 == print_of(text)


def linked_prints(spark, prints):
    classes = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p, i) for i, p in enumerate(prints)], "print long, doc long")
    found = {r.u: r.v for r in pigeonring.components(pigeonring.print_links(classes)).collect()}
    return {i: found.get(i, i) for i in range(len(prints))}


@pytest.mark.parametrize("node", [8, 64, 2048])
def test_small_and_branching_nodes_lose_no_link(spark, monkeypatch, node):
    """Chains of links of exactly three bits in every place, far pairs of four bits, and random prints."""
    monkeypatch.setattr(pigeonring, "NODE", node)
    rng = random.Random(node)
    prints = set()
    for _ in range(60):
        one = rng.getrandbits(64)
        for step in (3, 3, 2, 4, 1, 5):
            prints.add(one)
            for bit in rng.sample(range(64), step):
                one ^= 1 << bit
    prints |= {rng.getrandbits(64) for _ in range(200)} | {0, (1 << 64) - 1}
    shared = rng.getrandbits(64)  # many prints of one half
    prints |= {shared & ~0xFFFFFFFF | rng.getrandbits(32) for _ in range(200)}
    prints = sorted(prints)
    rng.shuffle(prints)
    assert linked_prints(spark, prints) == classes_of(prints)


def test_dense_nodes(spark, monkeypatch):
    """All fingerprints that differ from one in at most two bits: one component, in nodes far beyond the limit."""
    monkeypatch.setattr(pigeonring, "NODE", 100)
    middle = random.Random(9).getrandbits(64)
    prints = [middle] + [middle ^ (1 << a) for a in range(64)] + [middle ^ (1 << a) ^ (1 << b) for a, b in itertools.combinations(range(64), 2)]
    assert set(linked_prints(spark, prints).values()) == {0}


def test_chain_budgets_follow_the_ring():
    """Every pair within the radius has a segment from which all chains keep their budgets; the masks cover the ring."""
    rng = random.Random(4)
    assert sum(pigeonring.segment_masks()) == (1 << 64) - 1
    for _ in range(2000):
        differs = sum(1 << b for b in rng.sample(range(64), rng.randrange(4)))
        kept = [
            f for f, m in enumerate(pigeonring.segment_masks())
            if not differs & m and all((differs & c).bit_count() <= k for c, k in pigeonring.chain_masks(f))
        ]
        assert kept
        assert any(not differs & p for p in pigeonring.next_pieces(kept[0], pigeonring.segment_masks()[kept[0]]))
