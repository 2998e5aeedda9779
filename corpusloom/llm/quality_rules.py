"""Quality rules: a base filter, and an ordered decision list that is learned from labelled documents.

The statistics of a text are expressions over its words (``[^\\x20\\x09-\\x0D]+``) and lines. Learning is sequential covering:
a rule is a conjunction of thresholds that is grown on two thirds of the labelled rows until it covers no good document,
pruned from its end on the other third, and accepted while it is precise; the rows it covers leave and the next rule is
grown. The list becomes one ``CASE`` expression that names the first rule that fits.

Defined results: a NULL or empty text has no words and fails the base rule; without labels there are no learned rules;
labels of other documents, NULL labels and repeated labels (the smallest counts) do no harm; repeated rows are judged
alike; an empty table gives an empty result. ``judged`` keeps all input columns but those named like its own.

Native: no function leaves the JVM. Each text is judged within its row, so nothing is shuffled. The driver receives the
statistics of at most ``LABELLED_ROWS`` documents, chosen by hash of their ids.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import WHITE

LABELLED_ROWS = 4000  # the bound of the labelled sample
CUTS, MOST_RULES, MOST_TERMS, LEAST_COVER, LEAST_PRECISION = 32, 16, 4, 5, 0.95
MIN_WORDS, MOST_REPEATED = 50, 50

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
EXTRA = ("__lines", "__capitals", "__marks", "__stops")
#: What rules may look at: ratios of the counts, so that they mean the same for texts of any length.
FEATURES = {
    "word_length": ("word_chars", "n_words"),
    "symbols_per_word": ("n_symbols", "n_words"),
    "dup_line_share": ("n_dup_lines", "__lines"),
    "repeated_share": ("n_repeat_words", "n_words"),
    "capital_share": ("__capitals", "word_chars"),
    "marks_per_word": ("__marks", "n_words"),
    "stops_per_word": ("__stops", "n_words"),
}


def counted(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the counts of each text. Columns with the names of the counts are replaced."""
    keep = [c for c in docs.columns if c not in COUNTS + EXTRA]
    whole = F.coalesce(F.col(text), F.lit(""))
    size = F.size("__words")
    # Bits that hold every position of this text; the rest of a long holds the window's hash.
    split = docs.select(*keep, F.regexp_extract_all(whole, F.lit(f"[^{WHITE}]+"), F.lit(0)).alias("__words"))
    split = split.withColumn("__bits", F.length(F.bin(size)).cast("int"))

    def window(i: Column) -> Column:
        return F.xxhash64(F.get("__words", i), F.get("__words", i + 1), F.get("__words", i + 2))

    # Positions of 3-word windows, sorted by window: equal windows become neighbours.
    packed = F.transform(F.sequence(F.lit(0), size - 3), lambda i: _shift("left", window(i)).bitwiseOR(i.cast("bigint")))
    no_positions = F.array().cast("array<bigint>")
    split = split.withColumn("__sorted", F.when(size >= 3, F.sort_array(packed)).otherwise(no_positions))

    def at(p: Column) -> Column:
        return p.bitwiseAND(_shift("left", F.lit(1).cast("bigint")) - 1).cast("int")

    def same(p: Column, k: Column) -> Column:
        other = F.get("__sorted", k)
        words = F.slice("__words", at(p) + 1, F.lit(3)) == F.slice("__words", at(other) + 1, F.lit(3))
        return F.coalesce((_shift("right", p) == _shift("right", other)) & words, F.lit(False))

    twice = F.filter("__sorted", lambda p, k: same(p, k - 1) | same(p, k + 1))
    covered = F.size(F.array_distinct(F.flatten(F.transform(twice, lambda p: F.array(at(p), at(p) + 1, at(p) + 2)))))
    lines = F.filter(F.split(whole, "\n", -1), lambda x: x.rlike(f"[^{WHITE}]"))
    split = split.withColumn("__text_lines", lines)

    def number(pattern: str) -> Column:
        return F.regexp_count(whole, F.lit(pattern)).cast("bigint")

    return split.select(
        *keep,
        size.cast("bigint").alias("n_words"),
        F.length(F.array_join("__words", "")).cast("bigint").alias("word_chars"),
        number(r"[#*$%&|<>]").alias("n_symbols"),
        (F.size("__text_lines") - F.size(F.array_distinct("__text_lines"))).cast("bigint").alias("n_dup_lines"),
        covered.cast("bigint").alias("n_repeat_words"),
        F.size("__text_lines").cast("bigint").alias("__lines"),
        number("[A-Z]").alias("__capitals"),
        number("!").alias("__marks"),
        number(r"\.").alias("__stops"),
    )


def _shift(way: str, value: Column) -> Column:
    return F.call_function(f"shift{way}", value, F.col("__bits"))


def feature(name: str) -> Column:
    above, below = FEATURES[name]
    return F.col(above) / F.greatest(F.col(below), F.lit(1))


@dataclass(frozen=True)
class Term:
    feature: str
    above: bool
    cut: float

    def holds(self, row: dict) -> bool:
        return row[self.feature] > self.cut if self.above else row[self.feature] <= self.cut

    def column(self) -> Column:
        return feature(self.feature) > self.cut if self.above else feature(self.feature) <= self.cut

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.cut:.6g}"


Rule = tuple[Term, ...]


def covers(rule: Rule, row: dict) -> bool:
    return all(t.holds(row) for t in rule)


def _cover(rule: Rule, rows: list[dict]) -> tuple[int, int]:
    hit = [r["bad"] for r in rows if covers(rule, r)]
    return sum(hit), len(hit) - sum(hit)


def grow(rows: list[dict], terms: list[Term]) -> Rule:
    """Add the term of the largest information gain until no good row is covered."""
    rule: Rule = ()
    bad, good = _cover(rule, rows)
    while good and len(rule) < MOST_TERMS:
        best, gain = None, 0.0
        before = math.log2(bad / (bad + good))
        for term in terms:
            p, n = _cover((term,), rows)
            if p and p * (math.log2(p / (p + n)) - before) > gain:
                best, gain = term, p * (math.log2(p / (p + n)) - before)
        if best is None:
            break
        rule, rows = (*rule, best), [r for r in rows if best.holds(r)]
        bad, good = _cover((), rows)
    return rule


def prune(rule: Rule, rows: list[dict]) -> Rule:
    """The beginning of the rule that does best on rows it was not grown on; of equals, the longest."""
    def worth(length: int) -> float:
        p, n = _cover(rule[:length], rows)
        return (p - n) / (p + n) if p + n else -1.0

    return rule[: max(range(1, len(rule) + 1), key=lambda k: (worth(k), k))] if rule else rule


def learn(rows: list[dict]) -> list[Rule]:
    """A decision list for rows of features with ``bad`` (1 or 0) and ``part`` (0, 1: grow; 2: prune)."""
    values = {f: sorted({r[f] for r in rows}) for f in FEATURES}
    terms = []
    for name, found in values.items():
        places = sorted({i * (len(found) - 1) // CUTS for i in range(CUTS)}) if len(found) > 1 else []
        for i in places:
            middle = (found[i] + found[i + 1]) / 2
            terms += [Term(name, True, middle), Term(name, False, middle)]
    rules: list[Rule] = []
    while len(rules) < MOST_RULES and any(r["bad"] for r in rows):
        growing, pruning = [r for r in rows if r["part"] < 2], [r for r in rows if r["part"] == 2]
        if not any(r["bad"] for r in growing):
            break
        rule = prune(grow(growing, terms), pruning)
        bad, good = _cover(rule, rows)
        if not rule or bad < LEAST_COVER or bad < LEAST_PRECISION * (bad + good):
            break
        rules.append(rule)
        rows = [r for r in rows if not covers(rule, r)]
    return rules


def labelled(docs: DataFrame, labels: DataFrame, bound: int = LABELLED_ROWS) -> list[dict]:
    """Features of at most ``bound`` labelled documents, chosen by hash of doc_id."""
    marked = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("__quality"))
    chosen = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
    some = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    seen = counted(some).groupBy("doc_id", "__quality").agg(F.min(F.struct(*COUNTS, *EXTRA)).alias("s"))
    flat = seen.select("doc_id", "__quality", "s.*").select(
        (F.col("__quality") == 0).cast("int").alias("bad"),
        F.pmod(F.xxhash64(F.lit("part"), "doc_id"), F.lit(3)).alias("part"),
        *[feature(f).alias(f) for f in FEATURES],
    )
    return [r.asDict() for r in flat.orderBy("doc_id").collect()]


def first_rule(rules: list[Rule]) -> Column:
    """The text of the first rule that fits, or NULL."""
    found = F.lit(None).cast("string")
    for rule in reversed(rules):
        fits = rule[0].column()
        for term in rule[1:]:
            fits = fits & term.column()
        found = F.when(fits, F.lit(" and ".join(map(str, rule)))).otherwise(found)
    return found


def judged(docs: DataFrame, labels: DataFrame, bound: int = LABELLED_ROWS) -> DataFrame:
    """The documents with their counts, ``base_failed``, the learned ``rule`` that rejects them, and ``kept``."""
    rules = learn(labelled(docs, labels, bound))
    rest = [c for c in docs.columns if c not in ("base_failed", "rule", "kept")]
    few = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    rows = counted(docs.select(*rest)).withColumns({"base_failed": few, "rule": first_rule(rules)})
    return rows.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull()).drop(*EXTRA)
