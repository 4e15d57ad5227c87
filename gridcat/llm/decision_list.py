"""Quality rules learned as an ordered decision list, in DataFrame operations only.

Text statistics are built-in column expressions.  Sequential covering then
learns rules for the rejected class from labelled statistics: a rule grows one
threshold condition at a time by information gain over the rows that no
earlier rule covers, is pruned back on held-back rows to the prefix of best
worth, and is kept while it is precise enough there.  Every step is one small
aggregate over binned statistics; the driver sees counts per feature and bin
only.  The result is an ordered chain of ``when`` conditions.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, stored

SPACES = "\t\n\x0b\f\r"          # besides the blank, what separates words
SYMBOLS = "#*$%&|<>"
WINDOW = 5
FEATURES = ("n_words", "mean_word", "symbol_share", "dup_lines", "repeat_share", "stutter_share", "mark_share",
            "digit_share")
CUTS = 32                         # threshold candidates per feature
MAX_RULES, MAX_CONDITIONS = 8, 4
MIN_PRECISION, MIN_COVER = 0.8, 5


def words_of(text: Column) -> Column:
    """Runs of characters other than the blank and U+0009..U+000D; null: none."""
    flat = F.btrim(F.translate(F.coalesce(text, F.lit("")), SPACES, " " * len(SPACES)), F.lit(" "))
    return F.when(flat == "", F.array().cast("array<string>")).otherwise(F.split(flat, " +"))


def repeat_words(words: Column, window: int = WINDOW) -> Column:
    """Words inside windows of ``window`` words that occur twice or more in
    the text, the first occurrence included.  Windows are compared by 64-bit hash;
    texts without a repeated window skip the sort."""

    def covered(places: Column) -> Column:
        start = F.struct(F.lit(-window).alias("last"), F.lit(0).alias("total"))
        return F.aggregate(
            places, start,
            lambda s, p: F.struct(p.alias("last"),
                                  (s["total"] + F.least(F.lit(window), p - s["last"])).alias("total")),
            lambda s: s["total"])

    def places(ordered: Column) -> Column:
        following = F.slice(ordered, 2, F.size(ordered))
        twins = F.zip_with(ordered, following, lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"]))
                           .otherwise(F.array().cast("array<int>")))
        return F.sort_array(F.array_distinct(F.flatten(twins)))

    def among(hashes: Column) -> Column:
        ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return (F.when(F.size(F.array_distinct(hashes)) < F.size(hashes),
                       covered(let(ordered, places)))
                .otherwise(F.lit(0)))

    def windows(each: Column) -> Column:
        spots = F.sequence(F.lit(0), F.size(each) - window)
        return F.transform(spots, lambda i: F.xxhash64(*(each[i + k] for k in range(window))))

    hashed = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) > window, let(hashed, lambda each: let(windows(each), among))).otherwise(F.lit(0))


def stutters(words: Column) -> Column:
    """Words equal to the word before them."""
    pairs = F.zip_with(words, F.slice(words, 2, F.size(words)), lambda a, b: a == b)
    return F.size(F.filter(pairs, lambda same: same))


def text_stats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and whole-text counts, all bigint: n_words, word_chars (code
    points in words), n_symbols, n_dup_lines (lines with a word that equal an earlier line),
    n_repeat_words, n_stutters (words equal to the one before), n_marks (sentence ends), n_digits.
    Null text: all zero."""
    def count_of(characters: str) -> Column:
        return F.length("__text") - F.length(F.translate(F.col("__text"), characters, ""))

    counted = docs.select(key, F.coalesce(F.col(text), F.lit("")).alias("__text")).select(
        key,
        let(words_of(F.col("__text")), lambda words: F.struct(
            F.size(words).alias("n_words"), repeat_words(words).alias("n_repeat_words"),
            F.when(F.size(words) > 1, stutters(words)).otherwise(F.lit(0)).alias("n_stutters"))).alias("w"),
        let(F.filter(F.split("__text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")),
            lambda lines: F.size(lines) - F.size(F.array_distinct(lines))).alias("n_dup_lines"),
        F.length(F.translate(F.col("__text"), " " + SPACES, "")).alias("word_chars"),
        count_of(SYMBOLS).alias("n_symbols"), count_of(".!?").alias("n_marks"),
        count_of("0123456789").alias("n_digits"))
    return counted.select(key, *(F.col(c).cast("bigint").alias(n) for n, c in {
        "n_words": "w.n_words", "word_chars": "word_chars", "n_symbols": "n_symbols", "n_dup_lines": "n_dup_lines",
        "n_repeat_words": "w.n_repeat_words", "n_stutters": "w.n_stutters", "n_marks": "n_marks", "n_digits": "n_digits"}.items()))


def base_failed() -> Column:
    """Too few words, or over a fifth of them in repeated windows."""
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def feature(name: str) -> Column:
    """A learned rule's feature from the counts of ``text_stats``."""
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    chars = F.greatest(F.col("word_chars"), F.lit(1)).cast("double")
    return {
        "n_words": F.col("n_words").cast("double"),
        "mean_word": F.col("word_chars") / words,
        "symbol_share": F.col("n_symbols") / chars,
        "dup_lines": F.col("n_dup_lines").cast("double"),
        "repeat_share": F.col("n_repeat_words") / words,
        "stutter_share": F.col("n_stutters") / words,
        "mark_share": F.col("n_marks") / words,
        "digit_share": F.col("n_digits") / chars,
    }[name]


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool         # value > threshold, else value <= threshold
    threshold: float
    cut: int            # place of the threshold among the feature's cuts

    def column(self) -> Column:
        value = feature(self.feature)
        return value > self.threshold if self.above else value <= self.threshold

    def binned(self) -> Column:
        place = F.col(f"b_{self.feature}")
        return place > self.cut if self.above else place <= self.cut

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:g}"


@dataclass(frozen=True)
class DecisionList:
    rules: tuple[tuple[Condition, ...], ...]

    def matched(self) -> Column:
        """Number of the first rule that fits, from 1; null if none does."""
        chain = None
        for i, rule in enumerate(self.rules, 1):
            fits = reduce(lambda a, b: a & b, (c.column() for c in rule))
            chain = F.when(fits, F.lit(i)) if chain is None else chain.when(fits, F.lit(i))
        return F.lit(None).cast("int") if chain is None else chain

    def __str__(self) -> str:
        lines = [f"{'if' if i == 0 else 'else if'} {' and '.join(map(str, r))}: reject" for i, r in enumerate(self.rules)]
        return "\n".join([*lines, "else: keep" if lines else "keep"])


def _score(p: float, n: float) -> float:
    return math.log2((p + 1e-9) / (p + n + 1e-9))


def learn(labelled: DataFrame, label: str = "rejected", key: str = "doc_id", max_rules: int = MAX_RULES,
          max_conditions: int = MAX_CONDITIONS, min_precision: float = MIN_PRECISION,
          min_cover: int = MIN_COVER, cuts: int = CUTS) -> DecisionList:
    """Learn a list from all rows of ``labelled``: the counts of ``text_stats``
    and a boolean ``label``.  A third of the rows, by hash of the key, is held back
    for pruning.  No labelled rows, or a single class, give the empty list, which keeps everything."""
    at = [(i + 1) / (cuts + 1) for i in range(cuts)]
    asked = labelled.agg(*(F.percentile_approx(feature(f), at, 10000).alias(f) for f in FEATURES)).first()
    steps = {f: sorted({float(v) for v in asked[f] or []}) for f in FEATURES}
    binned = stored(_binned(labelled, label, key, steps), "labelled-bins")
    rules: list[tuple[Condition, ...]] = []
    while len(rules) < max_rules:
        open_ = binned
        for rule in rules:
            open_ = open_.where(~reduce(lambda a, b: a & b, (c.binned() for c in rule)))
        rule = _grow(open_.where(~F.col("held")), steps, max_conditions, min_cover)
        if not rule:
            break
        rule, p, n = _prune(open_.where("held"), rule)
        if p < 1 or p / (p + n) < min_precision:
            break
        rules.append(rule)
    return DecisionList(_centred(rules, labelled))


def _centred(rules: list[tuple[Condition, ...]], labelled: DataFrame) -> tuple[tuple[Condition, ...], ...]:
    """Each threshold moved half way to the next greater value among the labelled rows, which changes
    no labelled row's side and leaves texts between the classes the widest room."""
    used = {(c.feature, c.threshold) for rule in rules for c in rule}
    if not used:
        return ()
    names = sorted(used)
    above = labelled.agg(*(F.min(F.when(feature(f) > t, feature(f))).alias(f"a{i}") for i, (f, t) in enumerate(names))).first()
    moved = {x: x[1] if above[i] is None else (x[1] + above[i]) / 2 for i, x in enumerate(names)}
    return tuple(tuple(replace(c, threshold=moved[c.feature, c.threshold]) for c in rule) for rule in rules)


def _binned(labelled: DataFrame, label: str, key: str, steps: dict[str, list[float]]) -> DataFrame:
    """Label, fold and the number of each feature's cuts below its value."""
    valued = labelled.where(F.col(label).isNotNull()).select(
        F.col(label).alias("y"), (F.pmod(F.xxhash64(key), F.lit(3)) == 0).alias("held"),
        *(feature(f).alias(f) for f in FEATURES))

    def place(f: str) -> Column:
        known = F.array(*map(F.lit, steps[f])) if steps[f] else F.array().cast("array<double>")
        return F.size(F.filter(known, lambda cut: cut < F.col(f))).alias(f"b_{f}")

    return valued.select("y", "held", *map(place, FEATURES))


def _grow(rows: DataFrame, steps: dict[str, list[float]], max_conditions: int, min_cover: int) -> tuple[Condition, ...]:
    rule: list[Condition] = []
    while len(rule) < max_conditions:
        covered = rows
        for c in rule:
            covered = covered.where(c.binned())
        bins = F.explode(F.array(*(F.struct(F.lit(f).alias("f"), F.col(f"b_{f}").alias("b")) for f in FEATURES)))
        counts = (covered.select("y", bins.alias("x")).groupBy("x.f", "x.b")
                  .agg(F.count_if("y").alias("p"), F.count_if(~F.col("y")).alias("n")).collect())
        per = {f: sorted((r.b, r.p, r.n) for r in counts if r.f == f) for f in FEATURES}
        p0, n0 = sum(p for _, p, _ in per[FEATURES[0]]), sum(n for _, _, n in per[FEATURES[0]])
        if not p0 or not n0:
            break
        best, chosen = 1e-6, None
        for f in FEATURES:
            for cut, threshold in enumerate(steps[f]):
                p = sum(x for b, x, _ in per[f] if b <= cut)
                n = sum(x for b, _, x in per[f] if b <= cut)
                for above, (cp, cn) in ((False, (p, n)), (True, (p0 - p, n0 - n))):
                    gain = cp * (_score(cp, cn) - _score(p0, n0)) if cp >= min_cover else 0
                    if gain > best:
                        best, chosen = gain, Condition(f, above, threshold, cut)
        if chosen is None:
            break
        rule.append(chosen)
    return tuple(rule)


def _prune(rows: DataFrame, rule: tuple[Condition, ...]) -> tuple[tuple[Condition, ...], int, int]:
    """The prefix of ``rule`` of greatest worth on held-back rows, with the
    rejected and kept rows that it covers there."""
    sums, fits = [], F.lit(True)
    for i, c in enumerate(rule):
        fits = fits & c.binned()
        sums += [F.count_if(fits & F.col("y")).alias(f"p{i}"), F.count_if(fits & ~F.col("y")).alias(f"n{i}")]
    got = rows.agg(*sums).first()
    worth = [((got[f"p{i}"] - got[f"n{i}"]) / max(1, got[f"p{i}"] + got[f"n{i}"]), -i) for i in range(len(rule))]
    k = -max(worth)[1]
    return rule[:k + 1], got[f"p{k}"], got[f"n{k}"]


def _labelled(stats: DataFrame, labels: DataFrame, key: str, quality: str) -> DataFrame:
    known = (labels.where(F.col(quality).isNotNull()).groupBy(key)
             .agg((F.min(quality) == 0).alias("rejected")))
    return stats.where(~base_failed()).join(known, key)


def learned(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
            quality: str = "quality") -> DecisionList:
    """The list learned from the rows of ``docs`` that have a label (quality 0: rejected).  Counts,
    not texts, are joined with the labels."""
    stats = stored(text_stats(docs, key, text), "text-stats")
    return learn(_labelled(stats, labels, key, quality), key=key)


def keep_good(docs: DataFrame, rules: DecisionList, text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that neither the base rules nor ``rules`` reject."""
    counted = docs.select(F.struct(*docs.columns).alias("__row"), F.col(text).alias("__text"))
    judged = text_stats(counted, "__row", "__text").where(~base_failed() & rules.matched().isNull())
    return judged.select("__row.*")


def judge(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
          quality: str = "quality") -> tuple[DataFrame, DecisionList]:
    """Counts, ``base_failed``, ``rule`` (number of the learned rule that rejects, or null) and
    ``kept`` for every row of ``docs``, and the list learned from those with a label (quality 0: rejected).

    Documents that fail the base rules are not used to learn, as no learned rule sees them.
    Repeated rows and null keys are judged like any other; a null key has no label.
    """
    stats = stored(text_stats(docs, key, text), "text-stats")
    rules = learn(_labelled(stats, labels, key, quality), key=key)
    judged = stats.select("*", base_failed().alias("base_failed"), rules.matched().alias("rule"))
    return judged.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull()), rules
