"""Counts against brute force, learning, and the emitted conditions."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from gridcat.llm import decision_list as L
from gridcat.llm import queries

from .conftest import SF_SMALL, awkward_docs, prose


def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    n, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if n[w] > 1:
            covered.update(range(i, i + 5))
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(words), sum(map(len, words)), symbols, dup, len(covered)


def counts(r):
    return r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words


def test_counts(spark):
    draw = random.Random(4)
    texts = ["".join(draw.choices(["a ", "b ", "c\n", "a b c d e ", "\n", "\t", "\x0b", "é", "🎉 ", "\x1c", "\u0085", "$", "|x| "],
                                  k=draw.randint(0, 60))) for _ in range(400)]
    texts += ["a b c d e", "a b c d e a b c d e", "x " * 3000, "same line\n" * 50, "\n\n \n", "w"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in L.text_stats(docs).collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", texts[r.doc_id])
        assert counts(r) == plain_counts(texts[r.doc_id]), repr(texts[r.doc_id])
        assert r.n_stutters == sum(a == b for a, b in zip(words, words[1:]))
    for r in L.text_stats(awkward_docs(spark).withColumn("k", F.monotonically_increasing_id()), key="k").collect():
        assert r.n_words >= 0
    by = {r.doc_id: r for r in L.text_stats(awkward_docs(spark).where("doc_id in (1, 2, 4, 5)")).collect()}
    for r in awkward_docs(spark).where("doc_id in (1, 2, 4, 5)").collect():
        assert counts(by[r.doc_id]) == plain_counts(r.text)


@pytest.fixture(scope="module")
def labelled(spark):
    """Rejected: many symbols and short words together; neither alone."""
    draw, rows = random.Random(9), []
    for i in range(600):
        symbols, short = draw.random() < 0.5, draw.random() < 0.5
        words = [("ab" if short else "abcdefgh") + ("$$" if symbols else "") for _ in range(draw.randint(20, 60))]
        rows.append((i, " ".join(words[:3] + [prose(i, 1)] + words[3:]), int(not (symbols and short))))
    return spark.createDataFrame(rows, "doc_id long, text string, quality int")


def test_learned_list_is_a_conjunction(spark, labelled):
    docs, labels = labelled.select("doc_id", "text"), labelled.select("doc_id", "quality")
    # every text repeats its windows; the base rules are looked at apart
    stats = L.text_stats(docs).join(labels, "doc_id").withColumn("rejected", F.col("quality") == 0)
    rules = L.learn(stats)
    assert 1 <= len(rules.rules) <= 3 and any(len(r) >= 2 for r in rules.rules)
    wrong = stats.where(rules.matched().isNotNull() != F.col("rejected")).count()
    assert wrong <= 6
    # thresholds stand half way between the labelled values beside them
    for c in (c for rule in rules.rules for c in rule):
        near = stats.agg(F.max(F.when(L.feature(c.feature) <= c.threshold, L.feature(c.feature))).alias("a"),
                         F.min(F.when(L.feature(c.feature) > c.threshold, L.feature(c.feature))).alias("b")).first()
        assert near.b is None or c.threshold == pytest.approx((near.a + near.b) / 2)
    assert str(rules).startswith("if ") and str(rules).endswith("else: keep")


def test_one_class_no_labels_and_awkward_rows(spark, labelled):
    stats = L.text_stats(labelled.select("doc_id", "text"))
    assert L.learn(stats.withColumn("rejected", F.lit(True))).rules == ()
    assert L.learn(stats.limit(0).withColumn("rejected", F.lit(True))).rules == ()
    docs = awkward_docs(spark)
    labels = spark.createDataFrame([(1, None), (None, 0), (4, 1), (4, 1)], "doc_id long, quality int")
    judged, rules = L.judge(docs, labels)
    assert judged.count() == docs.count() and rules.rules == ()
    kept = L.keep_good(docs, rules)
    assert kept.columns == docs.columns
    want = [r for r in docs.collect() if not ((c := plain_counts(r.text))[0] < 10 or 100 * c[4] > 20 * c[0])]
    assert sorted(map(str, kept.collect())) == sorted(map(str, want))
    assert L.judge(docs.limit(0), labels)[0].count() == 0


def test_op4_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    got = queries.op4_quality_rules(spark, SF_SMALL).collect()
    assert len(got) == len(texts)
    for r in got:
        c = plain_counts(texts[r.doc_id])
        assert counts(r) == c and r.base_failed == (c[0] < 10 or 100 * c[4] > 20 * c[0])
        assert r.kept == (not r.base_failed and r.rule is None)


def test_plan_has_no_python(spark):
    plan = queries.op4_quality_rules(spark, SF_SMALL)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
