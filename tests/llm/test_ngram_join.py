import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gridcat.llm import ngram_join

from .conftest import SF_SMALL, awkward_docs, prose


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4)))


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            least[find(i)] = min(least.get(find(i), k), k)
    return sorted(((k, len(s), least.get(find(i))) for i, ((k, _), s) in enumerate(zip(rows, sets))), key=str)


def corpus(seed, n):
    draw = random.Random(seed)
    texts = []
    passage = prose(99, 30)
    for i in range(n):
        kind = draw.random()
        if kind < 0.35 or not texts:
            texts.append(prose((seed, i).__hash__(), draw.choice([1, 2, 4, 5, 6, 7, 8, 9, 12, 20, 40, 90, 200])))
        elif kind < 0.5:
            texts.append(f"{passage} {prose((seed, i).__hash__(), draw.choice([3, 10, 40]))}")
        elif kind < 0.6:
            texts.append(draw.choice(texts).upper())
        else:       # a near copy with some words changed, dropped or added
            words = draw.choice(texts).split()
            for _ in range(draw.randint(1, 1 + len(words) // 60)):
                at = draw.randrange(len(words) + 1)
                words[at:at + draw.randint(0, 1)] = [f"new{draw.randrange(99)}"] * draw.randint(0, 2)
            texts.append(" \n".join(words))
    return [(draw.randrange(4 * n), t) for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abAB é\t\x1c ", max_size=60), st.integers(1, 6))
def test_shingles(text, words):
    parts = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    want = {tuple(parts[i:i + words]) for i in range(max(1, len(parts) - words + 1))} if parts else set()
    assert len(ngram_join.shingles(text, words)) == len(want)


def test_shingles_of_long_texts():
    text = " ".join(f"w{i % 700}" for i in range(60_000))       # several chunks, 700 shingles again and again
    found = ngram_join.shingles(text)
    assert len(found) == 700
    part = " ".join(f"w{i % 700}" for i in range(50_321, 50_321 + 704))
    assert (ngram_join.shingles(part) == found).all()


def test_pigeonhole():
    """Linked sets share a subset, and sets that are short of a segment share a neighbourhood."""
    draw, scheme = np.random.default_rng(5), ngram_join.Scheme(80)
    for _ in range(400):
        n = int(draw.integers(1, 300))
        a = np.unique(draw.integers(0, 1 << 64, n, dtype=np.uint64))
        changes = int(draw.integers(0, max(1, len(a) // 4) + 1))
        b = np.unique(np.concatenate([a[draw.permutation(len(a))[:max(1, len(a) - int(draw.integers(0, changes + 1)))]],
                                      draw.integers(0, 1 << 64, int(draw.integers(0, changes + 1)), dtype=np.uint64)]))
        common = len(np.intersect1d(a, b))
        if 100 * common < 80 * (len(a) + len(b) - common):
            continue
        apart, band = len(a) + len(b) - 2 * common, scheme.band(min(len(a), len(b)))
        # the smaller set's band is a role of both
        (segments, need), (_, need_too) = ({r[0]: r[1:] for r in scheme.roles(len(x))}[band] for x in (a, b))
        assert min(need, need_too) > apart and segments >= max(need, need_too)
        full_a, full_b = (set(ngram_join.subsets(x, band, segments)[0].tolist()) for x in (a, b))
        assert len(full_a & full_b) + 2 * apart >= len(full_a)
        agree = 0       # allowances of 2 that agree, against their sum
        sides = [ngram_join.neighbourhoods(x, band, segments) for x in (a, b)]
        for place in range(segments):
            whole, near = zip(*(({*s[(p == place) & ~l].tolist()}, {*s[p == place].tolist()}) for s, p, l in sides))
            agree += bool(whole[0] & near[1] or near[0] & whole[1])
        assert 2 * (segments - agree) <= apart


def test_sketches_never_overstate():
    draw = np.random.default_rng(7)
    for _ in range(200):
        a = np.unique(draw.integers(0, 1 << 64, int(draw.integers(1, 900)), dtype=np.uint64))
        b = np.unique(np.concatenate([a[draw.random(len(a)) < 0.8], draw.integers(0, 1 << 64, int(draw.integers(0, 900)), dtype=np.uint64)]))
        apart = len(a) + len(b) - 2 * len(np.intersect1d(a, b))
        assert ngram_join.least_differences(ngram_join.wide_sketch(a), ngram_join.wide_sketch(b)) <= apart
        assert int(np.bitwise_count((ngram_join.sketch(a) ^ ngram_join.sketch(b)).view(np.uint64)).sum()) <= apart
    assert ngram_join.least_differences(ngram_join.wide_sketch(a), ngram_join.wide_sketch(a)) == 0


@pytest.mark.parametrize("seed, mean_pairs, direct_bytes", [(1, 32, 1 << 20), (2, 1, 0), (3, 0, 0)])
def test_groups_against_brute_force(spark, seed, mean_pairs, direct_bytes):
    rows = corpus(seed, 220)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = ngram_join.groups(docs, mean_pairs=mean_pairs, direct_bytes=direct_bytes).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_awkward_rows(spark):
    docs = awkward_docs(spark)
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert sorted(map(tuple, ngram_join.groups(docs).collect()), key=str) == brute(rows)
    assert ngram_join.groups(docs.where("false")).collect() == []


def test_query(spark):
    from gridcat.llm import queries

    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.op13_ngram_join(spark, SF_SMALL)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def test_prefixes_meet():
    """Linked sets share a shingle of their prefixes, in the smaller one's lead, whatever the counts are."""
    draw = np.random.default_rng(11)
    for _ in range(400):
        n = int(draw.integers(1, 200))
        a = np.unique(draw.integers(0, 1 << 64, n, dtype=np.uint64))
        b = np.unique(np.concatenate([a[draw.random(len(a)) < draw.choice([0.85, 0.95, 1.0])],
                                      draw.integers(0, 1 << 64, int(draw.integers(0, 1 + n // 4)), dtype=np.uint64)]))
        a, b = sorted((a, b), key=len)
        common = len(np.intersect1d(a, b))
        if not common or 100 * common < 80 * (len(a) + len(b) - common):
            continue
        counts = np.zeros(int(draw.choice([16, 1024])), np.int64)
        for found in (a, b, np.concatenate([a, a[:5]])):
            np.add.at(counts, (found & np.uint64(len(counts) - 1)).astype(np.int64), 1)
        (few, lead), (many, _) = (ngram_join.prefix(x, counts, 80) for x in (a, b))
        assert len(np.intersect1d(few[lead], many))


def test_shared_passage_makes_no_rows(spark):
    """Texts of their own about a passage of all meet in its entries, yet neither entries' pairs nor rows of
    short sets grow with the square of their number."""
    passage = prose(99, 30)
    rows = [(i, f"{prose(1000 + i, 40)} {passage}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    sets = ngram_join.Sets(docs, "doc_id", "text", 5, 80)
    ids = sets.classes.select("id", "n")
    entries = ids.selectExpr("1L AS sig", "id", "n", "id AS root", "true AS lead")
    assert ngram_join._across(sets.sketched(ngram_join._mixed_entries(entries)), 80).count() == 0
    held = sets.shingles_of(ids.select("id"))
    total = ngram_join._shingle_counts(held, ngram_join._COUNTERS)
    assert total.sum() == ids.groupBy().sum("n").first()[0] and total.max() >= 60
    assert ngram_join._prefixes(held, 80).count() < 60          # shingles of a set's own are not indexed
    assert sorted(map(tuple, ngram_join.groups(docs, mean_pairs=0).collect()), key=str) == brute(rows)
