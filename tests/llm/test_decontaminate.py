"""Pigeonhole matching against a full edit-distance scan."""

import random

from gridcat.llm import decontaminate as D
from gridcat.llm import queries

from .conftest import SF_SMALL, awkward_docs, prose


def plain_least(pattern, text, anchored=False):
    """Least edit distance of ``pattern`` to a piece of ``text``, by table."""
    row = [0] * (len(text) + 1) if not anchored else list(range(len(text) + 1))
    for i, c in enumerate(pattern, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (c != d)))
        row = new
    return row


def edited(text, n, draw):
    chars = list(text)
    for _ in range(n):
        at = draw.randrange(len(chars))
        kind = draw.choice("sid")
        if kind == "s":
            chars[at] = draw.choice("abcxyz")
        elif kind == "i":
            chars.insert(at, draw.choice("abcxyz"))
        else:
            del chars[at]
    return "".join(chars)


def test_myers_rows():
    draw = random.Random(1)
    for _ in range(400):
        p, t = ("".join(draw.choices("abc", k=draw.randint(lo, hi))) for lo, hi in ((1, 90), (0, 40)))
        for anchored in (False, True):
            assert D.myers(p, t, anchored) == plain_least(p, t, anchored)


def test_pigeonhole_misses_nothing():
    """Every item within budget is found with its least distance; none beyond."""
    draw = random.Random(2)
    items = D.prepared([(i, prose(50 + i, draw.choice([6, 12, 30]))) for i in range(12)], edit_share=0.08)
    matcher = D.Matcher(items)
    for _ in range(150):
        item = draw.choice(items)
        text = prose(draw.randrange(10 ** 6), 25) + " " + edited(item.pattern, draw.randint(0, item.budget + 3), draw) + \
            " " + prose(draw.randrange(10 ** 6), 25)
        plain = D.normalised(text)
        want = {i.item_id: min(plain_least(i.pattern, plain)) for i in items}
        got = {i: d for i, d, _, _ in matcher.find(text)}
        assert got == {i.item_id: want[i.item_id] for i in items if want[i.item_id] <= i.budget}


def test_spans_point_into_the_original():
    item = prose(3, 12)
    text = "Before, it — said:\n\n" + item.replace(" ", ",\n ").upper() + "! After é."
    ((_, distance, start, end),) = D.Matcher(D.prepared([(9, item)])).find(text)
    assert distance == 0 and D.normalised(text[start:end]) == D.normalised(item)


def test_matches_and_clean_in_blocks(spark, monkeypatch):
    items = spark.createDataFrame([(i, prose(900 + i, 20)) for i in range(8)] + [(50, None), (51, "absent"), (52, ""), (53, "-!"), (3, prose(903, 20))],
                                  "item_id long, text string")
    docs = awkward_docs(spark)
    leak = spark.createDataFrame([(20, prose(1, 30) + " " + prose(903, 20), "s", 0, 0, "r", "h"), (21, prose(905, 20) + " " + prose(907, 20), "s", 0, 0, "r", "h")],
                                 docs.schema)
    both = docs.unionByName(leak)
    want = [(20, 3, 0), (21, 5, 0), (21, 7, 0)]
    assert sorted((r.doc_id, r.item_id, r.distance) for r in D.matches(both, items).collect()) == want
    monkeypatch.setattr(D.blocks, "__defaults__", ("item_id", "text", 200))       # several blocks
    assert len(list(D.blocks(items))) > 3
    assert sorted((r.doc_id, r.item_id, r.distance) for r in D.matches(both, items).collect()) == want
    kept = D.clean(both, items)
    assert kept.columns == both.columns and sorted(map(str, kept.collect())) == sorted(map(str, docs.collect()))
    assert D.matches(both, items.limit(0)).count() == 0 and D.clean(both, items.limit(0)).count() == both.count()
    assert D.matches(both.limit(0), items).count() == 0


def test_short_items(spark):
    """Items of 1, 5 and 23 characters match as they are, as whole words, and not otherwise."""
    long_one = "a phrase of 23 letters!"
    assert len(long_one) == 23
    items = spark.createDataFrame([(1, "Q"), (5, "2+2=4"), (23, long_one), (7, "Capital of France?"), (8, "z"), (9, "paris")],
                                  "item_id long, text string")
    docs = spark.createDataFrame([(1, "Plan Q it is"), (2, "quick, as 2 2 4x is not"), (3, "so (2+2=4)."), (4, "Capital of France?"),
                                  (5, f"x {long_one.upper()} y"), (6, "a phrase of 24 letters"), (7, "parish q2"), (8, None),
                                  (9, "q q Q, 2 2 4")], "doc_id long, text string")
    got = sorted((r.doc_id, r.item_id, r.distance, r.start, r.end) for r in D.matches(docs, items).collect())
    assert got == [(1, 1, 0, 5, 6), (3, 5, 0, 4, 9), (4, 7, 0, 0, 17), (5, 23, 0, 2, 24), (9, 1, 0, 0, 1), (9, 5, 0, 7, 12)]
    assert sorted(r.doc_id for r in D.clean(docs, items).collect()) == [2, 6, 7, 8]


def test_op7_query(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()
    exact = {(d.doc_id, i.item_id) for d in docs for i in items if i.text in d.text}
    got = {(r.doc_id, r.item_id): r.distance for r in queries.op7_decontaminate(spark, SF_SMALL).collect()}
    assert exact <= set(got) and all(got[k] == 0 for k in exact)
    texts, asked = {d.doc_id: D.normalised(d.text) for d in docs}, {i.item_id: D.normalised(i.text) for i in items}
    for (d, i), distance in got.items():
        assert distance <= len(asked[i]) * D.EDIT_SHARE
        assert (d, i) in exact or distance >= 0 and D.normalised(asked[i])[:10]
    some = random.Random(3).sample(sorted(texts), 12)
    for d in some:       # whole texts against the table, for a few short documents
        if len(texts[d]) < 1500:
            for i in list(asked)[:10]:
                assert (min(plain_least(asked[i], texts[d])) <= int(len(asked[i]) * D.EDIT_SHARE)) == ((d, i) in got)
