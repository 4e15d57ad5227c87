"""The network's gradients, its windows, and held-out accuracy."""

import random
import zlib

import numpy as np
import pytest

from gridcat.llm import queries
from gridcat.llm import toxicity as T

from .conftest import SF_SMALL, awkward_docs, prose


def test_gradients_agree_with_differences(monkeypatch):
    monkeypatch.setattr(T, "BUCKETS", 64)
    network = T.Network({"alpha": 1, "beta": 2}, seed=3)
    network.p = {k: v.astype(np.float64) for k, v in network.p.items()}
    words = ["alpha", "gämma", "beta", "x"]
    rows, lengths = np.array([[0, 1, 2, 3], [2, 0, 0, 0], [3, 3, 1, 0]]), np.array([4, 1, 3])
    labels, weights = np.array([1.0, 0.0, 1.0]), np.array([1.0, 2.0, 0.5])
    hidden = np.array([False, False, True, False])
    loss = lambda: network.gradients(rows, lengths, words, labels, weights, hidden)[0]
    grad = network.gradients(rows, lengths, words, labels, weights, hidden)[1]
    draw = np.random.default_rng(0)
    for name, value in network.p.items():
        used = np.argwhere(np.abs(grad[name]) > 1e-4)
        for at in map(tuple, used[draw.permutation(len(used))[:4]]):
            before = value[at]
            value[at] = before + 1e-4
            up = loss()
            value[at] = before - 1e-4
            down = loss()
            value[at] = before
            assert grad[name][at] == pytest.approx((up - down) / 2e-4, rel=0.05, abs=2e-5), (name, at)


def test_ngrams_cover_each_word():
    words = ["a", "bcd", "é", "a"]
    grams, starts = T.ngrams(words)
    sizes = [len(w.encode()) for w in words]
    assert np.diff(starts).tolist() == [2 * s - 1 for s in sizes]
    assert grams[starts[0]:starts[1]].tolist() == grams[starts[3]:starts[4]].tolist()
    alone, _ = T.ngrams(["bcd"])
    assert grams[starts[1]:starts[2]].tolist() == alone.tolist()


def test_windows_overlap_and_blocks_agree(monkeypatch):
    scorer = T.Scorer(T.Network({}, seed=2))
    text = prose(1, 333)
    logits, owner, first = scorer.window_logits([text.split(), "two words".split()])
    assert first[owner == 0].tolist() == list(range(0, 320 - 15, 16)) and first[owner == 1].tolist() == [0]
    whole = T.Scorer(scorer.network).scores([text, "", None, prose(2, 40)])
    singles = [T.Scorer(scorer.network).scores([t])[0] for t in (text, "", None, prose(2, 40))]
    assert np.allclose(whole, singles, atol=1e-5)
    monkeypatch.setattr(T, "_BLOCK_WORDS", 64)        # a long text in parts, each window still read
    monkeypatch.setattr(T, "_CACHED_WORDS", 30)
    assert np.allclose(T.Scorer(scorer.network).scores([text, "", None, prose(2, 40)]), whole, atol=1e-5)


@pytest.fixture(scope="module")
def network():
    draw = random.Random(11)
    texts, labels = [], []
    for i in range(500):
        words, toxic = prose(i, draw.randint(30, 150)).split(), i % 4 == 0
        if toxic:
            for _ in range(3):
                bad = draw.choice(["vilething", "grossly"]) if i % 8 else "zorq" + draw.choice(["um", "ath", "ily"])
                words.insert(draw.randint(0, len(words)), bad)
        texts.append(" ".join(words))
        labels.append(int(toxic))
    return T.train(texts, labels, epochs=4)


def test_held_out_texts_and_unseen_spellings(network):
    clean = [prose(5000 + i, 200) for i in range(60)]
    toxic = [prose(6000 + i, 80) + " vilething " + prose(7000 + i, 60) for i in range(30)]
    spelled = [prose(6500 + i, 80) + " zorqesk. " + prose(7500 + i, 60) for i in range(30)]
    score = T.Scorer(network).scores
    assert (score(clean) < T.THRESHOLD).mean() > 0.95
    assert (score(toxic) >= T.THRESHOLD).mean() > 0.95
    assert (score(spelled) >= T.THRESHOLD).mean() > 0.8


def test_one_class_or_none():
    assert T.Scorer(T.train([], [])).scores(["a b", ""]).max() < 0.1
    assert T.Scorer(T.train(["a b", "c d"], [1, 1])).scores(["a b"])[0] > 0.9


def test_awkward_rows(spark, network):
    docs = awkward_docs(spark)
    got = T.score(docs, network).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    by = {r.doc_id: r.score for r in got}
    assert by[1] == by[2] == by[3]
    kept = T.drop_toxic(docs, network)
    assert kept.columns == docs.columns and kept.count() == sum(r.score < 0.3 for r in got)
    assert T.score(docs.limit(0), network).count() == 0
    labels = spark.createDataFrame([(1, 1), (None, 1), (4, None), (6, 0), (6, 1)], "doc_id long, toxic int")
    assert T.fit(docs, labels).p["b"].shape == (1,) and T.fit(docs, labels.limit(0)).p["b"][0] < 0


def test_op5_query(spark, monkeypatch):
    monkeypatch.setattr(T, "MIN_STEPS", 30)      # the query's shape; its accuracy is a matter of larger samples
    ids = [r.doc_id for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id").collect()]
    got = {r.doc_id: r for r in queries.op5_toxicity(spark, SF_SMALL).collect()}
    assert sorted(got) == sorted(ids)
    assert all(got[d].held_out == (zlib.crc32(str(d).encode()) % 4 == 2) for d in ids)
    assert all(got[d].predicted == int(got[d].score >= 0.3) for d in ids)


def test_held_out_accuracy_on_the_given_tables(spark):
    """Full training on the labelled rows of a small table, about three hundred; five of the fourteen toxic
    held-out rows hold no word that the training rows mark."""
    folder = SF_SMALL.replace("sf0.001", "sf0.01")
    docs, labels = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels"))
    network = T.fit(docs, labels)
    rows = docs.join(labels.where("toxic is not null"), "doc_id").where(T.held_out()).select("doc_id", "text", "toxic").collect()
    score = dict(zip((r.doc_id for r in rows), T.Scorer(network).scores([r.text for r in rows])))
    found = {kind: sum(score[r.doc_id] >= T.THRESHOLD for r in rows if r.toxic == kind) for kind in (0, 1)}
    assert found[1] >= 9 and found[0] <= 1, found
    plain = [r for r in rows if {"worthless", "idiot", "clown"} <= set(r.text.lower().replace(",", " ").replace(".", " ").split())]
    assert plain and all(score[r.doc_id] >= T.THRESHOLD for r in plain)      # words of strong evidence


def test_labels_of_held_out_rows_are_never_read(spark):
    docs = spark.createDataFrame([(i, prose(i, 20)) for i in range(40)], "doc_id long, text string")
    out = [i for i in range(40) if zlib.crc32(str(i).encode()) % 4 == 2]
    labels = spark.createDataFrame([(i, int(i in out)) for i in range(40)], "doc_id long, toxic int")
    assert T.fit(docs, labels).p["b"][0] == -6       # what is left has one class
