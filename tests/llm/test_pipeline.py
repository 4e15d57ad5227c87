"""The corpus pipeline: each stage acts, on all that its predecessor kept."""

import hashlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as C
from gridcat.llm import decontaminate, simhash, toxicity
from gridcat.llm.common import stored, table

from .conftest import SF_SMALL
from .test_simhash import plain_components, plain_fingerprint


@pytest.fixture(scope="module")
def quick():
    before = toxicity.MIN_STEPS
    toxicity.MIN_STEPS = 60
    yield
    toxicity.MIN_STEPS = before


def test_stages(spark, tokenizer, quick):
    assert [name for name, _ in C.STAGES] == ["toxicity", "quality rules", "simhash near-dedup", "benchmark decontamination",
                                             "bpe encoding and decoding"]
    docs = table(spark, SF_SMALL, "documents")
    columns, steps = list(docs.columns), []
    for _, stage in C.STAGES[:-1]:
        docs = stored(stage(spark, docs, SF_SMALL), "stage")
        assert docs.columns == columns
        steps.append({r.doc_id: r.text for r in docs.collect()})
    assert len(steps[0]) > len(steps[1]) > len(steps[2]) >= len(steps[3]) > 0
    assert all(set(b) <= set(a) for a, b in zip(steps, steps[1:]))
    roots = plain_components([plain_fingerprint(t) for t in steps[1].values()])
    least = {}
    for d in sorted(steps[1]):
        least.setdefault(roots[plain_fingerprint(steps[1][d])], d)
    assert sorted(steps[2]) == sorted(least.values())
    items = [(r.item_id, r.text) for r in table(spark, SF_SMALL, "benchmark").collect()]
    matcher = decontaminate.Matcher(decontaminate.prepared(items))
    assert sorted(steps[3]) == [d for d, t in sorted(steps[2].items()) if not matcher.find(t)]
    last = C.STAGES[-1][1](spark, docs, SF_SMALL).collect()
    assert sorted(r.doc_id for r in last) == sorted(steps[3])
    for r in last:
        ids = tokenizer.encode(steps[3][r.doc_id], add_special_tokens=False).ids
        assert list(r.ids) == ids and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(steps[3][r.doc_id].encode()).hexdigest()
    assert sorted(r.doc_id for r in C.run(spark, SF_SMALL).collect()) == sorted(steps[3])


def test_empty_and_null_documents(spark, quick):
    none = table(spark, SF_SMALL, "documents").limit(0)
    for _, stage in C.STAGES:
        assert stage(spark, none, SF_SMALL).count() == 0
    rows = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0)], none.schema)
    rows = stored(rows, "rows")
    assert simhash.keep_first(rows).count() == 1
    for _, stage in C.STAGES:
        assert stage(spark, rows, SF_SMALL).select(F.count("*")).first()[0] >= 0
