import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from gridcat.llm import merkle, queries

from .conftest import SF_SMALL

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string"


def sha(s: str) -> str:
    return hashlib.sha256(s.encode()).hexdigest()


def leaf_of(row, text) -> str:
    values = (row["doc_id"], row["source"], row["lang"], row["n_chars"], text)
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(digests):
    """Root and each leaf's list of (place, siblings)."""
    level, paths, owners = list(digests), [[] for _ in digests], [[i] for i in range(len(digests))]
    while len(level) > 1:
        above, above_owners = [], []
        for at in range(0, len(level), 3):
            run = level[at:at + 3]
            for i in range(len(run)):
                for o in owners[at + i]:
                    paths[o].append((i, run[:i] + run[i + 1:]))
            above.append(sha("".join(run)))
            above_owners.append(sum(owners[at:at + 3], []))
        level, owners = above, above_owners
    return level[0], paths


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r["source"], []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    built = {}
    for s in names:
        members = sorted(groups[s], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r, r["text"])))
        built[s] = (members, *tree([leaf_of(r, r["text"]) for r in members]))
    root, over = tree([built[s][1] for s in names])
    out = []
    for i, s in enumerate(names):
        members, subroot, paths = built[s]
        for r, path in zip(members, paths):
            path = path + over[i]
            leaf = leaf_of(r, r["text"])
            text = r["text"]
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0 and text is not None:
                text = text.replace("\n", "")
            now = leaf_of(r, text)
            for at, others in path:
                now = sha("".join(others[:at] + [now] + others[at:]))
            out.append((r["doc_id"], leaf, subroot, root, sha("".join("".join(o) for _, o in path)), now, now == root))
    return sorted(out, key=str)


def proven(spark, rows, **bounds):
    docs = spark.createDataFrame(rows, SCHEMA)
    altered, where = merkle.without_breaks(docs)
    got = merkle.verify(docs.withColumn("tree", F.lit("clash")), altered=altered, where=where, **bounds)
    return sorted(map(tuple, got.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root",
                                        "verified").collect()), key=str)


@pytest.mark.parametrize("n, sources", [(1, 1), (4, 1), (28, 1), (200, 7), (5, 5)])
def test_proofs(spark, n, sources):
    rows = [(i * 3, f"s{i % sources}", "en", i, f"line {i}\nnext") for i in range(n)]
    as_dicts = [dict(zip(("doc_id", "source", "lang", "n_chars", "text"), r)) for r in rows]
    assert proven(spark, rows) == brute(as_dicts)


def test_nulls_ties_and_repeats(spark):
    rows = [(None, None, None, None, None), (1, None, "", 0, ""), (1, None, "", 0, ""), (1, "é", "x", 2, "a\nb"),
            (2, "z", None, 3, "\n"), (4, "é", "x", 2, "same"), (4, "é", "y", 2, "same"), (5, "", "x", 1, "é\n1:-")]
    rows += [(10 + i, "hot", "de", i, f"t{i}\n" * (i % 3)) for i in range(100)]
    as_dicts = [dict(zip(("doc_id", "source", "lang", "n_chars", "text"), r)) for r in rows]
    got = proven(spark, rows, block_levels=2, broadcast_bytes=0)      # several passes up, joins by shuffle
    assert got == brute(as_dicts)
    assert len({r[3] for r in got}) == 1
    assert not all(r[6] for r in got) and any(r[6] for r in got)


def test_empty_table(spark):
    assert proven(spark, []) == []


def test_query(spark):
    docs = [r.asDict() for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = queries.op11_merkle(spark, SF_SMALL)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs)
