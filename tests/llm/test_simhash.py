"""Fingerprints, links and components against brute force."""

import random
import re

import numpy as np
from xxhash import xxh64_intdigest

from gridcat.llm import queries, simhash
from gridcat.llm.components import components

from .conftest import SF_SMALL, awkward_docs


def plain_fingerprint(text, words=3):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(rb"[^\x20\x09-\x0D]+", lowered.encode())
    shingles = [b" ".join(w[i:i + words]) for i in range(len(w) - words + 1)] or ([b" ".join(w)] if w else [])
    hashes = [xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps, bits=2):
    """Root (the least) of each distinct fingerprint."""
    fps = sorted(set(fps))
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[i + 1:]:
            if (a ^ b).bit_count() <= bits:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {f: find(f) for f in fps}


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_fingerprint_and_blocks(monkeypatch):
    for text in ("", None, " \t", "one", "One TWO", "a b c", "É é É é straße A", "a b c a b c " * 40):
        assert simhash.fingerprint(text) == plain_fingerprint(text)
    monkeypatch.setattr(simhash, "_BLOCK", 7)
    assert simhash.fingerprint("p q r s t u " * 30) == plain_fingerprint("p q r s t u " * 30)


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (200, 201), (201, 200)]
    random.Random(1).shuffle(edges)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)} | {200: 200, 201: 200}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_links_tie_exactly_what_brute_force_ties(spark):
    draw = random.Random(3)
    fps = set()
    for _ in range(60):     # clusters around centres, links of 0 to 4 bits, some with crowded slots
        centre = draw.getrandbits(64)
        for _ in range(draw.choice([1, 3, 30])):
            fps.add(centre ^ sum(1 << b for b in draw.sample(range(64), draw.randint(0, 3))))
    want = plain_components(fps)
    table = spark.createDataFrame([(signed(f),) for f in fps], "fp long")
    for hot_slot in (64, 2):      # the pairing path, and the chained one
        roots = {r.node: r.root for r in components(simhash.near_pairs(table, hot_slot=hot_slot)).collect()}
        groups = {}
        for f in fps:
            groups.setdefault(roots.get(signed(f), signed(f)), set()).add(f)
        assert sorted(map(sorted, groups.values())) == sorted(
            sorted(f for f in fps if want[f] == r) for r in set(want.values()))


def test_groups_and_keep_first_on_awkward_rows(spark, tmp_path):
    docs = awkward_docs(spark)
    docs.write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    rows = docs.collect()
    roots = plain_components([plain_fingerprint(r.text) for r in rows])
    names = {}
    for r in rows:
        if r.doc_id is not None:
            root = roots[plain_fingerprint(r.text)]
            names[root] = min(names.get(root, r.doc_id), r.doc_id)
    got = simhash.groups(docs).collect()
    want = [(r.doc_id, signed(plain_fingerprint(r.text)), names.get(roots[plain_fingerprint(r.text)])) for r in rows]
    assert sorted(map(str, ((g.doc_id, g.fp, g.component) for g in got))) == sorted(map(str, want))
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    kept_roots = [roots[plain_fingerprint(r.text)] for r in kept.collect()]
    assert sorted(kept_roots) == sorted(set(roots.values()))      # one row of each component, also for equal and null keys
    assert simhash.groups(docs.limit(0)).count() == 0 and simhash.keep_first(docs.limit(0)).count() == 0


def test_op8_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    fps = {d: plain_fingerprint(t) for d, t in docs}
    roots = plain_components(fps.values())
    least = {}
    for d in sorted(fps):
        least.setdefault(roots[fps[d]], d)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op8_simhash(spark, SF_SMALL).collect()}
    assert got == {d: (f"{f:016x}", least[roots[f]]) for d, f in fps.items()}
    assert len(got) == len(docs) and np.mean([c != d for d, (_, c) in got.items()]) > 0
