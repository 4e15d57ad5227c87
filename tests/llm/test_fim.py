import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridcat.llm import fim, queries

from .conftest import SF_SMALL


def brute(key, text, seed=1):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n = len(units)
    h = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i * 8:i * 8 + 8], 16) for i in range(4))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(units[x:y]) for x, y in ((0, a), (a, b), (b, n)))
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    if h4 % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def sha(t):
    return hashlib.sha256(t.encode()).hexdigest()


TEXTS = ["", None, "a", "<P>", "x<", "<<<S", "P><S> in it", "é\nλ words über <", "abc" * 40 + "  " + "ß" * 30,
         "one two, three <S four\r\n five" * 20, "😀a😀" * 9, "a<M" * 50]


def test_round_trip_against_brute_force(spark):
    rows = [(i if i % 13 else None, t) for i, t in enumerate(TEXTS * 12)] + [(3, "copy of it")] * 4
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("n", F.lit("clash"))
    want = sorted([(k, *(e := brute(k, t))[:4], sha(e[4]), sha(t or "")) for k, t in rows], key=str)
    for piece_units in (1, 7, 4096):
        got = fim.round_trip(docs, piece_units=piece_units).collect()
        assert sorted(map(tuple, got), key=str) == want
    out = fim.transformed(docs, piece_units=3).collect()
    assert sorted(map(tuple, out), key=str) == sorted([(k, *brute(k, t)) for k, t in rows], key=str)


def test_one_shuffle(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    first = fim.sorted_pieces(docs)
    kept = first.mapPartitions(fim._streamed, preservesPartitioning=True)
    assert kept.partitioner == first.partitioner
    assert kept.partitionBy(first.getNumPartitions(), fim._dealt) is kept      # the second sort moves nothing


@settings(max_examples=150, deadline=None)
@given(st.integers(0, 50), st.text(alphabet="ab <PSM>é\n", max_size=60), st.integers(1, 9))
def test_pieces_restore_the_text(key, text, piece_units):
    found = list(fim.pieces(7, key, text.encode(), piece_units=piece_units))
    assert [p for (_, p), _ in found] == list(range(-1, len(found) - 1))
    n, form, prefix, middle, output = brute(key, text)
    assert found[0][1] == (key, n, form, prefix, middle)
    assert b"".join(x for _, x in found[1:]).decode() == output
    parts = sorted(list(fim._streamed(iter(found))), key=lambda r: r[0])
    assert list(fim._restored(iter(parts))) == [(key, n, form, prefix, middle, sha(output), sha(text))]


def test_blocks(monkeypatch):
    text = ("abc é" * 7 + "\n").encode()
    want = [m.start() for m in re.finditer(rb"[A-Za-z]+|[\x00-\x7f]|[\xc0-\xff][\x80-\xbf]+", text)]
    for block in (1, 2, 3, 8, 1000):
        monkeypatch.setattr(fim, "_BLOCK", block)
        units = fim.Units(text)
        assert units.n == len(want) and [units.offset(i) for i in range(units.n)] == want


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert fim.round_trip(docs).collect() == [] and fim.transformed(docs).collect() == []


def test_query(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    want = sorted([(k, *(e := brute(k, t))[:4], sha(e[4]), sha(t or "")) for k, t in docs], key=str)
    assert sorted(map(tuple, queries.op12_fim(spark, SF_SMALL).collect()), key=str) == want
