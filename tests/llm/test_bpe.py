"""Encoding, chunk reuse and decoding against the library; the token index
against a plain concatenation."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from gridcat.llm import bpe, chunk_bpe, queries, token_index
from gridcat.llm.common import shared_dir, tokenizer_path

from .conftest import SF_SMALL, awkward_docs, prose

PIECES = list("ab  \n\t'sS.,<|>endoftxé漢0１\x1c\x85 　🎉́") + ["<|endoftext|>", "'ll", " the", "...", "don't"]


def texts(seed, n, most):
    draw = random.Random(seed)
    return ["".join(draw.choices(PIECES, k=draw.randint(0, most))) for _ in range(n)]


def test_units_equal_the_library(tokenizer):
    encoder = bpe.Bpe(tokenizer_path(), cached_units=50)    # small, so generations turn over
    for text in [*texts(1, 3000, 30), prose(1, 300), "", "x" * 5000, " " * 300]:
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        packed = encoder.encode(text)
        assert encoder.ids(packed).tolist() == ids
        assert encoder.decode(packed) == tokenizer.decode(ids, skip_special_tokens=False)


def test_columns_equal_the_library(tokenizer):
    """op10: a column's ids are those of its texts, tails between, whatever slices it is cut into; punctuation
    after Latin letters is told apart without the library."""
    encoder = bpe.Bpe(tokenizer_path(), cached_units=50)
    marks = random.Random(5).choices([*PIECES, "*", "$$", "&#%", "ß", "é.\na", "ñ,", "!?", "\xa0", "\u2028", "\u1680"], k=20_000)
    many = [*texts(3, 2000, 30), "", " ", "a ", "".join(marks), prose(2, 300), "x" * 5000, "", " " * 300, "a b"]
    many += ["".join(marks[i:i + 9]) for i in range(0, 18_000, 9)]
    tail = np.array([2, 7], encoder.dtype).tobytes()
    want = [[*tokenizer.encode(t, add_special_tokens=False).ids, 2, 7] for t in many]
    for kind in (pa.string(), pa.large_string()):
        for slice_bytes in (50, 1 << 30):
            parts = list(bpe.text_slices(pa.array(["outside", *many], kind).slice(1), slice_bytes))
            got = [encoder.encode_column(part, tail) for part in parts]
            assert sum(map(len, parts)) == len(many) and (slice_bytes == 50) == (len(parts) > 100)
            assert np.concatenate([n for _, n in got]).tolist() == [len(w) for w in want]
            assert np.concatenate([ids for ids, _ in got]).tolist() == [i for w in want for i in w]
    ids, n = encoder.encode_column(pa.array([], pa.string()), tail)
    assert not len(ids) and not len(n) and not list(bpe.text_slices(pa.array([], pa.string())))


def test_units_of_a_column_are_looked_up_once(tokenizer):
    asked = []

    class Counting(dict):
        def __getitem__(self, unit):
            asked.append(unit)
            return b"\1\0"

    encoder = bpe.Bpe(tokenizer_path(), cached_units=50)
    encoder.spaced = Counting()
    ids, n = encoder.encode_column(pa.array(["the one and the other one"] * 100))
    assert sorted(asked) == ["and", "one", "other", "the"] and n.tolist() == [6] * 100 and len(ids) == 600


def test_decoding_ids_that_are_no_text(tokenizer):
    encoder = bpe.load(tokenizer_path())
    for ids in ([255], [160, 94], [50256, 3, 160], list(range(300))):
        packed = np.array(ids, encoder.dtype).tobytes()
        assert encoder.decode(packed) == tokenizer.decode(ids, skip_special_tokens=False)


def test_chunk_joins_are_repaired(tokenizer, monkeypatch):
    monkeypatch.setattr(chunk_bpe, "MIN_CHUNK", 4)
    monkeypatch.setattr(chunk_bpe, "MAX_CHUNK", 40)
    monkeypatch.setattr(chunk_bpe.cuts, "__defaults__", (3,))
    encoder = chunk_bpe.ChunkEncoder(bpe.load(tokenizer_path()), cached_bytes=4000)
    for text in texts(2, 3000, 120):
        assert encoder.bpe.ids(encoder.encode(text)).tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert encoder.repaired and encoder.reused


def test_cuts_follow_content_and_keep_characters():
    text = "".join(prose(i, 30) + " é漢 " for i in range(200))
    data, shifted = text.encode(), ("some words first " + text).encode()
    ends = chunk_bpe.cuts(data)
    assert ends[-1] == len(data) and all(data[a:b].decode() for a, b in zip([0, *ends], ends))
    chunks = {data[a:b] for a, b in zip([0, *ends], ends)}
    moved = chunk_bpe.cuts(shifted)
    again = {shifted[a:b] for a, b in zip([0, *moved], moved)}
    assert len(chunks & again) > 0.8 * len(chunks)
    assert chunk_bpe.cuts(b"") == [] and max(np.diff([0, *chunk_bpe.cuts(b"y" * 50_000)])) <= chunk_bpe.MAX_CHUNK


def test_encode_decode_on_awkward_rows(spark, tokenizer):
    docs = awkward_docs(spark)
    got = chunk_bpe.encode_decode(docs, tokenizer_path(), keep=("source",)).collect()
    want = [(r.doc_id, r.source, tokenizer.encode(r.text or "", add_special_tokens=False).ids) for r in docs.collect()]
    key = lambda r: (str(r[0]), str(r[1]), len(r[2]))
    assert sorted(((r.doc_id, r.source, list(r.ids)) for r in got), key=key) == sorted(want, key=key)
    assert sorted(r.decoded for r in got) == sorted(r.text or "" for r in docs.collect())
    assert chunk_bpe.encode_decode(docs.limit(0), tokenizer_path()).count() == 0


def test_op9_query(spark, tokenizer):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    want = {}
    for d, t in docs:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        want[d] = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                   hashlib.sha256(decoded.encode()).hexdigest())
    got = queries.op9_chunk_bpe(spark, SF_SMALL).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got} == want and len(got) == len(docs)


def test_perfect_hash_is_minimal_and_perfect():
    draw = np.random.default_rng(1)
    for n in (1, 2, 17, 3000):
        h, g = (draw.integers(0, 1 << 63, n).astype(np.uint64) for _ in "hg")
        sizes, bits = token_index.perfect_hash(h, g)
        assert sorted(token_index.slots(h, g, sizes, bits)) == list(range(n))


def test_index_round_trip_with_repeats(spark, tokenizer):
    """Rows that repeat a key are found one by one; null keys come first."""
    docs = awkward_docs(spark)
    got = sorted(token_index.index_round_trip(docs, tokenizer_path()).collect(), key=lambda r: r.start)
    packed = sorted((r.doc_id is not None, r.doc_id or 0, tokenizer.encode(r.text or "", add_special_tokens=False).ids + [2])
                    for r in docs.collect())
    assert [r.doc_id for r in got] == [p[1] if p[0] else None for p in packed]
    assert sorted(r.ids_crc32 for r in got) == sorted(zlib.crc32(np.array(p[2], "<u4").tobytes()) for p in packed)
    assert [r.start for r in got] == np.cumsum([0, *(r.n_tokens for r in got[:-1])]).tolist()
    assert token_index.index_round_trip(docs.limit(0), tokenizer_path()).count() == 0


def test_lookup_refuses_unknown_keys_and_files_are_raw_ids(spark, tokenizer):
    docs = spark.createDataFrame([(i, prose(i, 20)) for i in range(300)], "doc_id long, text string")
    folder = shared_dir(spark, "shards")
    manifest = token_index.write_shards(docs, tokenizer_path(), folder, shard_bytes=8000)
    index, buckets = token_index.build_index(manifest, bucket_keys=32)
    asked = spark.range(250, 400).select(F.col("id").alias("doc_id"), F.lit(0).cast("long").alias("copy"))
    found = {r.doc_id: r for r in token_index.lookup(index, buckets, asked).collect()}
    assert sorted(found) == list(range(250, 300))
    row = manifest.where("doc_id = 260").first()
    store, base = token_index.open_store(folder)
    with store.open_input_file(f"{base}/{row.file}") as f:
        ids = np.frombuffer(f.read_at(row.n * 2, row.offset * 2), "<u2").tolist()
        whole = f.size()
    assert ids == tokenizer.encode(prose(260, 20), add_special_tokens=False).ids + [2]
    assert whole == 2 * manifest.where(F.col("file") == row.file).agg(F.sum("n")).first()[0]
    assert manifest.select("shard").distinct().count() > 1


def test_op10_query(spark, tokenizer):
    got = {r.doc_id: r for r in queries.op10_token_index(spark, SF_SMALL).collect()}
    start = 0
    for d, t in sorted(map(tuple, spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect())):
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [2]
        assert (got[d].start, got[d].n_tokens, got[d].ids_crc32) == (
            start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
