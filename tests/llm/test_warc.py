"""Archives written and read back."""

import hashlib
import io
import random

import pytest
import zstandard

from gridcat.llm import queries, warc
from gridcat.llm.common import shared_dir
from gridcat.llm.token_index import open_store

from .conftest import SF_SMALL, prose


def plain(rows):
    """Record type and holder of each (page_id, html)."""
    held = {}
    for i, h in rows:
        b = (h or "").encode()
        if len(b) >= 1000:
            held[b] = max(held.get(b, i), i)
    out = {}
    for i, h in rows:
        b = (h or "").encode()
        revisit = len(b) >= 1000 and held[b] != i
        out[i] = (len(b), hashlib.sha1(b).hexdigest(), "revisit" if revisit else "response", held[b] if revisit else None)
    return out


def test_round_trip(spark):
    big = "<p>" + prose(1, 400) + "</p>"
    rows = [(i, f"http://a/{i}", "<html>" + prose(i, 50 + i)) for i in range(60)]
    rows += [(100, None, big), (101, "http://b/\r\nX: y", big), (102, "http://c/é", big), (103, "http://d", None), (104, "", ""),
             (105, "http://e", "x" * 999), (106, "http://e", "x" * 999), (107, "http://f", "é" * 500), (108, "http://g", "é" * 500),
             (109, "http://h", "long " * 400_000)]
    pages = spark.createDataFrame([(*r, "z", "z") for r in rows],
                                  "page_id long, url string, html string, payload_digest string, record_type string")
    folder = shared_dir(spark, "warc-test")
    records = warc.write(pages, folder)
    back = warc.read(spark, records, folder, payloads=True).collect()
    want = plain([(i, h) for i, _, h in rows])
    assert {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in back} == want
    texts = {i: (h or "").encode() for i, _, h in rows}
    assert all(bytes(r.payload) == texts[r.page_id] for r in back if r.record_type == "response")
    assert all(r.payload is None for r in back if r.record_type == "revisit")
    assert {r.page_id: r.url for r in back}[101] == "http://b/%0D%0AX:%20y" and {r.page_id: r.url for r in back}[100] is None

    # a record is read alone, by its offset and the dictionary of its own file
    entry = records.where("page_id = 7").first()
    store, base = open_store(folder)
    with store.open_input_file(f"{base}/{entry.file}") as f:
        head = f.read_at(8, 0)
        size = int.from_bytes(head[4:], "little")
        dictionary = f.read_at(size, 8)
        frame = f.read_at(entry.length, entry.offset)
        whole = f.read_at(f.size(), 0)
    assert int.from_bytes(head[:4], "little") == warc.DICTIONARY_MAGIC and size > 0
    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))
    assert warc.parse_record(reader.decompress(frame))["page_id"] == 7
    assert sum(1 for _ in warc.frames(io.BytesIO(whole), chunk=13)) == records.where(
        records.file == entry.file).count()      # the leading frame is skipped by any reader


def test_equal_ids_repeats_and_null_ids(spark):
    big = "y" * 1200
    pages = spark.createDataFrame([(5, "u", big), (5, "u", big), (3, "v", big), (None, "w", big), (None, "n", None)],
                                  "page_id long, url string, html string")
    back = warc.round_trip(pages).collect()
    assert sorted(str((r.page_id, r.record_type, r.refers_to)) for r in back) == sorted(map(str, [
        (5, "response", None), (5, "revisit", 5), (3, "revisit", 5), (None, "revisit", 5), (None, "response", None)]))
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_dictionary_helps_and_damage_is_found(spark):
    pages = spark.createDataFrame([(i, "u", "<html><head><title>" + prose(i, 40)) for i in range(300)],
                                  "page_id long, url string, html string")
    dictionary = warc.train_dictionary(pages)
    record = warc.record_bytes(1, "u", prose(9999, 40).encode(), "response", None, len(prose(9999, 40)),
                               hashlib.sha1(prose(9999, 40).encode()).hexdigest())
    assert dictionary and len(warc._compressor(dictionary).compress(record)) < 0.8 * len(warc._compressor(b"").compress(record))
    with pytest.raises(ValueError, match="digest"):
        warc.parse_record(record.replace(prose(9999, 40)[:5].encode(), b"XXXXX"))


def test_op6_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").select("page_id", "html").collect()]
    rows_back = queries.op6_warc(spark, SF_SMALL).collect()
    assert {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows_back} == plain(rows)
    assert len(rows_back) == len(rows) and random
