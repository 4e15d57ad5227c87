"""Dictionary-compressed WARC archives.

A Zstandard dictionary is trained on a bounded sample of the records.  Each
archive file opens with a skippable frame that embeds it, followed by one
frame per WARC record, so any record can be read alone and the file needs
nothing beside it.  Records whose payload another record holds are revisits.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shared_dir, stored
from .token_index import _file_uri, open_store

# Fixed values of the formats: the skippable frame of a WARC dictionary, the revisit profile
DICTIONARY_MAGIC = 0x184D2A5D
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

MIN_SHARED_BYTES = 1000        # smaller payloads are always written out
DICTIONARY_BYTES = 64 << 10
SAMPLE_RECORDS, SAMPLE_BYTES = 1000, 8 << 10   # records the dictionary is trained on, and characters of a piece of each
LEVEL = 3
DATE = "2024-01-01T00:00:00Z"
_CHUNK = 1 << 20


def record_bytes(page_id, url: str | None, payload: bytes, kind: str, refers_to, size: int, sha1_hex: str) -> bytes:
    """One WARC record.  A revisit has the HTTP head alone; payload size and
    digest are those of the full payload in either case."""
    head = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n").encode()
    block = head + (payload if kind == "response" else b"")
    digest = base64.b32encode(bytes.fromhex(sha1_hex)).decode()
    lines = ["WARC/1.1", f"WARC-Type: {kind}",
             f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{kind}/{sha1_hex}/{url}')}>",
             f"WARC-Date: {DATE}", "Content-Type: application/http; msgtype=response",
             f"WARC-Payload-Digest: sha1:{digest}", f"Content-Length: {len(block)}"]
    if page_id is not None:
        lines.append(f"X-Page-ID: {page_id}")
    if url is not None:
        safe = "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url)
        lines.append(f"WARC-Target-URI: {safe}")
    if kind == "revisit":
        lines.append(f"WARC-Profile: {REVISIT_PROFILE}")
        if refers_to is not None:
            lines.append(f"X-Refers-To-Page-ID: {refers_to}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """Fields of a record; the payload's digest is computed anew for a
    response, which must agree with its header."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(http.decode().rsplit("Content-Length: ", 1)[1])
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    kind = fields["WARC-Type"]
    if kind == "response" and (hashlib.sha1(payload).hexdigest() != digest or len(payload) != size):
        raise ValueError("payload and digest of a WARC record differ")
    to_int = lambda v: None if v is None else int(v)
    return {"page_id": to_int(fields.get("X-Page-ID")), "url": fields.get("WARC-Target-URI"), "payload_bytes": size,
            "payload_digest": digest, "record_type": kind, "refers_to": to_int(fields.get("X-Refers-To-Page-ID")),
            "payload": payload if kind == "response" else None}


def train_dictionary(pages: DataFrame, page_id: str = "page_id", html: str = "html", records: int = SAMPLE_RECORDS,
                     characters: int = SAMPLE_BYTES, size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary from the records, heads included, of at most ``records`` pages, chosen by hash,
    and a piece of ``characters`` of each, at a place chosen by hash: the sample is bounded; what is
    written is not.  Empty when there are too few samples to train on."""
    n = pages.count()
    part = F.pmod(F.xxhash64(html, F.lit("sample")), F.lit(1 << 20))
    wanted = min(1 << 20, -(-(1 << 20) * 2 * records // max(n, 1)))
    start = F.pmod(F.xxhash64(html, F.lit("piece")), F.greatest(F.length(html) - characters, F.lit(0)) + 1) + 1
    chosen = pages.where(F.col(html).isNotNull() & (part < wanted)).select(
        page_id, "url", F.substring(html, start.cast("int"), F.lit(characters)).alias("html"), part.alias("part")).orderBy(
        "part", page_id, "html").limit(records).collect()
    sample = [record_bytes(page, url, body, "response", None, len(body), hashlib.sha1(body).hexdigest())
              for page, url, body in ((r[0], r[1], r[2].encode()) for r in chosen)]
    if not sample:
        return b""
    try:
        return zstandard.train_dictionary(min(size, max(512, sum(map(len, sample)) // 10)), sample).as_bytes()
    except zstandard.ZstdError:
        return b""


def _compressor(dictionary: bytes):
    return zstandard.ZstdCompressor(level=LEVEL, write_checksum=True, write_content_size=True,
                                    dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)


def frames(source, chunk: int = _CHUNK) -> Iterator[bytes]:
    """Records of an archive read front to back, a frame at a time."""
    head = source.read(8)
    if len(head) < 8:
        return
    magic, size = struct.unpack("<II", head)
    if magic != DICTIONARY_MAGIC:
        raise ValueError("an archive opens with its dictionary frame")
    dictionary = source.read(size)
    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
    left = b""
    while True:
        left = left or source.read(chunk)
        if not left:
            return
        frame, parts = reader.decompressobj(), []
        while True:
            parts.append(frame.decompress(left))
            if frame.eof:
                left = frame.unused_data
                break
            left = source.read(chunk)
            if not left:
                raise ValueError("an archive ends inside a frame")
        yield b"".join(parts)


def plan_records(pages: DataFrame, page_id: str = "page_id", html: str = "html",
                 min_bytes: int = MIN_SHARED_BYTES) -> DataFrame:
    """``pages`` with ``payload_bytes``, ``payload_digest``, ``record_type`` and
    ``refers_to``.  Of records with equal payloads of at least ``min_bytes``, that with the
    largest page id is the response (null ids count as least; of equal ids the last read).
    Hot payloads: one aggregate with partial maxima, then one equi join."""
    body = F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8")
    marked = pages.select(
        page_id, "url", html, F.octet_length(F.coalesce(F.col(html), F.lit(""))).cast("bigint").alias("payload_bytes"),
        F.sha1(body).alias("payload_digest"), F.monotonically_increasing_id().alias("__at"))
    # stored, so the planner knows its size: few shared payloads leave the html where it is, many are
    # joined by a shuffle whose hot keys adaptive execution splits
    holders = stored(
        marked.where(F.col("payload_bytes") >= min_bytes).groupBy("payload_digest")
        .agg(F.max(F.struct(page_id, "__at")).alias("h"), F.count("*").alias("__n")).where("__n > 1")
        .select("payload_digest", F.col(f"h.{page_id}").alias("__holder"), F.col("h.__at").alias("__holder_at")),
        "payload-holders")
    planned = marked.join(holders, "payload_digest", "left")
    revisit = F.col("__holder_at").isNotNull() & (F.col("__holder_at") != F.col("__at"))
    return planned.select(
        page_id, "url", html, "payload_bytes", "payload_digest",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("__holder")).alias("refers_to"))


def write(pages: DataFrame, folder: str, page_id: str = "page_id", html: str = "html") -> DataFrame:
    """Write a record per row of ``pages`` (page id, url, html; null html is
    empty) under ``folder``, one archive per task, and return the list of records
    ``(page_id, file, offset, length)``, stored once: a retried task's spare file is never listed."""
    folder = _file_uri(folder)
    dictionary = train_dictionary(pages, page_id, html)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        out, name, at = None, "", 0
        compressor = _compressor(dictionary)
        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                store, base = open_store(folder)
                name = f"pages-{uuid.uuid4().hex}.warc.zst"
                store.create_dir(base, recursive=True)
                out = store.open_output_stream(f"{base}/{name}", compression=None)
                lead = struct.pack("<II", DICTIONARY_MAGIC, len(dictionary)) + dictionary
                out.write(lead)
                at = len(lead)
            offsets, lengths = [], []
            for row in zip(*(batch.column(i).to_pylist() for i in range(7))):
                page, url, text, size, digest, kind, refers_to = row
                data = compressor.compress(record_bytes(
                    page, url, (text or "").encode() if kind == "response" else b"", kind, refers_to, size, digest))
                out.write(data)
                offsets.append(at)
                lengths.append(len(data))
                at += len(data)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([name] * len(offsets)), pa.array(offsets, pa.int64()),
                 pa.array(lengths, pa.int64())], names=[page_id, "file", "offset", "length"])
        if out is not None:
            out.close()

    kind = pages.schema[page_id].dataType.simpleString()
    return stored(plan_records(pages, page_id, html).mapInArrow(
        run, f"`{page_id}` {kind}, file string, offset bigint, length bigint"), "warc-records")


def read(spark, files: DataFrame, folder: str, payloads: bool = False) -> DataFrame:
    """Records of the archives named in ``files`` (column file), read front to
    back, one archive a task: ``page_id, url, payload_bytes, payload_digest, record_type, refers_to``
    and, if asked for, the payload."""
    folder = _file_uri(folder)
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
        cols = [*names, "payload"] if payloads else names
        store, base = open_store(folder)
        for batch in batches:
            for file in batch.column(0).to_pylist():
                held, size = [], 0
                with store.open_input_stream(f"{base}/{file}", compression=None) as source:
                    for data in frames(source):
                        held.append(parse_record(data))
                        size += len(data) if payloads else 400
                        if size > 8 << 20:
                            yield pa.RecordBatch.from_arrays(
                                [pa.array([r[c] for r in held], t) for c, t in zip(cols, types)], names=cols)
                            held, size = [], 0
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[c] for r in held], t) for c, t in zip(cols, types)], names=cols)

    schema = ("page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, "
              "refers_to bigint") + (", payload binary" if payloads else "")
    archives = files.select("file").distinct()
    # the names are few bytes and the archives are not: a fixed number keeps them from being read in one task
    return archives.repartition(max(1, archives.count()), F.xxhash64("file")).mapInArrow(run, schema)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` as archives in the shared folder and read them back."""
    spark = pages.sparkSession
    folder = shared_dir(spark, "warc")
    return read(spark, write(pages, folder), folder)
