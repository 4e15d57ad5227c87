"""BPE encoding and decoding with content-defined chunk reuse.

A rolling hash over the bytes cuts each text into chunks where the content
says so, hence shared passages give equal chunks wherever they stand.  A chunk
is encoded once per task and its ids are taken again for each later copy.  At a join
the ids of the two chunks may differ from those of the whole text, so the text
around it is encoded again, from the last break of the left chunk to the first
break of the right one, where the chunk ids and the new ids agree on a token
edge; while one side has no such break the span grows over further chunks, in
the end over the whole text.

Texts are first dealt by content (the least hash of their lines) as a
rebalance, so that copies and near copies meet in one task while Spark splits
a hot group between tasks.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bpe
from .common import Texts, worker_memory

CHUNK_BITS = 9          # a cut every 512 bytes on average
MIN_CHUNK, MAX_CHUNK = 128, 4096
_WINDOW_STEPS = 4       # the rolling hash sees 2**4 bytes
CACHED_BYTES = 16 << 20   # of chunks and their ids
CACHED_UNITS = 150_000    # of the words inside chunks that are new
ROWS_AT_ONCE = 256

# a place that the pre-tokenizer never reaches over: white space after a
# non-space character (see bpe)
_BREAK = re.compile(rb"(?<=[\x21-\x7e])[ \n]")


def cuts(data: bytes, bits: int = CHUNK_BITS) -> list[int]:
    """Ends of the content-defined chunks of ``data``, the last being its
    length.  No cut splits a character; chunks beyond MAX_CHUNK are cut there."""
    n = len(data)
    if n <= MIN_CHUNK:
        return [n] if n else []
    raw = np.frombuffer(data, np.uint8)
    h = raw.astype(np.uint32) * np.uint32(2654435761) + np.uint32(40503)
    h ^= h >> np.uint32(15)
    factor = np.uint32(0x01000193)
    with np.errstate(over="ignore"):
        for step in range(_WINDOW_STEPS):
            gap = 1 << step
            mixed = h.copy()
            mixed[gap:] += h[:-gap] * factor
            h, factor = mixed, factor * factor
    marks = np.flatnonzero((h >> np.uint32(32 - bits)) == 0) + 1
    ends, last = [], 0
    for mark in [*marks.tolist(), n]:
        while mark - last > MAX_CHUNK:
            last = _whole(raw, last + MAX_CHUNK, n)
            ends.append(last)
        if mark - last >= MIN_CHUNK and (mark := _whole(raw, mark, n)) < n:
            ends.append(mark)
            last = mark
    if last < n:
        ends.append(n)
    return ends


def _whole(raw: np.ndarray, at: int, n: int) -> int:
    """The first place from ``at`` on that starts a character."""
    while at < n and raw[at] & 0xC0 == 0x80:
        at += 1
    return at


class ChunkEncoder:
    """Encodes texts of one task; equal chunks are encoded once while the
    bounded cache holds them."""

    def __init__(self, encoder: bpe.Bpe, cached_bytes: int = CACHED_BYTES):
        self.bpe, self.cached_bytes = encoder, cached_bytes
        self.sizes = np.array([len(p) for p in encoder.pieces], np.int64)
        self.chunks: dict[bytes, tuple[bytes, int, int, int, int]] = {}
        self.held = self.met = self.reused = self.repaired = 0

    def chunk(self, data: bytes) -> tuple[bytes, int, int, int, int]:
        """Packed ids of a chunk, then its first and last break in bytes and
        as places among the ids (-1: none on which ids agree)."""
        self.met += 1
        known = self.chunks.get(data)
        if known:
            self.reused += 1
            return known
        packed = self.bpe.encode(data.decode())
        first, last = _BREAK.search(data), data.rfind(b" ")
        a = first.start() if first else -1
        while last > 0 and not (0x21 <= data[last - 1] <= 0x7E):
            last = data.rfind(b" ", 0, last)
        b = last if last > 0 else a
        at_a = at_b = -1
        if a >= 0:
            edges = np.cumsum(self.sizes[self.bpe.ids(packed)])
            at_a, at_b = int(np.searchsorted(edges, a)), int(np.searchsorted(edges, b))
            if edges[at_a] != a or edges[at_b] != b:   # no agreement inside this chunk
                a = b = at_a = at_b = -1
        known = (packed, a, b, at_a + 1, at_b + 1)
        if self.held > self.cached_bytes:
            self.chunks.clear()
            self.held = 0
        self.chunks[data] = known
        self.held += len(data) + len(packed) + 200
        return known

    def encode(self, text: str) -> bytes:
        data = text.encode()
        if bpe.odd(text):   # breaks are not certain here
            return self.bpe.encode(text)
        ends = cuts(data)
        if len(ends) < 2:
            return self.chunk(data)[0] if data else b""
        width, out, start = self.bpe.width, [], 0
        open_from = 0      # first byte whose ids are not settled
        for i, end in enumerate(ends):
            packed, a, b, at_a, at_b = self.chunk(data[start:end])
            if a >= 0:
                if open_from < start:              # a join: encode the span again
                    self.repaired += 1
                    out.append(self.bpe.encode(data[open_from:start + a].decode()))
                    left = at_a
                else:
                    left = 0
                if i == len(ends) - 1:
                    out.append(packed[left * width:])
                    open_from = end
                else:
                    out.append(packed[left * width:at_b * width])
                    open_from = start + b
            start = end
        if open_from < len(data):
            out.append(self.bpe.encode(data[open_from:].decode()))
        return b"".join(out)


def encode_decode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text",
                  keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of ``docs``: ``key``, the ``keep`` columns, ``ids``
    (array<int>) and ``decoded`` (the text those ids decode to).

    Null text counts as empty: no ids and an empty decoded text.  Repeated rows and null
    keys are kept as they are.  Order of the rows is free.
    """
    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(key, *keep).schema.fields)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        with worker_memory():
            encoder = ChunkEncoder(bpe.load(path, CACHED_UNITS))
            for whole in batches:
                for at in range(0, whole.num_rows, ROWS_AT_ONCE):      # ids and decoded texts of a few rows at a time
                    batch = whole.slice(at, ROWS_AT_ONCE)
                    packed = [encoder.encode(t) for t in Texts(batch.column(batch.schema.names.index("__text")))]
                    joined = np.frombuffer(b"".join(packed), encoder.bpe.dtype).astype(np.int32)
                    ends = np.cumsum([0, *(len(p) // encoder.bpe.width for p in packed)]).astype(np.int32)
                    decoded = pa.array([encoder.bpe.decode(p) for p in packed], pa.string())
                    yield pa.RecordBatch.from_arrays(
                        [*(batch.column(i) for i in range(batch.num_columns - 1)),
                         pa.ListArray.from_arrays(pa.array(ends), pa.array(joined)), decoded],
                        names=[*batch.schema.names[:-1], "ids", "decoded"])
            encoder.bpe.forget()
            del encoder

    return _dealt(docs, key, text, keep).mapInArrow(run, f"{out}, ids array<int>, decoded string")


def digests(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text",
            keep: tuple[str, ...] = ()) -> DataFrame:
    """``encode_decode`` reduced to ``n_tokens``, ``ids_sha256`` (decimal ids
    joined by commas) and ``decoded_sha256`` inside the task, so that neither ids nor
    texts leave it."""
    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(key, *keep).schema.fields)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        with worker_memory():
            encoder = ChunkEncoder(bpe.load(path, CACHED_UNITS))
            decimal = [str(i) for i in range(encoder.bpe.size)]
            for batch in batches:
                counts, ids_sha, text_sha = [], [], []
                for t in Texts(batch.column(batch.schema.names.index("__text"))):
                    packed = encoder.encode(t)
                    ids = encoder.bpe.ids(packed).tolist()
                    counts.append(len(ids))
                    ids_sha.append(hashlib.sha256(",".join([decimal[i] for i in ids]).encode()).hexdigest())
                    text_sha.append(hashlib.sha256(encoder.bpe.decode(packed).encode()).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i) for i in range(batch.num_columns - 1)),
                     pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())],
                    names=[*batch.schema.names[:-1], "n_tokens", "ids_sha256", "decoded_sha256"])
            encoder.bpe.forget()
            del encoder

    return _dealt(docs, key, text, keep).mapInArrow(
        run, f"{out}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def _dealt(docs: DataFrame, key: str, text: str, keep: tuple[str, ...]) -> DataFrame:
    """Texts dealt by content; AQE splits a partition that one content fills."""
    body = F.coalesce(F.col(text), F.lit(""))
    route = F.array_min(F.transform(F.split(body, "\n"), lambda line: F.xxhash64(line)))
    return (docs.select(key, *keep, body.alias("__text"), route.alias("__route"))
            .hint("rebalance", F.col("__route")).drop("__route"))
