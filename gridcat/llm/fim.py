"""Fill-in-middle transformation by secondary sort.

A document is cut into units, the units into prefix, middle and suffix, and
those into pieces of a bounded number of units, keyed by document and place in the
output.  ``repartitionAndSortWithinPartitions`` brings the pieces of a document
together in output order, where they are streamed into a digest (or a text) one
piece at a time.  Restoration reads that stream, finds the sentinels, keys what
stands between them by place in the original text and sorts again; the partitioner
is the same, so the second sort moves nothing between executors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Row
from pyspark.sql.types import LongType, StringType, StructField, StructType
from pyspark.sql import functions as F

SEED = 1
PLAIN_FROM, SPM_BELOW = 90, 20      # percent
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: sentinels in output order, each before the part of this rank in the text
ORDERS = {"psm": ((PREFIX, 0), (SUFFIX, 2), (MIDDLE, 1)), "spm": ((SUFFIX, 2), (PREFIX, 0), (MIDDLE, 1))}
PIECE_UNITS = 4096
PARTITION_BYTES = 16 << 20      # of text that is sorted by a task, about
_BLOCK = 1 << 22


class Units:
    """Units of a UTF-8 text, runs of ASCII letters and single other characters, found in
    blocks so that memory stays a small multiple of the text."""

    def __init__(self, data: bytes):
        self.raw = np.frombuffer(data, np.uint8)
        self._last: tuple[int, np.ndarray] | None = None
        self.before = [0]
        for at in range(0, len(self.raw), _BLOCK):
            self.before.append(self.before[-1] + len(self._starts(at)))
        self.n = self.before[-1]

    def _starts(self, at: int) -> np.ndarray:
        if self._last is None or self._last[0] != at:
            raw = self.raw[max(0, at - 1):at + _BLOCK]
            letter = ((raw | 0x20) - np.uint8(97)) < 26
            first = (raw & 0xC0) != 0x80
            first[1:] &= ~(letter[1:] & letter[:-1])
            self._last = (at, np.flatnonzero(first[1:] if at else first))
        return self._last[1]

    def offset(self, unit: int) -> int:
        """Byte where a unit starts; the text's length for the one after the last."""
        if unit >= self.n:
            return len(self.raw)
        block = int(np.searchsorted(self.before, unit, "right")) - 1
        return block * _BLOCK + int(self._starts(block * _BLOCK)[unit - self.before[block]])

    def characters(self, start: int, end: int) -> int:
        """Code points between two bytes."""
        return sum(int(np.count_nonzero((self.raw[a:min(a + _BLOCK, end)] & 0xC0) != 0x80))
                   for a in range(start, end, _BLOCK))


def chosen(key: object, n: int, data: bytes, seed: int = SEED) -> tuple[str, int, int]:
    """Form and the units at which prefix and middle end, drawn by hash of the key."""
    name = "" if key is None else str(key)
    hexed = hashlib.sha256(f"{seed}:{name}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(hexed[i:i + 8], 16) for i in range(0, 32, 8))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not data or any(s in data for s in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= PLAIN_FROM:
        return "plain", a, b
    return ("spm" if h4 % 100 < SPM_BELOW else "psm"), a, b


def pieces(place: int, key: object, data: bytes, seed: int = SEED, piece_units: int = PIECE_UNITS) -> Iterator[tuple]:
    """``((place, position), payload)`` of one document: at position -1 what is known of it, then its
    output in pieces of at most ``piece_units`` units."""
    units = Units(data)
    form, a, b = chosen(key, units.n, data, seed)
    ends = [units.offset(u) for u in (a, b)]
    counts = (None, None) if form == "plain" else (units.characters(0, ends[0]), units.characters(*ends))
    yield (place, -1), (key, units.n, form, *counts)
    spans = {0: (0, a), 1: (a, b), 2: (b, units.n)}
    position = 0
    for sentinel, rank in ORDERS.get(form, ((b"", None),)):
        if sentinel:
            yield (place, position), sentinel
            position += 1
        start, end = (0, units.n) if rank is None else spans[rank]
        at = units.offset(start)
        for unit in range(start, end, piece_units):
            to = units.offset(min(end, unit + piece_units))
            yield (place, position), data[at:to]
            position, at = position + 1, to


class Parts:
    """Cuts a streamed output at its sentinels.  Each is searched from the end of the one before; the
    text holds none, and none can begin inside a part and end outside of it."""

    def __init__(self, form: str):
        self.open = list(ORDERS.get(form, ()))
        self.rank = 0 if not self.open else None
        self.rest = b""

    def feed(self, data: bytes) -> Iterator[tuple[int, bytes]]:
        data, self.rest = self.rest + data, b""
        while self.open:
            at = data.find(self.open[0][0])
            if at < 0:
                keep = min(len(data), len(PREFIX) - 1)
                data, self.rest = data[:len(data) - keep], data[len(data) - keep:]
                break
            if at:
                yield self.rank, data[:at]
            data = data[at + len(self.open[0][0]):]
            self.rank = self.open.pop(0)[1]
        if data:
            yield self.rank, data


def _dealt(key: tuple) -> int:
    """Partition of a record: its document's place alone, well mixed."""
    x = key[0] * 0x9E3779B97F4A7C15 & (1 << 64) - 1
    return x >> 20


def _streamed(records: Iterator[tuple]) -> Iterator[tuple]:
    """Output digests and the parts of the texts, keyed by place in the text, from sorted pieces."""
    head = digest = parts = None
    place, at = None, 0
    for (owner, position), payload in records:
        if position < 0:
            if head:
                yield (place, -1, 0), (*head, digest.hexdigest())
            place, head, digest, parts, at = owner, payload, hashlib.sha256(), Parts(payload[2]), 0
            continue
        digest.update(payload)
        for rank, part in parts.feed(payload):
            yield (place, rank, at), part
            at += 1
    if head:
        yield (place, -1, 0), (*head, digest.hexdigest())


def _restored(records: Iterator[tuple]) -> Iterator[tuple]:
    """A row per document with the digest of its text, streamed in text order."""
    head = digest = None
    for (_, rank, _), payload in records:
        if rank < 0:
            if head:
                yield (*head, digest.hexdigest())
            head, digest = payload, hashlib.sha256()
        else:
            digest.update(payload)
    if head:
        yield (*head, digest.hexdigest())


def _joined(records: Iterator[tuple]) -> Iterator[tuple]:
    """A row per document with its whole output."""
    head, held = None, []
    for (_, position), payload in records:
        if position < 0:
            if head:
                yield (*head, b"".join(held).decode())
            head, held = payload, []
        else:
            held.append(payload)
    if head:
        yield (*head, b"".join(held).decode())


def sorted_pieces(docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = SEED,
                  piece_units: int = PIECE_UNITS, partitions: int | None = None):
    """The pieces of all documents (an RDD), each document's together and in output order.

    Rows are told apart by their place in the input, so repeated keys and rows stay apart and a
    hot key is spread like any other.  Partitions are sized by the bytes of the texts.  A null text counts as empty, a null key is named by
    nothing.  ``docs`` has to be a stored table, whose places a retried task finds again.
    """
    total = docs.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0
    n = partitions or max(1, -(-total // PARTITION_BYTES))
    rows = docs.select(F.monotonically_increasing_id(), F.col(key), F.col(text).cast("binary")).rdd

    def cut(found: Iterator[Row]) -> Iterator[tuple]:
        for place, k, data in found:
            yield from pieces(place, k, bytes(data or b""), seed, piece_units)

    return rows.mapPartitions(cut).repartitionAndSortWithinPartitions(n, _dealt)


def _schema(docs: DataFrame, key: str, *more: str) -> StructType:
    return StructType([StructField(key, docs.schema[key].dataType), StructField("n", LongType()),
                       StructField("form", StringType()), StructField("prefix_chars", LongType()),
                       StructField("middle_chars", LongType()), *(StructField(m, StringType()) for m in more)])


def transformed(docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = SEED,
                piece_units: int = PIECE_UNITS) -> DataFrame:
    """``key, n, form, prefix_chars, middle_chars, output`` of every row of ``docs``; see ``sorted_pieces``."""
    found = sorted_pieces(docs, key, text, seed, piece_units).mapPartitions(_joined)
    return docs.sparkSession.createDataFrame(found, _schema(docs, key, "output"), verifySchema=False)


def round_trip(docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = SEED,
               piece_units: int = PIECE_UNITS) -> DataFrame:
    """``key, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256`` of every row of
    ``docs``: digests of the output and of the text restored from it; see ``sorted_pieces``.  Plain
    rows have null counts.  No rows give no rows."""
    first = sorted_pieces(docs, key, text, seed, piece_units)
    parts = first.mapPartitions(_streamed, preservesPartitioning=True)
    again = parts.repartitionAndSortWithinPartitions(first.getNumPartitions(), _dealt)
    found = again.mapPartitions(_restored)
    return docs.sparkSession.createDataFrame(found, _schema(docs, key, "output_sha256", "restored_sha256"),
                                             verifySchema=False)
