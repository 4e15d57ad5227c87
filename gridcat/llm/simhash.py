"""SimHash near-duplicate detection by multi-index hashing.

Fingerprints of 64 bits are cut into segments.  By the pigeonhole principle
two fingerprints that differ in at most ``k`` bits lie, in some segment, within
that segment's radius as long as the radii plus one sum to more than ``k``.
Every fingerprint probes its segment's table at all values of the small
Hamming ball of that radius; the fetched entries are verified over the whole
64 bits.  Only distinct fingerprints take part, with copies attached by an
equi join afterwards.

A table slot with many entries is not paired: its probers are linked through
the one-bit ball of the whole fingerprint instead.  Two fingerprints within
two bits share a value of those balls, and everything that shares one lies
within two bits, so tying each value's holders (65 at most) to the least is
exact and linear.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import Texts, stored, worker_memory
from .components import components

MAX_BITS = 2
SHINGLE_WORDS = 3
SEED = 42
# (first bit, bits, radius); radii plus one sum to MAX_BITS + 1
SEGMENTS = ((0, 32, 1), (32, 32, 0))
HOT_SLOT = 64
_BLOCK = 1 << 18


def fingerprint(text: str | None, words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """64-bit SimHash of ``text``: A-Z lower-cased, words cut at ASCII white space,
    a bit set where over half the shingles' XXH64 have it.  No words: zero."""
    from xxhash import xxh64_intdigest

    parts = (text or "").encode().lower().split()
    if not parts:
        return 0
    n = max(1, len(parts) - words + 1)
    counts = np.zeros(64, np.int64)
    for at in range(0, n, _BLOCK):
        block = parts[at:at + _BLOCK + words - 1] if n > 1 else parts
        shingles = zip(*(block[i:] for i in range(words))) if n > 1 else [block]
        hashes = np.array([xxh64_intdigest(b" ".join(s), seed) for s in shingles], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int32)
    on = np.flatnonzero(counts * 2 > n)
    return sum(1 << int(i) for i in on)


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS,
                 seed: int = SEED) -> DataFrame:
    """``(key, fp)`` per row; ``fp`` is the fingerprint's 64 bits as a signed long."""
    schema = StructType([StructField(key, docs.schema[key].dataType), StructField("fp", LongType())])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        with worker_memory():
            for batch in batches:
                fps = np.array([fingerprint(t, words, seed) for t in Texts(batch.column(1))], np.uint64)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], names=[key, "fp"])

    return docs.select(key, text).mapInArrow(run, schema)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def _masks(first: int, bits: int, radius: int) -> Column:
    """All changes of up to ``radius`` bits inside a segment."""
    spots = range(first, first + bits)
    masks = [sum(1 << s for s in chosen) for r in range(radius + 1) for chosen in combinations(spots, r)]
    return F.array(*(F.lit(_signed(m)).cast("bigint") for m in masks))


def near_pairs(fps: DataFrame, max_bits: int = MAX_BITS, segments=SEGMENTS, hot_slot: int = HOT_SLOT) -> DataFrame:
    """Links ``(a, b)``, ``a < b``, between distinct fingerprints of ``fps``
    (column ``fp``) that tie all within ``max_bits`` bits together: every such
    pair except in slots of over ``hot_slot`` entries, where pairs are chained
    through shared values instead."""
    if sum(r + 1 for _, _, r in segments) <= max_bits:
        raise ValueError("the segments' radii are too small for max_bits")
    if max_bits > 2:
        raise ValueError("hot slots are linked through one-bit balls: max_bits is 2 at most")
    rows, probes = [], []
    for i, (first, bits, radius) in enumerate(segments):
        part = F.col("fp").bitwiseAND(F.lit(_signed(((1 << bits) - 1) << first)))
        rows.append(fps.select(F.lit(i).alias("seg"), part.alias("slot"), F.col("fp").alias("other")))
        probes.append(fps.select("fp", F.lit(i).alias("seg"), part.alias("own"),
                                 F.explode(_masks(first, bits, radius)).alias("mask"))
                      .select("fp", "seg", F.col("own").bitwiseXOR(F.col("mask")).alias("slot")))
    entries = rows[0]
    for more in rows[1:]:
        entries = entries.unionByName(more)
    probe = probes[0]
    for more in probes[1:]:
        probe = probe.unionByName(more)
    sizes = entries.groupBy("seg", "slot").agg(F.count("*").alias("n"))
    hot = stored(sizes.where(F.col("n") > hot_slot).select("seg", "slot"), "hot-slots")
    cold = entries.join(hot, ["seg", "slot"], "left_anti")
    differ = F.bit_count(F.col("fp").bitwiseXOR(F.col("other")))
    found = (probe.join(cold, ["seg", "slot"])
             .where((F.col("fp") < F.col("other")) & (differ <= max_bits))
             .select(F.col("fp").alias("a"), F.col("other").alias("b")))
    if hot.isEmpty():
        return found.distinct()
    crowded = probe.join(hot, ["seg", "slot"], "left_semi").select("fp").distinct()
    reach = 1 if max_bits == 2 else 0
    balls = crowded.select("fp", F.explode(_masks(0, 64, reach)).alias("mask")).select(
        "fp", F.col("fp").bitwiseXOR(F.col("mask")).alias("centre"))
    if max_bits == 1:   # one bit apart: one is in the other's ball
        balls = crowded.select("fp", F.explode(_masks(0, 64, 1)).alias("mask")).select(
            "fp", F.col("fp").bitwiseXOR(F.col("mask")).alias("centre"))
        balls = balls.join(crowded.select(F.col("fp").alias("centre")), "centre", "left_semi")
        chained = balls.select(F.col("centre").alias("a"), F.col("fp").alias("b"))
    else:
        least = F.min("fp").over(Window.partitionBy("centre"))   # 65 rows at most share a centre
        chained = balls.select(least.alias("a"), F.col("fp").alias("b"))
    return found.unionByName(chained.where("a < b")).distinct()


def _rooted(classes: DataFrame, max_bits: int) -> DataFrame:
    """``(fp, root)`` for every distinct fingerprint of ``classes``; one that
    is linked to no other is its own root."""
    linked = stored(components(near_pairs(classes.select("fp"), max_bits)), "fingerprint-roots")
    alone = classes.join(linked, classes.fp == linked.node, "left_anti").select("fp", F.col("fp").alias("root"))
    return linked.select(F.col("node").alias("fp"), "root").unionByName(alone)


def groups(docs: DataFrame, key: str = "doc_id", text: str = "text", max_bits: int = MAX_BITS,
           words: int = SHINGLE_WORDS, seed: int = SEED) -> DataFrame:
    """One row per row of ``docs``: ``key``, ``fp`` and ``component``, the least
    ``key`` reachable over links of at most ``max_bits`` differing bits.

    Null, empty or blank texts have fingerprint zero and are linked like any other.
    Equal texts share a fingerprint, hence a component.  A null key is kept and
    never names a component unless all keys of it are null.
    """
    marked = stored(fingerprints(docs, key, text, words, seed), "fingerprints")
    classes = stored(marked.groupBy("fp").agg(F.min(key).alias("first")), "fingerprint-classes")
    rooted = classes.join(_rooted(classes, max_bits), "fp")
    names = rooted.groupBy("root").agg(F.min("first").alias("component"))
    named = rooted.join(names, "root").select("fp", "component")
    return marked.join(named, "fp").select(key, "fp", "component")


def keep_first(docs: DataFrame, key: str = "doc_id", text: str = "text", max_bits: int = MAX_BITS,
               words: int = SHINGLE_WORDS, seed: int = SEED) -> DataFrame:
    """One row of each component, all columns of ``docs``: that of the least
    key (null keys last), of equal keys the first read.

    ``docs`` has to be a stored table: rows are told apart by their place in
    it, so that repeated keys and repeated rows lose nothing but copies.
    """
    placed = docs.withColumn("__place", F.monotonically_increasing_id())
    sort = F.struct(F.col(key).isNull().alias("absent"), F.col(key).alias("key"), F.col("__place").alias("place"))
    marked = stored(fingerprints(placed.withColumn("__sort", sort), "__sort", text, words, seed), "fingerprints")
    classes = stored(marked.groupBy("fp").agg(F.min("__sort").alias("first")), "fingerprint-classes")
    kept = (classes.join(_rooted(classes, max_bits), "fp").groupBy("root").agg(F.min("first").alias("f"))
            .select(F.col("f.place").alias("__place")))
    return placed.join(kept, "__place", "left_semi").drop("__place")


def hex_digits(fp: Column) -> Column:
    """A fingerprint as 16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
