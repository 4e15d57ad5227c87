"""Token ids in raw shard files with a minimal perfect hash index.

Documents are sorted by key over range partitions; each task writes one shard
of packed little-endian ids, nothing else in it, and returns a manifest row
per document.  The keys are then dealt into small buckets by hash and each
bucket gets a minimal perfect hash function: levels of bit sets in which a key
owns the first place it hits alone; its slot is the number of places owned
before.  A slot holds the key's fingerprint, shard, offset and length, so a
lookup costs a few hashes and one range read however large the corpus is; a
key that is not there is refused by its fingerprint.

A key that repeats is told apart by ``copy`` (0, 1, ...).
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import bpe
from .common import shared_dir, stored

END_ID = 2
SHARD_BYTES = 16 << 20      # of text per shard
BUCKET_KEYS = 2048          # expected keys of a bucket
PLACES_PER_KEY = 2          # of a level's bit set
MAX_LEVELS = 48


def open_store(uri: str):
    """``(filesystem, path)`` of a shared folder, whatever store holds it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def _file_uri(uri: str) -> str:
    return "file://" + uri[len("file:"):] if uri.startswith("file:") and not uri.startswith("file://") else uri


def write_shards(docs: DataFrame, path: str, folder: str, key: str = "doc_id", text: str = "text",
                 end_id: int = END_ID, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Encode and write ``docs`` in ascending ``key`` order under ``folder``.
    Returns the stored manifest ``(key, copy, shard, file, offset, n)``, offset and n in ids,
    n including the end id.  A null text is empty and a null key sorts first.

    A task writes under a name of its own and the manifest, stored once, names the file
    that counts: a retried or doubled task leaves an unused file, never a wrong one.
    """
    folder = _file_uri(folder)
    kind = docs.schema[key].dataType.simpleString()
    body = F.coalesce(F.col(text), F.lit(""))
    total = docs.agg(F.sum(F.octet_length(body))).first()[0] or 0
    shards = max(1, -(-total // shard_bytes))
    rows = docs.select(key, body.alias("__text"))
    # equal keys are spread over shards by text, equal rows by their place in the input
    order = [F.col(key).asc_nulls_first(), F.xxhash64("__text"), F.monotonically_increasing_id()]
    dealt = (rows.withColumn("__order", F.struct(*order[1:]))
             .repartitionByRange(shards, order[0], F.col("__order"))
             .sortWithinPartitions(order[0], F.col("__order"))
             .select(key, "__text", F.spark_partition_id().alias("shard")))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        encoder, out, name, at = bpe.load(path), None, "", 0
        last, copy = object(), 0
        end = np.array([end_id], encoder.dtype).tobytes()
        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                store, base = open_store(folder)
                name = f"ids-{batch.column(2)[0].as_py():06d}-{uuid.uuid4().hex}.bin"
                store.create_dir(base, recursive=True)
                out = store.open_output_stream(f"{base}/{name}")
            counts, copies = [], []
            for part in bpe.text_slices(batch.column(1)):
                ids, n = encoder.encode_column(part, end)
                out.write(ids.tobytes())
                counts.append(n)
            for k in batch.column(0).to_pylist():
                copy = copy + 1 if k == last else 0
                last = k
                copies.append(copy)
            counts = np.concatenate(counts)
            upto = at + np.cumsum(counts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(copies, pa.int64()), batch.column(2), pa.array([name] * len(counts)),
                 pa.array(upto - counts), pa.array(counts)],
                names=[key, "copy", "shard", "file", "offset", "n"])
            at = int(upto[-1])
        if out is not None:
            out.close()

    manifest = stored(dealt.mapInArrow(
        run, f"`{key}` {kind}, copy bigint, shard int, file string, offset bigint, n bigint"), "manifest")
    # a key that goes on in the next shard goes on counting there; the shards' first and last keys tell if any does
    ends = stored(manifest.groupBy("shard").agg(F.min(F.struct(key)).alias("low"), F.max(F.struct(key)).alias("high")),
                  "shard-ends")
    if ends.join(ends.select(F.col("shard").alias("next"), F.col("low").alias("first")),
                 F.col("high").eqNullSafe(F.col("first")) & (F.col("shard") < F.col("next"))).isEmpty():
        return manifest
    spans = manifest.groupBy(key, "shard").agg(F.count("*").alias("here"))
    before = F.sum("here").over(Window.partitionBy(key).orderBy("shard")) - F.col("here")
    crossing = spans.select(F.col(key).alias("__key"), F.col("shard").alias("__shard"), before.alias("before")).where(
        "before > 0")
    same = manifest[key].eqNullSafe(F.col("__key")) & (manifest["shard"] == F.col("__shard"))
    return stored(manifest.join(crossing, same, "left")
                  .select(key, (F.col("copy") + F.coalesce("before", F.lit(0))).alias("copy"),
                          "shard", "file", "offset", "n"), "manifest")


def shard_starts(manifest: DataFrame) -> DataFrame:
    """``(shard, base)``: ids in all shards before.  One row a shard, summed over shards only."""
    sizes = manifest.groupBy("shard").agg(F.sum("n").alias("size"))
    return sizes.select("shard", (F.sum("size").over(Window.orderBy("shard")) - F.col("size")).alias("base"))


def _hashes(key: str) -> tuple[Column, Column]:
    named = [F.col(key).isNull(), F.col(key), F.col("copy")]
    return F.xxhash64(*named), F.xxhash64(F.lit("fingerprint"), *named)


def _mix(h: np.ndarray, g: np.ndarray, level: int) -> np.ndarray:
    """A level's hash of keys given by two 64-bit hashes."""
    with np.errstate(over="ignore"):
        x = h + (g | np.uint64(1)) * np.uint64(2 * level + 1)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def perfect_hash(h: np.ndarray, g: np.ndarray) -> tuple[list[int], bytes]:
    """Level sizes and the packed bits of all levels for distinct keys."""
    sizes, bits = [], []
    while len(h):
        if len(sizes) == MAX_LEVELS:
            raise ValueError("keys of a bucket share both 64-bit hashes")
        size = PLACES_PER_KEY * len(h)
        place = (_mix(h, g, len(sizes)) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(place, minlength=size) == 1
        sizes.append(size)
        bits.append(alone)
        h, g = h[~alone[place]], g[~alone[place]]
    return sizes, np.packbits(np.concatenate(bits)).tobytes() if bits else b""


def slots(h: np.ndarray, g: np.ndarray, sizes: list[int], packed: bytes) -> np.ndarray:
    """Slot of each key; -1 where no level has a place for it."""
    bits = np.unpackbits(np.frombuffer(packed, np.uint8)).astype(bool)[:sum(sizes)]
    rank = np.cumsum(bits) - bits
    found, open_, start = np.full(len(h), -1, np.int64), np.arange(len(h)), 0
    for level, size in enumerate(sizes):
        place = start + (_mix(h[open_], g[open_], level) % np.uint64(size)).astype(np.int64)
        hit = bits[place]
        found[open_[hit]] = rank[place[hit]]
        open_, start = open_[~hit], start + size
    return found


INDEX_SCHEMA = ("bucket bigint, sizes array<int>, bits binary, fingerprints binary, "
                "shards binary, offsets binary, counts binary")


def build_index(manifest: DataFrame, key: str = "doc_id", bucket_keys: int = BUCKET_KEYS) -> tuple[DataFrame, int]:
    """The index, one row a bucket, and the number of buckets.  Buckets are
    dealt by hash over distinct keys, so their sizes are even."""
    buckets = max(1, -(-manifest.count() // bucket_keys))
    h, g = _hashes(key)

    def build(pdf):
        import pandas as pd

        h, g = pdf["h"].to_numpy(np.int64).view(np.uint64), pdf["g"].to_numpy(np.int64).view(np.uint64)
        sizes, bits = perfect_hash(h, g)
        order = np.argsort(slots(h, g, sizes, bits))
        row = pdf.iloc[order]
        return pd.DataFrame([{
            "bucket": pdf["bucket"].iloc[0], "sizes": sizes, "bits": bits,
            "fingerprints": (g[order] >> np.uint64(32)).astype("<u4").tobytes(),
            "shards": row["shard"].to_numpy().astype("<u4").tobytes(),
            "offsets": row["offset"].to_numpy().astype("<u8").tobytes(),
            "counts": row["n"].to_numpy().astype("<u8").tobytes()}])

    keyed = manifest.select(F.pmod(h, F.lit(buckets)).alias("bucket"), h.alias("h"), g.alias("g"),
                            "shard", "offset", "n")
    return stored(keyed.groupBy("bucket").applyInPandas(build, INDEX_SCHEMA), "key-index"), buckets


def lookup(index: DataFrame, buckets: int, keys: DataFrame, key: str = "doc_id") -> DataFrame:
    """``(key, copy, shard, offset, n)`` for each row of ``keys`` (columns key
    and copy) that the index knows; others are left out."""
    kind = keys.schema[key].dataType.simpleString()
    h, g = _hashes(key)
    asked = keys.select(F.pmod(h, F.lit(buckets)).alias("bucket"), h.alias("h"), g.alias("g"), key, "copy")

    def find(pdf, entry):
        import pandas as pd

        if not len(entry):
            return pd.DataFrame({key: pdf[key][:0], "copy": [], "shard": [], "offset": [], "n": []})
        e = entry.iloc[0]
        h, g = pdf["h"].to_numpy(np.int64).view(np.uint64), pdf["g"].to_numpy(np.int64).view(np.uint64)
        at = slots(h, g, list(e["sizes"]), e["bits"])
        prints = np.frombuffer(e["fingerprints"], "<u4")
        known = (at >= 0) & (prints[np.maximum(at, 0)] == (g >> np.uint64(32)))
        at, rows = at[known], pdf[known]
        return pd.DataFrame({
            key: rows[key].to_numpy(), "copy": rows["copy"].to_numpy(),
            "shard": np.frombuffer(e["shards"], "<u4")[at].astype(np.int32),
            "offset": np.frombuffer(e["offsets"], "<u8")[at].astype(np.int64),
            "n": np.frombuffer(e["counts"], "<u8")[at].astype(np.int64)})

    return (asked.groupBy("bucket").cogroup(index.groupBy("bucket"))
            .applyInPandas(find, f"`{key}` {kind}, copy bigint, shard int, offset bigint, n bigint"))


def read_documents(located: DataFrame, files: DataFrame, folder: str, dtype: str, value: str, measure,
                   key: str = "doc_id") -> DataFrame:
    """``located`` rows (see ``lookup``) with ``measure(packed ids)`` read from
    the shard files as a column declared by ``value`` (such as ``"crc bigint"``).  ``files``
    is ``(shard, file)``.  A task keeps one file open and reads a document at a time."""
    folder, width = _file_uri(folder), int(dtype[-1])
    kind = located.schema[key].dataType.simpleString()
    rows = located.join(files, "shard").select(key, "copy", "shard", "file", "offset", "n")

    def run(frames: Iterator) -> Iterator:
        store, base = open_store(folder)
        name, source = None, None
        for pdf in frames:
            pdf = pdf.sort_values(["shard", "offset"])
            got = []
            for file, offset, n in zip(pdf["file"], pdf["offset"], pdf["n"]):
                if file != name:
                    if source:
                        source.close()
                    name, source = file, store.open_input_file(f"{base}/{file}")
                got.append(measure(source.read_at(n * width, offset * width)))
            yield pdf.drop(columns="file").assign(**{value.split()[0]: got})

    # the rows are few bytes and the payloads are not: a fixed number keeps them from being read in one task
    return rows.repartition(max(1, files.count()), "shard", F.floor(F.col("offset") / (1 << 20))).mapInPandas(
        run, f"`{key}` {kind}, copy bigint, shard int, offset bigint, n bigint, {value}")


def crc_of_ids(dtype: str):
    """crc32 of ids as little-endian unsigned 32-bit integers."""
    return lambda packed: zlib.crc32(np.frombuffer(packed, dtype).astype("<u4").tobytes())


def index_round_trip(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text",
                     end_id: int = END_ID) -> DataFrame:
    """Write ``docs`` as shards, index every key, then find and read every
    document through the index: ``(key, start, n_tokens, ids_crc32)``."""
    spark = docs.sparkSession
    folder = shared_dir(spark, "token-shards")
    manifest = write_shards(docs, path, folder, key, text, end_id)
    index, buckets = build_index(manifest, key)
    located = lookup(index, buckets, manifest.select(key, "copy"), key)
    dtype = bpe.load(path).dtype
    files = manifest.groupBy("shard").agg(F.max("file").alias("file"))
    read = read_documents(located, files, folder, dtype, "ids_crc32 bigint", crc_of_ids(dtype), key)
    return (read.join(shard_starts(manifest), "shard")
            .select(key, (F.col("base") + F.col("offset")).alias("start"), F.col("n").alias("n_tokens"), "ids_crc32"))
