"""Catalog merge: last-wins dedupe, item insert/upsert, collection upsert,
temporal-extent union and the versioned item sink.

IDs: W1, C3, C4, C5, A1, A12, A13, S15.  Every operator is a plain
DataFrame -> DataFrame function; no row reaches the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# ---------------------------------------------------------------- W1 / A13
def dedupe_last_wins(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per ``keys``; the row that sorts last by ``order`` wins.

    Written as ``max(struct(order..., rest...))`` so Spark aggregates
    partially before the shuffle (a hot key never sends all its copies to one
    task) and ties are broken by the remaining columns, deterministically."""
    keys, order = list(keys), list(order)
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.max(F.struct(*[F.col(c) for c in order + rest])).alias("_w")
    return (df.groupBy(*keys).agg(packed)
            .select(*keys, *[F.col(f"_w.{c}").alias(c) for c in order + rest])
            .select(*df.columns))


def items_by_id(items: DataFrame, keys: Sequence[str] = ("collection_id", "item_id"),
                order: Sequence[str] = ("seq",)) -> DataFrame:
    """The id-keyed item map of a bulk request (later duplicates win)."""
    return dedupe_last_wins(items, keys, order)


# ---------------------------------------------------------------- C4 / C5
def insert_items(existing: DataFrame, new: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """C4: plain insert.  Returns ``(inserted, conflicts)``: new items whose id
    is absent, and new items whose id already exists (reported, not written)."""
    ids = existing.select(*keys)
    return new.join(ids, list(keys), "left_anti"), new.join(ids, list(keys), "left_semi")


def upsert_items(existing: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """New items replace existing ones with the same id; others are kept."""
    kept = existing.join(new.select(*keys), list(keys), "left_anti")
    return kept.unionByName(new.select(*existing.columns))


def upsert_latest(existing: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """W1 + A13 + C5 in one aggregate: the id-keyed maps of both sides (later
    rows win) and the upsert (a new item replaces an existing one) are the
    row with the largest ``(side, order..., rest...)`` per key over the union
    of both sides.  One shuffle instead of two dedupes and an anti join, and
    it is partial (hot keys are combined map-side)."""
    keys, order = list(keys), list(order)
    tagged = (existing.withColumn("_side", F.lit(0))
              .unionByName(new.select(*existing.columns).withColumn("_side", F.lit(1))))
    return dedupe_last_wins(tagged, keys, ["_side", *order]).select(*existing.columns)


def insert_status(existing: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """C4 in one aggregate: each new id is ``inserted`` or ``conflict``
    depending on whether the existing side holds it."""
    keys = list(keys)
    tagged = (existing.select(*keys, F.lit(False).alias("_new"))
              .unionByName(new.select(*keys, F.lit(True).alias("_new"))))
    agg = tagged.groupBy(*keys).agg(F.max(F.col("_new").cast("int")).alias("_n"),
                                    F.min(F.col("_new").cast("int")).alias("_e"))
    return (agg.filter(F.col("_n") == 1)
            .select(*keys, F.when(F.col("_e") == 0, F.lit("conflict")).otherwise(F.lit("inserted")).alias("status")))


# ---------------------------------------------------------------- A1 / A12
def merge_temporal_extent(intervals: DataFrame, group: Sequence[str] | str,
                          start: str = "start_ts", end: str = "end_ts",
                          keep_open: bool = False, extra_aggs: Sequence[Column] = ()) -> DataFrame:
    """A1: min and max over every non-null bound of all intervals per group;
    ``(NULL, NULL)`` when there is none.  ``keep_open`` keeps an open (NULL)
    end instead of closing the range, which the original tool does not.
    ``extra_aggs`` are computed in the same grouping (one shuffle)."""
    group = [group] if isinstance(group, str) else list(group)
    lo = F.least(F.min(start), F.min(end))
    hi = F.greatest(F.max(start), F.max(end))
    if keep_open:
        hi = F.when(F.count_if(F.col(end).isNull()) > 0, F.lit(None)).otherwise(hi)
    return intervals.groupBy(*group).agg(lo.alias("extent_start"), hi.alias("extent_end"), *extra_aggs)


def derive_collection_extent(items: DataFrame, group: str = "collection_id",
                             ts: str = "item_ts", bbox: str | None = None) -> DataFrame:
    """Collection extent from its items: time interval and, optionally,
    the union of the item bounding boxes (``bbox`` = array<double> [w,s,e,n])."""
    aggs = [F.min(ts).alias("start_ts"), F.max(ts).alias("end_ts"), F.count("*").alias("n_items")]
    if bbox:
        aggs += [F.min(F.col(bbox)[0]).alias("west"), F.min(F.col(bbox)[1]).alias("south"),
                 F.max(F.col(bbox)[2]).alias("east"), F.max(F.col(bbox)[3]).alias("north")]
    return items.groupBy(group).agg(*aggs)


# ---------------------------------------------------------------- C3
def collection_intervals(collections: DataFrame, key: str = "collection_id",
                         intervals: str = "extent.temporal.interval") -> DataFrame:
    """The temporal intervals of collection documents (``array<array<text>>``,
    an open end NULL or ``..``) as rows ``(key, start_ts, end_ts)``; a
    collection without any interval is one row of NULLs."""
    def bound(i: int) -> Column:
        text = F.get("_i", F.lit(i))
        return F.when(text != "..", F.try_to_timestamp(text))

    rows = collections.select(F.col(key), F.explode_outer(F.col(intervals)).alias("_i"))
    return rows.select(key, bound(0).cast("timestamp_ntz").alias("start_ts"),
                       bound(1).cast("timestamp_ntz").alias("end_ts"))


def upsert_collections(new: DataFrame, remote: DataFrame, new_item_counts: DataFrame,
                       key: str = "collection_id", keep_open: bool = False,
                       metadata: Sequence[str] = ()) -> DataFrame:
    """One row per collection with what the merge does.

    * in both, with new items -> ``update``: remote metadata, temporal extent
      = A1 over all intervals of both sides (the bbox is not merged);
    * in both, no new items   -> ``unchanged`` (remote extent and metadata);
    * new only                -> ``create`` with the new collection's own;
    * remote only             -> ``unchanged``.

    ``new``/``remote``: (key, start_ts, end_ts, ``metadata``...), any number of
    interval rows per collection, summed up by A1 per side before the join;
    ``new_item_counts``: (key, n_new_items)."""
    def side(rows: DataFrame, p: str) -> DataFrame:
        # an extent of one's own stays open when an interval is; a merged one closes (A1) unless ``keep_open``
        extent = merge_temporal_extent(rows, key, extra_aggs=[
            F.max(F.col("end_ts").isNull()).alias("_open"), *(F.max(F.col(c)).alias(f"{p}_{c}") for c in metadata)])
        own_end = F.when(~F.col("_open"), F.col("extent_end"))
        return extent.select(
            key, F.lit(True).alias(f"_in_{p}"), F.col("extent_start").alias(f"{p}_start"), own_end.alias(f"{p}_end"),
            (own_end if keep_open else F.col("extent_end")).alias(f"{p}_hi"), *(f"{p}_{c}" for c in metadata))

    j = side(new, "n").join(side(remote, "r"), key, "full_outer").join(new_item_counts, key, "left")
    has_items = F.coalesce(F.col("n_new_items"), F.lit(0)) > 0
    both, created = F.col("_in_n") & F.col("_in_r"), F.col("_in_r").isNull()
    lo, hi = F.least("n_start", "r_start"), F.greatest("n_hi", "r_hi")
    if keep_open:
        hi = F.when(F.col("n_hi").isNull() | F.col("r_hi").isNull(), F.lit(None)).otherwise(hi)
    action = (F.when(both & has_items, F.lit("update")).when(created, F.lit("create")).otherwise(F.lit("unchanged")))
    return j.select(
        key, action.alias("action"),
        F.when(both & has_items, lo).when(created, F.col("n_start")).otherwise(F.col("r_start")).alias("extent_start"),
        F.when(both & has_items, hi).when(created, F.col("n_end")).otherwise(F.col("r_end")).alias("extent_end"),
        F.coalesce(F.col("n_new_items"), F.lit(0)).cast("bigint").alias("n_new_items"),
        *(F.when(created, F.col(f"n_{c}")).otherwise(F.col(f"r_{c}")).alias(c) for c in metadata))


# ---------------------------------------------------------------- S15
def write_item_version(items: DataFrame, root: str, version: int,
                       partition_by: Sequence[str] = ("collection_id",)) -> str:
    """Write a merged item table as a new version folder and return it.

    Parquet has no MERGE, so a merge never overwrites the version it reads:
    it writes ``root/v=<n>`` and readers take the highest complete version
    (``latest_version``).  The ``_SUCCESS`` marker makes a version visible."""
    path = f"{root}/v={version:08d}"
    # rebalance on the partition columns: each partition is written by few
    # tasks (no small-file explosion) and AQE splits a hot partition
    items.hint("rebalance", *partition_by).write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return path


def latest_version(spark, root: str) -> int | None:
    """Highest version under ``root`` that finished writing (has ``_SUCCESS``)."""
    jvm = spark._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(root)
    fs = hpath.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(hpath):
        return None
    best = None
    for st in fs.listStatus(hpath):
        name = st.getPath().getName()
        if name.startswith("v=") and fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
            v = int(name[2:])
            best = v if best is None or v > best else best
    return best
