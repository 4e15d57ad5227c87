"""Product-availability records and ingest summaries.

IDs: A3, A4, A5, A6, S21.  The original tool builds one message holding every
URI of a run; at scale that is an unbounded group, so here a notification is
a *table* with one row per URI (each with its first-seen order key) plus
bounded JSON messages - one per item - that a sink can send.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcat.functions.uris import item_endpoint


def endpoint_uris(assets: DataFrame, host: str, distinct: bool = False) -> DataFrame:
    """A4: one item-endpoint URI per asset (duplicates kept, as announced), or
    with ``distinct`` one row per item, of its first asset."""
    if distinct:
        rest = [c for c in assets.columns if c not in ("collection_id", "item_id")]
        first = assets.groupBy("collection_id", "item_id").agg(F.min(F.struct(*rest)).alias("_f"))
        assets = first.select("collection_id", "item_id", *(F.col(f"_f.{c}").alias(c) for c in rest))
    return assets.withColumn("ogc_uri", item_endpoint(F.lit(host), F.col("collection_id"), F.col("item_id")))


def distinct_asset_uris(assets: DataFrame, order: Sequence[str], uri: str = "uri",
                        asset_key: str = "asset", group: Sequence[str] = ()) -> DataFrame:
    """A3: distinct URIs of the assets whose key is ``asset_key``, each with the
    order key of its first occurrence (``first_*`` columns).  Aggregated
    partially per URI, so repeated URIs never pile up in one task."""
    order = list(order)
    first = F.min(F.struct(*[F.col(c) for c in order])).alias("_f")
    return (assets.filter(F.col("asset_key") == asset_key)
            .groupBy(*group, uri).agg(first)
            .select(*group, uri, *[F.col(f"_f.{c}").alias(f"first_{c}") for c in order]))


def notification_rows(assets: DataFrame, concept_id, job_id, host: str, order: Sequence[str],
                      ok_collections: DataFrame | None = None, include_failed: bool = False,
                      distinct: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    """A5 + S21: the product notice as rows ``(concept_id, job_id, kind, uri, ...)``.

    ``kind='ogc'`` rows are the per-asset item endpoints (A4), ``kind='uri'``
    rows the distinct asset URIs (A3).  When ``ok_collections`` is given only
    successfully ingested collections are announced, unless ``include_failed``
    (Q11); ``distinct`` announces an item once (Q12).  ``keep`` columns, such as
    the item to page by, go along; asset URIs are then distinct per those."""
    if ok_collections is not None and not include_failed:
        assets = assets.join(ok_collections.select("collection_id"), "collection_id", "left_semi")
    order = list(order)
    ogc = (endpoint_uris(assets, host, distinct)
           .select(*keep, F.lit("ogc").alias("kind"), F.col("ogc_uri").alias("uri"),
                   *[F.col(c).alias(f"first_{c}") for c in order]))
    uris = distinct_asset_uris(assets, order, group=keep).select(*keep, F.lit("uri").alias("kind"), "uri",
                                                                 *[f"first_{c}" for c in order])
    return (ogc.unionByName(uris)
            .select(concept_id.alias("concept_id"), job_id.alias("job_id"), "*"))


def notification_messages(rows: DataFrame, page_cols: Sequence[str], page_size: int = 10_000) -> DataFrame:
    """Bounded JSON messages: per ``page_cols`` group (e.g. per item),
    split into pages of about ``page_size`` URIs by a hash of the URI and its
    order key, each page with its URIs in first-seen order.  A hot group (one
    item holding a third of all assets, all under one endpoint URI) becomes
    many pages instead of one huge array.  A
    failed send is the sink's concern; the rows stay in the notification
    table."""
    keys = ["concept_id", "job_id", *page_cols]
    order_fields = [c for c in rows.columns if c.startswith("first_")]
    counts = rows.groupBy(*keys).agg(F.count("*").alias("_n"))
    n_pages = F.greatest(F.ceil(F.col("_n") / F.lit(page_size)), F.lit(1)).cast("bigint")
    paged = (rows.join(counts, keys)
             .withColumn("page", F.pmod(F.xxhash64("kind", "uri", *order_fields), n_pages)).drop("_n"))
    entry = F.struct(*[F.col(c) for c in order_fields], F.col("uri"))
    grouped = paged.groupBy(*keys, "page").agg(
        F.array_sort(F.collect_list(F.when(F.col("kind") == "ogc", entry))).alias("_ogc"),
        F.array_sort(F.collect_list(F.when(F.col("kind") == "uri", entry))).alias("_uris"))
    return grouped.select(*keys, "page", F.to_json(F.struct(
        F.col("concept_id"), F.transform("_ogc", lambda e: e["uri"]).alias("ogc"),
        F.transform("_uris", lambda e: e["uri"]).alias("uris"), F.col("job_id"))).alias("message"))


def ingest_summary(collections: DataFrame) -> DataFrame:
    """Collections ok and failed, items ok (sum over ok collections) and
    conflicts, one row.  Input: (collection_id, ok, n_items, n_conflicts).  The failed
    collections themselves are rows of ``failed_collections``."""
    return collections.agg(
        F.count_if(F.col("ok")).cast("bigint").alias("collections_ingested"),
        F.count_if(~F.col("ok")).cast("bigint").alias("collections_failed"),
        F.coalesce(F.sum(F.when(F.col("ok"), F.col("n_items")).otherwise(F.lit(0))), F.lit(0)).cast("bigint")
        .alias("items_ingested"),
        F.coalesce(F.sum("n_conflicts"), F.lit(0)).cast("bigint").alias("item_conflicts"))


def failed_collections(collections: DataFrame) -> DataFrame:
    """The collections that were not ingested, a row each."""
    return collections.filter(~F.col("ok")).select("collection_id", "n_items", "n_conflicts")
