"""Catalog scans and walks: S13, S14, C1, C2, L2, A2.

A catalog is three tables - nodes (catalogs/collections), items and links -
read from JSON with fixed schemas; the tree is walked with equi joins."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gridcat import schemas
from gridcat.functions.uris import normalize_href
from gridcat.session import scratch_dir, stored

_KINDS = {"catalog": schemas.CATALOG, "collection": schemas.COLLECTION, "item": schemas.ITEM,
          "item_page": schemas.ITEM_PAGE}


def read_stac(spark: SparkSession, path: str, kind: str, glob: str = "*.json") -> DataFrame:
    """Read catalog/collection/item JSON documents (one per file) with an
    explicit schema; ``self_href`` is the file the object came from, used as
    the base for relative hrefs."""
    return (spark.read.schema(_KINDS[kind]).option("multiLine", True)
            .option("recursiveFileLookup", True).option("pathGlobFilter", glob).json(path)
            .withColumn("self_href", F.col("_metadata.file_path")))


def link_by_rel(links, rel: str) -> Column:
    """Href of the first link with the given ``rel`` (NULL when none)."""
    lk = F.col(links) if isinstance(links, str) else links
    return F.try_element_at(F.filter(lk, lambda l: l["rel"] == rel), F.lit(1))["href"]


def item_features(pages: DataFrame, max_items: int | None = None) -> DataFrame:
    """S14 + L2: explode an item page's ``features`` in file order; keep the
    first ``max_items`` (a feature of the scan, not a sampling shortcut)."""
    out = pages.select("*", F.posexplode("features").alias("pos", "feature")).drop("features")
    return out.filter(F.col("pos") < max_items) if max_items is not None else out


def walk_nodes(links: DataFrame, roots: DataFrame) -> DataFrame:
    """Every catalog and collection below each root, at any depth, as
    ``(root_id, node_id)``; roots included, a node reached twice (or through a cycle) once.

    Pointer doubling: a node knows its ancestors at distance ``d`` and the roots it
    met nearer than ``d``.  One equi join of that table with itself, at the ancestor,
    doubles ``d``; so a tree of depth 24 takes five rounds, and each is written to the
    shared folder, read by the next.  It ends when no node has an ancestor that
    far, or when a round met no new root (then no further one can, cycles or not)."""
    spark = links.sparkSession
    base = scratch_dir(spark, f"walk-{uuid.uuid4().hex}")
    up = links.where("rel = 'child'").select(F.col("child_id").alias("node_id"), F.col("parent_id").alias("far_id"))
    met = roots.where("root_id is not null").select(F.col("root_id").alias("node_id"), F.col("root_id").alias("far_id"))
    state = up.withColumn("met", F.lit(False)).unionByName(met.withColumn("met", F.lit(True))).distinct()
    schema, known, level = state.schema, 0, 0
    while True:
        count = Observation()
        path = f"{base}/round={level}"
        state.observe(count, F.count_if(F.col("met")).alias("met"), F.count_if(~F.col("met")).alias("up")).write.parquet(path)
        state = spark.read.schema(schema).parquet(path)
        found = count.get
        if not found["up"] or level and found["met"] == known:
            return state.where("met").select(F.col("far_id").alias("root_id"), "node_id")
        known, level = found["met"], level + 1
        at = state.select(F.col("node_id").alias("at_id"), F.col("far_id").alias("next_id"), F.col("met").alias("next_met"))
        jumped = state.where("not met").join(at, F.col("far_id") == F.col("at_id")).select(
            "node_id", F.col("next_id").alias("far_id"), F.col("next_met").alias("met"))
        state = state.where("met").unionByName(jumped).distinct()


def walk_catalog(links: DataFrame, roots: DataFrame) -> DataFrame:
    """Catalog -> (sub-catalogs ->) collections -> items, at any depth.

    ``links``: (parent_id, child_id, rel) with rel ``child`` or ``item``;
    ``roots``: (root_id).  The nodes are walked first (``walk_nodes``), the big
    item links joined once.  Returns (root_id, collection_id, item_id); a node
    without items is one row with a NULL item."""
    items = links.where("rel = 'item'").select(F.col("parent_id").alias("node_id"), F.col("child_id").alias("item_id"))
    return (walk_nodes(links, roots).join(items, "node_id", "left")
            .select("root_id", F.col("node_id").alias("collection_id"), "item_id"))


def catalog_counts(walked: DataFrame, assets: DataFrame, converted: str = "converted") -> DataFrame:
    """A2: nodes, items and converted assets per root and collection, with root
    totals and a grand total.

    ``walked``: see ``walk_catalog`` (nodes without items included);
    ``assets``: (item_id, converted), any number per item.  Assets are summed
    per item before the join, so an item counts once however many it has.  Items are read
    once, into one row a root and collection; the totals are summed from these rows, where a
    root's collections are distinct already, and the grand total's from one row a collection."""
    per_item = assets.groupBy("item_id").agg(F.count_if(F.col(converted)).cast("bigint").alias("_assets"))
    sums = [F.sum(c).cast("bigint").alias(c) for c in ("n_items", "assets_converted")]
    nodes = F.count("collection_id").cast("bigint").alias("n_collections")
    rows = stored(walked.join(per_item, "item_id", "left").groupBy("root_id", "collection_id").agg(
        F.count("item_id").cast("bigint").alias("n_items"),
        F.coalesce(F.sum("_assets"), F.lit(0)).cast("bigint").alias("assets_converted")), "catalog-counts")
    none = {c: F.lit(None).cast(walked.schema[c].dataType) for c in ("root_id", "collection_id")}
    single = rows.select("root_id", "collection_id", F.col("collection_id").isNotNull().cast("bigint").alias("n_collections"),
                         "n_items", "assets_converted")
    per_root = rows.groupBy("root_id").agg(nodes, *sums).withColumn("collection_id", none["collection_id"])
    total = rows.groupBy("collection_id").agg(*sums).agg(nodes, *sums, F.count("*").alias("_rows")).where("_rows > 0")
    return single.unionByName(per_root).unionByName(
        total.drop("_rows").withColumns(none))


def normalize_catalog(nodes: DataFrame, base: str = "self_href") -> DataFrame:
    """X5/X6 applied to whole documents: links and (when present) assets."""
    from gridcat.functions.uris import normalize_assets, normalize_links
    out = nodes.withColumn("links", normalize_links("links", F.col(base)))
    if "assets" in nodes.columns:
        out = out.withColumn("assets", normalize_assets("assets", F.col(base)))
    return out


__all__ = ["read_stac", "link_by_rel", "item_features", "walk_nodes", "walk_catalog", "catalog_counts",
           "normalize_catalog", "normalize_href"]
