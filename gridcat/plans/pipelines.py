"""The reference's end-to-end pipelines as DataFrame compositions: P1-P6.

Each takes and returns DataFrames; the hand-over between steps is a table
in the same plan, never a file path or a job handle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcat.functions.requests import grid_spec, parse_extent, selects_variable
from gridcat.functions.uris import feature_query_url, normalize_links, to_object_uri
from gridcat.operators import cells as CE
from gridcat.operators import grid as G
from gridcat.operators import slices as SL
from gridcat.operators import tiles as TI
from gridcat.operators.layers import reconcile
from gridcat.operators.notify import failed_collections, ingest_summary, notification_rows
from gridcat.operators.upsert import collection_intervals, insert_status, upsert_collections, upsert_items
from gridcat.session import stored
from gridcat.sources.catalog import item_features, link_by_rel, walk_catalog


def land_surface_preprocess(cells: DataFrame, coords: Mapping[str, str], variables: str,
                            scale: float = 1.0, offset: float = 0.0, cy: int = 256, cx: int = 256) -> DataFrame:
    """Coordinate rename (X17) -> variable selection (X14, pushed into the
    scan) -> unit/offset projection -> chunked store (S9)."""
    c = CE.rename_coords(cells, **coords)
    c = c.filter(selects_variable(F.lit(variables), F.col("variable")))
    c = c.withColumn("value", F.col("value") * F.lit(scale) + F.lit(offset))
    return CE.cells_to_chunks(c, ["dataset_id", "variable"], cy=cy, cx=cx)


def estuary_preprocess(points: DataFrame, grid: G.Grid, step: str = "day", level: str = "level",
                       part: str = "part", spark: SparkSession | None = None) -> DataFrame:
    """Regrid the curvilinear points (A9) per (variable, level, part, step),
    number the time slices (W5), name one file per slice and level, and route
    surface/bottom x nowcast/forecast files to their collections (W6, C10);
    files without a route stay, with NULLs.

    The regridded cells are written once: slices and level bounds then come
    from a few thousand (variable, level, step) rows, not from further passes over the points."""
    keys = ["variable", level, part, step]
    binned = stored(G.regrid_curvilinear(points, grid, keys), "regridded")
    products = binned.select(*keys).distinct()
    sliced = SL.time_slices(products, ["variable"], step)
    files = sliced.withColumn("name", F.concat_ws(
        "_", F.col("variable"), F.concat(F.lit("d"), F.col("slice").cast("string")),
        F.concat(F.lit("s"), F.col(level).cast("string")),
        F.concat(F.col(part).cast("string"), F.lit(".nc"))))
    # a row per product, read by the level bounds, the routing and the join
    files = SL.pick_levels(stored(files, "products"), [], level)   # surface/bottom over the whole model
    spark = spark or points.sparkSession
    return binned.join(SL.route_files(files, SL.routes_table(spark)), keys)


def gridding_preprocess(spark: SparkSession, points: DataFrame, extent: str, resolution: float,
                        config: str = "variable", combine: str = "mean",
                        value_digits: int | None = None) -> DataFrame:
    """Validate the extent and resolution (X23, X24), bin the points of
    every configuration (C8, A8), densify each configuration over the grid
    (C9) and combine the configurations per cell (C12, A7).

    ``value_digits``: when the values are fixed-point with that many
    decimals, the means are computed exactly (integer sums, one rounding to
    1e-6), so the result does not depend on summation order."""
    spec = spark.range(1).select(grid_spec(parse_extent(F.lit(extent)), F.lit(resolution)).alias("g")).first()["g"]
    if spec["error"] is not None:
        raise ValueError(f"invalid grid request: {spec['error']}")
    grid = G.Grid(spec["min_lon"], spec["min_lat"], spec["max_lon"], spec["max_lat"], spec["res_x"], spec["res_y"])
    if value_digits is None:
        stats = G.bin_mean(points, grid, [config])
    else:
        stats = (G.bin_mean(points.withColumn("_u", G.to_units("value", value_digits)), grid, [config], value="_u")
                 .withColumn("mean", G.exact_mean("total", "n", value_digits, 6)))
    scaffold = G.dense_scaffold(grid, points, keys=[config])
    dense = G.densify(stats, scaffold, [config])
    if value_digits is None or combine != "mean":
        return G.combine_grids(dense.select("iy", "ix", "mean"), methods=[combine])
    micro = dense.select("iy", "ix", F.round(F.col("mean") * F.lit(1000000)).cast("bigint").alias("m"))
    return micro.groupBy("iy", "ix").agg(G.exact_mean(F.sum("m"), F.count("m"), 6, 6).alias("mean"),
                                         F.count("m").cast("bigint").alias("n_grids"))


def array_ingest(arrays: DataFrame, nx: int, keys: Sequence[str], chunk: int = 256, tile: int = 256,
                 store: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Arrays -> cells (S8) -> chunks (S9) -> (concat of stores, S11) ->
    cells (S10) -> tiles (S18) + one item per product (A11).
    Returns ``(tiles, items)``."""
    cells = CE.array_to_cells(arrays, "values", nx, keep=[*keys, *([store] if store else [])])
    chunk_keys = [*keys, *([store] if store else [])]
    # the store is written once; the tiles and the items both read it
    chunks = stored(CE.cells_to_chunks(cells, chunk_keys, cy=chunk, cx=chunk), "chunk-store")
    back = CE.chunks_to_cells(chunks, chunk_keys)
    if store:
        manifest = chunks.select(store).distinct().withColumn("seq", F.col(store))
        back = CE.concat_stores(back, manifest, keys=[*keys, "y", "x"], store_col=store).drop("seq", store)
    tiles = TI.cells_to_tiles(back, keys, size=tile)
    items = TI.derive_items(back.withColumnsRenamed({"y": "lat", "x": "lon"}), keys)
    return tiles, items


def read_catalog(documents: DataFrame, pages: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The tables behind catalog documents (S13) and item pages (S14):
    ``(links, collections, assets)``.

    ``documents``: catalogs and collections (id, links, and for collections ``extent`` and ``title``);
    ``pages``: item pages with ``features``.  A document's ``self`` link (its file where it has none) is
    the base of its relative hrefs (X4, X5); documents refer to each other by href, turned into
    ids by one equi join.  ``links`` is what ``walk_catalog`` takes; ``assets`` has one row per asset of an item,
    its href rewritten to an object URI where it is one (X2, X3)."""
    base = F.coalesce(link_by_rel("links", "self"), F.col("self_href"))
    # small JSON files are opened once, not by every plan that follows
    docs = stored(documents.withColumn("base", base).withColumn("links", normalize_links("links", F.col("base"))),
                  "documents")
    hrefs = docs.select(F.col("id").alias("parent_id"), F.explode("links").alias("l")).select(
        "parent_id", F.col("l.rel").alias("rel"), F.col("l.href").alias("href"))
    child = (hrefs.where("rel = 'child'").join(docs.select(F.col("base").alias("href"), F.col("id").alias("child_id")), "href")
             .select("parent_id", "child_id", "rel"))
    features = stored(item_features(pages).select(
        F.col("feature.collection").alias("collection_id"), F.col("feature.id").alias("item_id"),
        F.to_timestamp("feature.properties.datetime").cast("timestamp_ntz").alias("item_ts"),
        F.col("feature.assets").alias("assets")), "features")
    items = features.select(F.col("collection_id").alias("parent_id"), F.col("item_id").alias("child_id"),
                            F.lit("item").alias("rel"))
    collections = (collection_intervals(docs.where("type = 'Collection'"), "id").withColumnRenamed("id", "collection_id")
                   .join(docs.select(F.col("id").alias("collection_id"), "title"), "collection_id"))
    assets = features.select("collection_id", "item_id", "item_ts", F.explode("assets").alias("asset_key", "a")).select(
        "collection_id", "item_id", "item_ts", "asset_key", F.col("a.href").alias("href"),
        to_object_uri(F.col("a.href")).alias("uri"))
    return child.unionByName(items), collections, assets


def catalog_ingest(links: DataFrame, roots: DataFrame, collections: DataFrame, assets: DataFrame,
                   remote_collections: DataFrame, remote_items: DataFrame, concept_id: str, job_id: str, host: str,
                   mode: str = "auto", include_failed: bool = False, distinct: bool = False) -> dict[str, DataFrame]:
    """P5: walk (C1) -> insert or upsert of items (C4, C5) -> collections (C3,
    A1) -> product notice (A4, A5) -> summary (A6).

    ``mode``: ``upsert`` replaces items that exist; ``insert`` fails a
    collection whose new items hold an id that exists; ``auto`` (Q8) upserts
    into collections the remote has and inserts into new ones.  Returns the
    tables ``items`` (the catalog after the run), ``collections``, ``notice``, ``per_collection``,
    ``summary`` and ``failed``."""
    if mode not in ("auto", "insert", "upsert"):
        raise ValueError(f"mode is 'auto', 'insert' or 'upsert', not {mode!r}")
    keys = ["collection_id", "item_id"]
    new = stored(walk_catalog(links, roots).where("item_id is not null").select(*keys).distinct(), "walked-items")
    known = remote_collections.select("collection_id").distinct().withColumn("_known", F.lit(True))
    inserts = {"insert": F.lit(True), "upsert": F.lit(False), "auto": F.col("_known").isNull()}[mode]
    status = insert_status(remote_items.select(*keys), new, keys)
    per = stored(
        status.groupBy("collection_id").agg(F.count("*").alias("n_items"),
                                            F.count_if(F.col("status") == "conflict").alias("_hits"))
        .join(known, "collection_id", "left")
        .select("collection_id", "n_items", F.when(inserts, F.col("_hits")).otherwise(F.lit(0)).alias("n_conflicts"))
        .withColumn("ok", F.col("n_conflicts") == 0), "per-collection")
    taken = new.join(per.where("ok").select("collection_id"), "collection_id", "left_semi")
    counts = taken.groupBy("collection_id").agg(F.count("*").alias("n_new_items"))
    announced = assets.join(new, keys, "left_semi")
    return {
        "items": upsert_items(remote_items.select(*keys), taken, keys),
        "collections": upsert_collections(collections, remote_collections, counts, metadata=["title"]),
        "notice": notification_rows(announced, F.lit(concept_id), F.lit(job_id), host, ["item_ts", "asset_key", "uri"],
                                    per.where("ok"), include_failed, distinct, keep=["collection_id"]),
        "per_collection": per,
        "summary": ingest_summary(per),
        "failed": failed_collections(per),
    }


def publish_layers(tables: DataFrame, after: DataFrame, before: DataFrame, host: str, workspace: str) -> DataFrame:
    """The tables of uploaded files, ``(file, table)``, against the layers
    found afterwards: which layer each became (U2, C7), which were there
    already (C6), the fallback when no name matched (U3), and the
    feature-query URL of what is published (X26).  One row per file and table;
    fallback layers belong to no file."""
    outcome = reconcile(tables.select(F.col("table").alias("expected")), after, before)
    named = tables.select("file", F.col("table").alias("expected")).distinct()
    rows = named.join(outcome.where("expected is not null"), "expected", "left").unionByName(
        outcome.where("expected is null").withColumn("file", F.lit(None).cast("string")))
    url = feature_query_url(F.lit(host), F.lit(workspace), F.col("layer"))
    return rows.select("file", F.col("expected").alias("table"), "outcome", "layer", "ambiguous",
                       F.when(F.col("outcome") == "published", url).alias("feature_url"))
