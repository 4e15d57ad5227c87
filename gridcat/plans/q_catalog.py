"""Driver queries for the catalog merge (P5): upsert, extents, notices."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from gridcat.functions.uris import PATH_STYLE, VIRTUAL_STYLE, to_object_uri
from gridcat.operators.notify import failed_collections, ingest_summary, notification_messages, notification_rows
from gridcat.operators.upsert import (dedupe_last_wins, insert_items, insert_status, latest_version,
                                      merge_temporal_extent, upsert_collections, upsert_latest, write_item_version)
from gridcat.plans.pipelines import catalog_ingest, read_catalog
from gridcat.plans.registry import query
from gridcat.plans.views import table, view
from gridcat.session import scratch_dir
from gridcat.sources.catalog import read_stac

ASSET_ORDER = ["seq_ts", "part", "supp", "price"]
HOST = "https://catalog.example"
JOB_ID = "job-0000001"

# DuckDB form of to_object_uri (same two patterns, path style first).
DUCK_URI = (f"coalesce(case when regexp_matches(href, '{PATH_STYLE}') then 's3://' || "
            f"regexp_extract(href, '{PATH_STYLE}', 1) || '/' || regexp_extract(href, '{PATH_STYLE}', 2) "
            f"when regexp_matches(href, '{VIRTUAL_STYLE}') then 's3://' || regexp_extract(href, '{VIRTUAL_STYLE}', 1) "
            f"|| '/' || regexp_extract(href, '{VIRTUAL_STYLE}', 2) end, href)")

DUCK_BATCH = """
batch as (select collection_id, item_id, item_ts from v_items where side in ('new', 'both')),
existing as (select collection_id, item_id, item_ts from v_items where side in ('existing', 'both')),
dd as (select item_id, asset_key, href, seq_ts, part, supp, price from (
         select *, row_number() over (partition by item_id, asset_key
                                      order by seq_ts desc, part desc, supp desc, price desc, href desc) as rn
         from v_assets) t where rn = 1)"""


def _batch_and_existing(spark, sf):
    items = view(spark, sf, "v_items")
    batch = items.filter(F.col("side").isin("new", "both")).select("collection_id", "item_id", "item_ts")
    existing = items.filter(F.col("side").isin("existing", "both")).select("collection_id", "item_id", "item_ts")
    return batch, existing


def _batch_assets(spark, sf, batch):
    """Assets of the batch items: joined to the batch first, then W1 dedupe by
    (item, key) - the dedupe reuses the join's partitioning on ``item_id``, so
    the assets are shuffled once - then the X2/X3 rewrite."""
    assets = view(spark, sf, "v_assets").join(batch.select("item_id", "collection_id"), "item_id")
    return (dedupe_last_wins(assets, ["item_id", "asset_key"], ASSET_ORDER)
            .withColumn("uri", to_object_uri("href")))


# ------------------------------------------------------------------ flagship
@query("catalog_upsert_flagship", "W1 X2 X3 C5 A1 A2 A3 (P5)",
       views=["v_items", "v_assets", "v_collections"], oracle=f"""
, {DUCK_BATCH.strip()},
cat as (select * from existing e where not exists
          (select 1 from batch b where b.collection_id = e.collection_id and b.item_id = e.item_id)
        union all select * from batch),
a as (select b.collection_id, d.asset_key, d.href, {DUCK_URI} as uri from dd d join batch b on d.item_id = b.item_id),
ist as (select collection_id, count(*) as n_items from cat group by 1),
nst as (select collection_id, count(*) as n_new_items from batch group by 1),
ast as (select collection_id, count(*) as n_assets, count(*) filter (where uri <> href) as assets_converted,
               count(distinct case when asset_key = 'asset' then uri end) as n_asset_uris,
               min(case when asset_key = 'asset' then uri end) as min_asset_uri,
               max(case when asset_key = 'asset' then uri end) as max_asset_uri
        from a group by 1),
ext as (select collection_id, least(min(start_ts), min(end_ts)) as extent_start,
               greatest(max(start_ts), max(end_ts)) as extent_end from v_collections group by 1)
select ist.collection_id, cast(n_items as bigint) as n_items, cast(n_new_items as bigint) as n_new_items,
       cast(n_assets as bigint) as n_assets, cast(assets_converted as bigint) as assets_converted,
       cast(n_asset_uris as bigint) as n_asset_uris, min_asset_uri, max_asset_uri, extent_start, extent_end
from ist left join nst using (collection_id) left join ast using (collection_id) left join ext using (collection_id)
""")
def catalog_upsert_flagship(spark, sf):
    """Merge a batch of items into the catalog; per collection: item counts,
    converted assets, distinct asset URIs and the merged temporal extent."""
    # one scan of the items: each row enters the merge once per side it is on
    # (0 = already in the catalog, 1 = in the new batch); the upsert (C5) is
    # then one aggregate, and its winner is from the batch iff the item is
    items = view(spark, sf, "v_items")
    sides = F.filter(F.array(F.when(F.col("side").isin("existing", "both"), F.lit(0)),
                             F.when(F.col("side").isin("new", "both"), F.lit(1))), lambda x: x.isNotNull())
    tagged = items.select("collection_id", "item_id", "item_ts", F.explode(sides).alias("_side"))
    catalog = dedupe_last_wins(tagged, ["collection_id", "item_id"], ["_side", "item_ts"])
    batch = catalog.filter(F.col("_side") == 1).select("collection_id", "item_id", "item_ts")
    assets = _batch_assets(spark, sf, batch)
    is_asset = F.col("asset_key") == "asset"
    asset_stats = assets.groupBy("collection_id").agg(
        F.count("*").cast("bigint").alias("n_assets"),
        F.count_if(F.col("uri") != F.col("href")).cast("bigint").alias("assets_converted"),
        F.count_distinct(F.when(is_asset, F.col("uri"))).cast("bigint").alias("n_asset_uris"),
        F.min(F.when(is_asset, F.col("uri"))).alias("min_asset_uri"),
        F.max(F.when(is_asset, F.col("uri"))).alias("max_asset_uri"))
    item_stats = catalog.groupBy("collection_id").agg(
        F.count("*").cast("bigint").alias("n_items"), F.count_if(F.col("_side") == 1).cast("bigint").alias("n_new_items"))
    extent = merge_temporal_extent(view(spark, sf, "v_collections"), "collection_id")
    return (item_stats.join(asset_stats, "collection_id", "left")
            .join(extent, "collection_id", "left")
            .select("collection_id", "n_items", "n_new_items", "n_assets", "assets_converted",
                    "n_asset_uris", "min_asset_uri", "max_asset_uri", "extent_start", "extent_end"))


# ------------------------------------------------------------------ C3 A1 A12
@query("collection_merge", "C3 A1 A12", views=["v_items", "v_collections"], oracle="""
, n as (select collection_id, start_ts as n_start, end_ts as n_end from v_collections where side = 'new'),
r as (select collection_id, start_ts as r_start, end_ts as r_end from v_collections where side = 'remote'),
c as (select collection_id, count(*) as n_new_items, min(item_ts) as items_start, max(item_ts) as items_end
      from v_items where side in ('new', 'both') group by 1),
j as (select coalesce(n.collection_id, r.collection_id) as collection_id, n.collection_id is not null as in_new,
             r.collection_id is not null as in_remote, n_start, n_end, r_start, r_end
      from n full outer join r on n.collection_id = r.collection_id)
select j.collection_id,
       case when in_new and in_remote and coalesce(n_new_items, 0) > 0 then 'update'
            when in_new and not in_remote then 'create' else 'unchanged' end as action,
       case when in_new and in_remote and coalesce(n_new_items, 0) > 0 then least(n_start, n_end, r_start, r_end)
            when not in_remote then n_start else r_start end as extent_start,
       case when in_new and in_remote and coalesce(n_new_items, 0) > 0 then greatest(n_start, n_end, r_start, r_end)
            when not in_remote then n_end else r_end end as extent_end,
       cast(coalesce(n_new_items, 0) as bigint) as n_new_items, items_start, items_end
from j left join c on j.collection_id = c.collection_id
""")
def collection_merge(spark, sf):
    """C3 per collection (create / update / unchanged, merged extent) and the
    A12 extent derived from the batch items themselves."""
    cols = view(spark, sf, "v_collections")
    batch, _ = _batch_and_existing(spark, sf)
    from gridcat.operators.upsert import derive_collection_extent
    derived = derive_collection_extent(batch).select(
        "collection_id", F.col("n_items").alias("n_new_items"),
        F.col("start_ts").alias("items_start"), F.col("end_ts").alias("items_end"))
    merged = upsert_collections(cols.filter(F.col("side") == "new"), cols.filter(F.col("side") == "remote"),
                                derived.select("collection_id", "n_new_items"))
    return merged.join(derived.drop("n_new_items"), "collection_id", "left")


# lineitem rows as catalog items: (orderkey, linenumber) repeats, so W1 is real
LI_ITEMS = """
select 'COL_' || l_returnflag as collection_id,
       cast(l_orderkey as string) || '-' || cast(l_linenumber as string) as item_id,
       case when l_suppkey % 2 = 0 then 'existing' else 'new' end as side,
       l_shipdate as item_ts, l_partkey as part, l_suppkey as supp, l_extendedprice as price, l_quantity as qty
from {lineitem}"""
ITEM_KEYS = ["collection_id", "item_id"]
ITEM_ORDER = ["item_ts", "part", "supp", "price"]


def _li_items(spark, sf):
    return spark.sql(LI_ITEMS.format(lineitem=f"parquet.`{sf}/lineitem.parquet`"))


DUCK_LI = f"""
, li as ({LI_ITEMS.format(lineitem='lineitem')}),
ex as (select * exclude (rn) from (select *, row_number() over (partition by collection_id, item_id
        order by item_ts desc, part desc, supp desc, price desc, side desc, qty desc) as rn
        from li where side = 'existing') t where rn = 1),
nw as (select * exclude (rn) from (select *, row_number() over (partition by collection_id, item_id
        order by item_ts desc, part desc, supp desc, price desc, side desc, qty desc) as rn
        from li where side = 'new') t where rn = 1)"""


@query("item_upsert", "C5 W1 A13", oracle=DUCK_LI.lstrip("\n, ").replace("li as", "with li as", 1) + """
select * from ex where not exists (select 1 from nw where nw.collection_id = ex.collection_id and nw.item_id = ex.item_id)
union all select * from nw
""")
def item_upsert(spark, sf):
    """A13 id-keyed maps of both sides (last wins) and the C5 upsert by id,
    as one aggregate over both sides."""
    li = _li_items(spark, sf)
    return upsert_latest(li.filter(F.col("side") == "existing"), li.filter(F.col("side") == "new"),
                         ITEM_KEYS, ITEM_ORDER)


@query("item_insert_conflicts", "C4", oracle=DUCK_LI.lstrip("\n, ").replace("li as", "with li as", 1) + """
select collection_id, item_id, case when exists (select 1 from ex where ex.collection_id = nw.collection_id
         and ex.item_id = nw.item_id) then 'conflict' else 'inserted' end as status
from nw
""")
def item_insert_conflicts(spark, sf):
    """C4 plain insert: every new item is either inserted or a conflict."""
    li = _li_items(spark, sf)
    return insert_status(li.filter(F.col("side") == "existing"), li.filter(F.col("side") == "new"), ITEM_KEYS)


@query("item_versions", "S15 C5 W1", oracle=DUCK_LI.lstrip("\n, ").replace("li as", "with li as", 1) + """
select cast(1 as bigint) as version, * from (
  select * from ex where not exists (select 1 from nw where nw.collection_id = ex.collection_id and nw.item_id = ex.item_id)
  union all select * from nw) t
""")
def item_versions(spark, sf):
    """The existing items written as version 0 and the upsert over them as
    version 1; readers take the highest complete version."""
    root = scratch_dir(spark, f"items-{uuid.uuid4().hex}")
    li = _li_items(spark, sf)
    first = write_item_version(dedupe_last_wins(li.filter(F.col("side") == "existing"), ITEM_KEYS, ITEM_ORDER), root, 0)
    cols = ["collection_id", "item_id", "side", "item_ts", "part", "supp", "price", "qty"]
    merged = upsert_latest(spark.read.parquet(first).select(*cols), li.filter(F.col("side") == "new").select(*cols),
                           ITEM_KEYS, ITEM_ORDER)
    write_item_version(merged, root, 1)
    version = latest_version(spark, root)
    return (spark.read.parquet(f"{root}/v={version:08d}")
            .select(F.lit(version).cast("bigint").alias("version"), *cols))


# ------------------------------------------------------------------ A3 A4 A5 S21
@query("notifications", "A3 A4 A5 S21", views=["v_items", "v_assets"], oracle=f"""
, {DUCK_BATCH.strip()},
a as (select b.collection_id, d.item_id, d.asset_key, {DUCK_URI} as uri, d.seq_ts, d.part, d.supp, d.price
      from dd d join batch b on d.item_id = b.item_id),
u as (select * from (select uri, seq_ts, part, supp, price, row_number() over (partition by uri
        order by seq_ts, part, supp, price) as rn from a where asset_key = 'asset') t where rn = 1)
select 'CON_1' as concept_id, '{JOB_ID}' as job_id, 'ogc' as kind,
       '{HOST}/stac/collections/' || collection_id || '/items/' || item_id as uri,
       seq_ts as first_seq_ts, part as first_part, supp as first_supp, price as first_price from a
union all
select 'CON_1', '{JOB_ID}', 'uri', uri, seq_ts, part, supp, price from u
""")
def notifications(spark, sf):
    """The product notice of a batch as rows: per-asset endpoints and distinct
    asset URIs with their first-seen order keys."""
    batch, _ = _batch_and_existing(spark, sf)
    assets = _batch_assets(spark, sf, batch)
    return notification_rows(assets, F.lit("CON_1"), F.lit(JOB_ID), HOST, ASSET_ORDER)


PAGE = 50


@query("notification_pages", "S21 A4 Q12", views=["v_items", "v_assets"], oracle=f"""
, {DUCK_BATCH.strip()},
a as (select b.collection_id, d.item_id, d.asset_key, {DUCK_URI} as uri from dd d join batch b on d.item_id = b.item_id)
select collection_id, 'ogc' as kind, '{HOST}/stac/collections/' || collection_id || '/items/' || item_id as uri,
       cast(count(*) as bigint) as n, true as bounded from a group by collection_id, item_id
union all
select collection_id, 'uri', uri, cast(1 as bigint), true from (
  select distinct collection_id, uri from a where asset_key = 'asset') t
""")
def notification_pages(spark, sf):
    """The notice of each collection as JSON messages of about 50 URIs,
    parsed again: every URI is there as often as announced, and no page is
    beyond twice its size, however many URIs a collection has."""
    batch, _ = _batch_and_existing(spark, sf)
    assets = _batch_assets(spark, sf, batch)
    rows = notification_rows(assets, F.lit("CON_1"), F.lit(JOB_ID), HOST, ASSET_ORDER, keep=["collection_id"])
    pages = notification_messages(rows, ["collection_id"], PAGE)
    parsed = pages.select("collection_id", F.from_json("message", "ogc array<string>, uris array<string>").alias("m"))
    each = F.concat(F.transform("m.ogc", lambda u: F.struct(F.lit("ogc").alias("kind"), u.alias("uri"))),
                    F.transform("m.uris", lambda u: F.struct(F.lit("uri").alias("kind"), u.alias("uri"))))
    size = F.size("m.ogc") + F.size("m.uris")
    return (parsed.select("collection_id", (size <= 2 * PAGE).alias("bounded"), F.explode(each).alias("e"))
            .groupBy("collection_id", "e.kind", "e.uri")
            .agg(F.count("*").cast("bigint").alias("n"), F.min("bounded").alias("bounded")))


# ------------------------------------------------------------------ A6
def _per_collection(spark, sf):
    """Items, conflicts and success of each collection of the batch."""
    batch, existing = _batch_and_existing(spark, sf)
    batch, existing = batch.select("collection_id", "item_id"), existing.select("collection_id", "item_id")
    remote = view(spark, sf, "v_collections").filter(F.col("side") == "remote").select("collection_id").distinct()
    new_colls_batch = batch.join(remote, "collection_id", "left_anti")
    _, conflicts = insert_items(existing, new_colls_batch, ["collection_id", "item_id"])
    per = (batch.groupBy("collection_id").agg(F.count("*").alias("n_items"))
           .join(conflicts.groupBy("collection_id").agg(F.count("*").alias("n_conflicts")), "collection_id", "left")
           .select("collection_id", "n_items", F.coalesce("n_conflicts", F.lit(0)).alias("n_conflicts"))
           .withColumn("ok", F.col("n_conflicts") == 0))
    return per


@query("ingest_summary", "A6 C4 Q8 Q10", views=["v_items", "v_collections"], oracle="""
, batch as (select collection_id, item_id from v_items where side in ('new', 'both')),
existing as (select collection_id, item_id from v_items where side in ('existing', 'both')),
remote as (select distinct collection_id from v_collections where side = 'remote'),
per as (select b.collection_id, count(*) as n_items,
               count(*) filter (where e.item_id is not null and r.collection_id is null) as n_conflicts
        from batch b left join existing e on b.collection_id = e.collection_id and b.item_id = e.item_id
        left join remote r on b.collection_id = r.collection_id group by 1)
select cast(count(*) filter (where n_conflicts = 0) as bigint) as collections_ingested,
       cast(count(*) filter (where n_conflicts > 0) as bigint) as collections_failed,
       cast(coalesce(sum(case when n_conflicts = 0 then n_items else 0 end), 0) as bigint) as items_ingested,
       cast(coalesce(sum(n_conflicts), 0) as bigint) as item_conflicts
from per
""")
def ingest_summary_q(spark, sf):
    """A6 over a run: collections already in the catalog upsert (Q8); new ones
    use plain insert, and a conflicting bulk insert fails that collection."""
    return ingest_summary(_per_collection(spark, sf))


@query("ingest_failures", "A6", views=["v_items", "v_collections"], oracle="""
, batch as (select collection_id, item_id from v_items where side in ('new', 'both')),
existing as (select collection_id, item_id from v_items where side in ('existing', 'both')),
remote as (select distinct collection_id from v_collections where side = 'remote'),
per as (select b.collection_id, count(*) as n_items,
               count(*) filter (where e.item_id is not null and r.collection_id is null) as n_conflicts
        from batch b left join existing e on b.collection_id = e.collection_id and b.item_id = e.item_id
        left join remote r on b.collection_id = r.collection_id group by 1)
select collection_id, cast(n_items as bigint) as n_items, cast(n_conflicts as bigint) as n_conflicts from per where n_conflicts > 0
""")
def ingest_failures(spark, sf):
    """The collections that a run did not take, a row each."""
    return failed_collections(_per_collection(spark, sf))


# ------------------------------------------------------------------ P5
_CAT = "s3://catalog/"
_DAY = "date_add(date '2020-01-01', cast(c_custkey % 700 as int))"


ITEM_PAGE = 1000


def _write_documents(docs, path, *keys):
    """One JSON document per file, written by the tasks, which share them out by ``keys``."""
    docs.repartition(*(keys or ["id"])).drop("page").write.option("maxRecordsPerFile", 1).json(path)


def _item_pages(items):
    """``(id, page, features)`` of ``(id, c_custkey, feature)``: pages of about
    ``ITEM_PAGE`` features, as many as the counted items of a collection need."""
    counts = items.groupBy("id").agg(F.count("*").alias("_n"))
    n_pages = F.ceil(F.col("_n") / F.lit(ITEM_PAGE)).cast("bigint")
    paged = items.join(counts, "id").withColumn("page", F.pmod(F.xxhash64("c_custkey"), n_pages))
    return paged.groupBy("id", "page").agg(F.collect_list("feature").alias("features"))


@query("catalog_ingest", "P5 S13 S14 C1 C2 C3 C4 C5 X4 X5 A1 A4 A5 A6", oracle=f"""
with it as (select 'col-' || n_name as collection_id, 'item-' || cast(c_custkey as string) as item_id, c_custkey as k,
                   n_nationkey as nk, cast(date '2020-01-01' + cast(c_custkey % 700 as integer) as timestamp) as ts
            from customer join nation on c_nationkey = n_nationkey),
remote_c as (select 'col-' || n_name as collection_id from nation where n_nationkey % 3 = 0),
remote_i as (select collection_id, item_id from it where k % 11 = 0 and nk % 2 = 0),
per as (select it.collection_id, count(*) as n_items, it.collection_id in (select collection_id from remote_c) as known,
               count(*) filter (where it.item_id in (select item_id from remote_i)) as hits from it group by 1),
ok as (select collection_id, n_items, known, case when known then 0 else hits end as n_conflicts from per),
ext as (select collection_id, min(ts) as lo, max(ts) as hi from it group by 1),
notice as (select collection_id, count(*) * 2 as n_ogc, count(*) as n_uri from it group by 1)
select o.collection_id, cast(o.n_items as bigint) as n_items, cast(n_conflicts as bigint) as n_conflicts,
       case when known and n_conflicts = 0 then 'update' when not known then 'create' else 'unchanged' end as action,
       'Items of ' || substr(o.collection_id, 5) as title,
       case when known then timestamp '2019-01-01' else lo end as extent_start, hi as extent_end,
       case when n_conflicts = 0 then cast(n_ogc as bigint) else 0 end as n_ogc,
       case when n_conflicts = 0 then cast(n_uri as bigint) else 0 end as n_uri,
       cast((select count(*) from ok where n_conflicts > 0) as bigint) as collections_failed,
       cast((select sum(n_items) from ok where n_conflicts = 0) as bigint) as items_ingested
from ok o join ext using (collection_id) join notice using (collection_id)
""")
def catalog_ingest_q(spark, sf):
    """Regions, nations and customers as catalog, collection and item-page
    documents in object files, read, walked and merged into a remote catalog:
    per collection what became of it, and the run's summary."""
    region, nation, customer = (table(spark, sf, t) for t in ("region", "nation", "customer"))
    base = scratch_dir(spark, f"catalog-{uuid.uuid4().hex}")

    def link(rel, href):
        return F.struct(F.lit(rel).alias("rel"), href.alias("href"))

    cid = F.concat(F.lit("col-"), "n_name")
    joined = nation.join(region, nation.n_regionkey == region.r_regionkey)
    catalogs = joined.groupBy("r_name").agg(F.collect_list(link("child", F.concat(F.lit("../collections/"), cid, F.lit(".json"))))
                                            .alias("children"))
    rid = F.concat(F.lit("cat-"), "r_name")
    _write_documents(catalogs.select(
        F.lit("Catalog").alias("type"), rid.alias("id"),
        F.concat(F.array(link("self", F.concat(F.lit(_CAT + "catalogs/"), rid, F.lit(".json")))), "children").alias("links")),
        f"{base}/catalogs")
    items = customer.join(nation, customer.c_nationkey == nation.n_nationkey).withColumn("day", F.expr(_DAY))
    first_last = items.groupBy("n_name").agg(F.min("day").alias("lo"), F.max("day").alias("hi"))
    stamp = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    _write_documents(first_last.select(
        F.lit("Collection").alias("type"), cid.alias("id"), F.concat(F.lit("Items of "), "n_name").alias("title"),
        F.array(link("self", F.concat(F.lit(_CAT + "collections/"), cid, F.lit(".json"))),
                link("items", F.lit("./items.json"))).alias("links"),
        F.struct(F.struct(F.array(F.array(stamp("lo"), stamp("lo")), F.array(stamp("hi"), stamp("hi"))).alias("interval"))
                 .alias("temporal")).alias("extent")), f"{base}/collections")
    key = F.col("c_custkey").cast("string")
    asset = lambda ext: F.struct(F.concat(F.lit("https://b.s3.amazonaws.com/"), key, F.lit(ext)).alias("href"))
    feature = F.struct(
        F.concat(F.lit("item-"), key).alias("id"), cid.alias("collection"),
        F.struct(stamp("day").alias("datetime")).alias("properties"),
        F.create_map(F.lit("asset"), asset(".tif"), F.lit("preview"), asset(".png")).alias("assets"))
    _write_documents(_item_pages(items.select(cid.alias("id"), "c_custkey", feature.alias("feature"))).select(
        F.lit("FeatureCollection").alias("type"), "id", "features", "page"), f"{base}/pages", "id", "page")

    documents = read_stac(spark, f"{base}/catalogs", "collection").unionByName(
        read_stac(spark, f"{base}/collections", "collection"))
    links, collections, assets = read_catalog(documents, read_stac(spark, f"{base}/pages", "item_page"))
    remote_collections = nation.where("n_nationkey % 3 = 0").select(
        cid.alias("collection_id"), F.lit("2019-01-01").cast("timestamp_ntz").alias("start_ts"),
        F.lit("2019-06-01").cast("timestamp_ntz").alias("end_ts"), F.concat(F.lit("Items of "), "n_name").alias("title"))
    remote_items = items.where("c_custkey % 11 = 0 and n_nationkey % 2 = 0").select(
        cid.alias("collection_id"), F.concat(F.lit("item-"), key).alias("item_id"))
    roots = region.select(rid.alias("root_id"))
    out = catalog_ingest(links, roots, collections, assets, remote_collections, remote_items, "CON_1", JOB_ID, HOST)
    notice = out["notice"].groupBy("collection_id").agg(
        F.count_if(F.col("kind") == "ogc").alias("n_ogc"), F.count_if(F.col("kind") == "uri").alias("n_uri"))
    merged = (out["per_collection"].join(out["collections"], "collection_id").join(notice, "collection_id", "left"))
    totals = out["summary"]
    return merged.select(
        "collection_id", F.col("n_items").cast("bigint").alias("n_items"), F.col("n_conflicts").cast("bigint").alias("n_conflicts"),
        "action", "title", "extent_start", "extent_end", F.coalesce("n_ogc", F.lit(0)).cast("bigint").alias("n_ogc"),
        F.coalesce("n_uri", F.lit(0)).cast("bigint").alias("n_uri"),
        totals.select("collections_failed").scalar().alias("collections_failed"),
        totals.select("items_ingested").scalar().alias("items_ingested"))
