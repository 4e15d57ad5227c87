"""Driver queries for catalog scans, walks and href normalisation."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridcat.functions.uris import normalize_assets, normalize_href, normalize_links, to_object_uri
from gridcat.plans.registry import query
from gridcat.plans.views import table
from gridcat.sources.catalog import catalog_counts, item_features, link_by_rel, walk_catalog

HREF_RE = 'href="([^"]*)"'
MAX_ITEMS = 5


# ------------------------------------------------------------------ C1 A2
DEPTH = 24  # sub-collections below each nation, one inside the other


@query("catalog_walk", "C1 A2", oracle=f"""
with recursive links as (
  select 'cat-' || r_name as parent_id, 'col-' || n_name || '-0' as child_id, 'child' as rel
  from nation join region on n_regionkey = r_regionkey
  union all
  select distinct 'col-' || n_name || '-' || cast(d as string), 'col-' || n_name || '-' || cast(d + 1 as string), 'child'
  from nation, range(0, {DEPTH}) t(d)
  union all
  select 'col-' || n_name || '-' || cast(c_custkey % {DEPTH + 1} as string), 'item-' || cast(c_custkey as string), 'item'
  from customer join nation on c_nationkey = n_nationkey),
walk(root_id, node_id) as (
  select 'cat-' || r_name, 'cat-' || r_name from region
  union all
  select w.root_id, l.child_id from walk w join links l on l.parent_id = w.node_id and l.rel = 'child'),
items as (
  select w.root_id, w.node_id as collection_id, l.child_id as item_id,
         case when cast(substr(l.child_id, 6) as bigint) % 3 = 2 then 0
              when cast(substr(l.child_id, 6) as bigint) % 2 = 0 then 2 else 1 end as assets
  from walk w left join links l on l.parent_id = w.node_id and l.rel = 'item' where w.node_id <> w.root_id)
select root_id, collection_id, cast(count(distinct collection_id) as bigint) as n_collections,
       cast(count(item_id) as bigint) as n_items,
       cast(coalesce(sum(case when item_id is not null then assets end), 0) as bigint) as assets_converted
from items group by rollup (root_id, collection_id)
""")
def catalog_walk(spark, sf):
    """region -> nation -> 24 nested sub-collections, customers as items
    on every level; items carry one or two assets whose href may be an
    object-store URL, and collections may be empty."""
    region, nation, customer = (table(spark, sf, t) for t in ("region", "nation", "customer"))

    def col_id(depth):
        return F.concat(F.lit("col-"), F.col("n_name"), F.lit("-"), depth.cast("string"))

    top = (nation.join(region, nation.n_regionkey == region.r_regionkey)
           .select(F.concat(F.lit("cat-"), "r_name").alias("parent_id"), col_id(F.lit(0)).alias("child_id")))
    nested = nation.select("n_name", F.explode(F.sequence(F.lit(0), F.lit(DEPTH - 1))).alias("d")).select(
        col_id(F.col("d")).alias("parent_id"), col_id(F.col("d") + 1).alias("child_id"))
    key = F.col("c_custkey")
    items = customer.join(nation, customer.c_nationkey == nation.n_nationkey)
    item_id = F.concat(F.lit("item-"), key.cast("string"))
    item_links = items.select(col_id(key % (DEPTH + 1)).alias("parent_id"), item_id.alias("child_id"))
    links = (top.unionByName(nested).withColumn("rel", F.lit("child"))
             .unionByName(item_links.withColumn("rel", F.lit("item"))))
    name = F.concat(key.cast("string"), F.lit("-"), F.col("n").cast("string"), F.lit(".tif"))
    bucket = F.concat(F.lit("b"), F.col("c_nationkey").cast("string"))
    href = (F.when(key % 3 == 0, F.concat(F.lit("https://"), bucket, F.lit(".s3.amazonaws.com/c/"), name))
            .when(key % 3 == 1, F.concat(F.lit("https://s3.amazonaws.com/"), bucket, F.lit("/c/"), name))
            .otherwise(F.concat(F.lit("s3://"), bucket, F.lit("/c/"), name)))
    assets = items.select("*", F.explode(F.sequence(F.lit(1), F.when(key % 2 == 0, 2).otherwise(1))).alias("n")).select(
        item_id.alias("item_id"), (to_object_uri(href) != href).alias("converted"))
    roots = region.select(F.concat(F.lit("cat-"), "r_name").alias("root_id"))
    walked = walk_catalog(links, roots).where("collection_id <> root_id")
    return catalog_counts(walked, assets)


# ------------------------------------------------------------------ S14 C2 L2
@query("link_by_rel", "S14 C2 L2", oracle=f"""
with p as (select page_id, url, regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) as origin,
                  regexp_extract_all(html, '{HREF_RE}', 1) as hrefs from pages),
c as (select page_id, origin || hrefs[3] as items_href from p where len(hrefs) >= 3),
f as (select origin || hrefs[2 + 1] as page_href, i as pos, origin || hrefs[i + 1] as feature_href
      from p, range(0, least(len(hrefs), {MAX_ITEMS})) t(i) where len(hrefs) >= 3)
select c.page_id, c.items_href, cast(f.pos as bigint) as pos, f.feature_href
from c join f on c.items_href = f.page_href
""")
def link_by_rel_q(spark, sf):
    """Each page is a collection whose links are its hrefs (first ``self``,
    every 4th from the third ``items``, the rest ``child``).  C2 picks the
    first ``items`` link, resolves it against the page URL, and joins the item
    page published at that href; S14/L2 read its first ``MAX_ITEMS`` features."""
    pages = table(spark, sf, "pages").select(
        "page_id", "url", F.regexp_extract_all("html", F.lit(HREF_RE), F.lit(1)).alias("hrefs"))
    links = F.transform("hrefs", lambda h, i: F.struct(
        F.when(i == 0, F.lit("self")).when(i % 4 == 2, F.lit("items")).otherwise(F.lit("child")).alias("rel"),
        h.alias("href")))
    colls = (pages.select("page_id", normalize_links(links, F.col("url")).alias("links"))
             .select("page_id", link_by_rel("links", "items").alias("items_href"))
             .filter(F.col("items_href").isNotNull()))
    # the item page each collection links to, with its features in file order
    item_pages = pages.select(
        normalize_href(F.try_element_at("hrefs", F.lit(3)), F.col("url")).alias("page_href"),
        F.transform("hrefs", lambda h: F.struct(normalize_href(h, F.col("url")).alias("href"))).alias("features"))
    feats = item_features(item_pages.filter(F.col("page_href").isNotNull()), MAX_ITEMS)
    return (colls.join(feats, colls.items_href == feats.page_href)
            .select("page_id", "items_href", F.col("pos").cast("bigint").alias("pos"),
                    F.col("feature.href").alias("feature_href")))


# ------------------------------------------------------------------ X4 X5 X6
_DUCK_NORM = f"""
with p as (select page_id, url, regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) as origin,
                  regexp_replace(case when regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) = '' then '/'
                                      else regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) end, '[^/]*$', '') as dir,
                  regexp_extract_all(html, '{HREF_RE}', 1) as hrefs from pages),
h as (select page_id, origin, dir, regexp_replace(dir, '[^/]+/$', '') as parent, i as pos, hrefs[i + 1] as h
      from p, range(0, len(hrefs)) t(i))
select page_id, 'root' as form, cast(pos as bigint) as pos, h as href_in, origin || h as abs_href from h
union all select page_id, 'dot', pos, '.' || h, origin || dir || substr(h, 2) from h
union all select page_id, 'dotdot', pos, '..' || h, origin || parent || substr(h, 2) from h
union all select page_id, 'abs', pos, 's3://b' || h, 's3://b' || h from h
union all select page_id, 's3rel', pos, substr(h, 2), 's3://b/cat/' || cast(page_id as string) || '/' || substr(h, 2) from h
union all select page_id, 's3bucket', pos, 'b' || h, 's3://b' || h from h
"""


LINK_FORMS = {"root": lambda h: h, "dot": lambda h: F.concat(F.lit("."), h),
              "dotdot": lambda h: F.concat(F.lit(".."), h), "abs": lambda h: F.concat(F.lit("s3://b"), h)}
ASSET_FORMS = {"s3rel": lambda h: F.substring(h, 2, 1 << 30), "s3bucket": lambda h: F.concat(F.lit("b"), h)}


@query("normalize_href", "X4 X5 X6", oracle=_DUCK_NORM)
def normalize_href_q(spark, sf):
    """Every href of every page in six forms, made absolute: links
    against the page URL, assets (X6) against an s3 collection document."""
    pages = table(spark, sf, "pages").select(
        "page_id", "url", F.regexp_extract_all("html", F.lit(HREF_RE), F.lit(1)).alias("hrefs"))
    s3_base = F.concat(F.lit("s3://b/cat/"), F.col("page_id").cast("string"), F.lit("/collection.json"))
    # one scan: each href becomes its six forms, then links and assets are normalised
    links = F.flatten(F.transform("hrefs", lambda h, i: F.transform(
        F.array(*(F.struct(F.lit(form).alias("form"), fn(h).alias("href")) for form, fn in LINK_FORMS.items())),
        lambda x: F.struct(i.alias("pos"), x["form"].alias("form"), F.lit("child").alias("rel"),
                           x["href"].alias("href_in"), x["href"].alias("href")))))
    assets = F.map_from_entries(F.flatten(F.transform("hrefs", lambda h, i: F.transform(
        F.array(*(F.struct(F.lit(form).alias("form"), fn(h).alias("href")) for form, fn in ASSET_FORMS.items())),
        lambda x: F.struct(F.struct(i.alias("pos"), x["form"].alias("form")).alias("k"),
                           F.struct(x["href"].alias("href_in"), x["href"].alias("href")).alias("v"))))))
    done = pages.select("page_id", normalize_links(links, F.col("url")).alias("links"),
                        normalize_assets(assets, s3_base).alias("assets"))
    rows = F.concat(
        F.transform("links", lambda l: F.struct(l["form"].alias("form"), l["pos"].alias("pos"),
                                                l["href_in"].alias("href_in"), l["href"].alias("abs_href"))),
        F.transform(F.map_entries("assets"), lambda e: F.struct(
            e["key"]["form"].alias("form"), e["key"]["pos"].alias("pos"), e["value"]["href_in"].alias("href_in"),
            e["value"]["href"].alias("abs_href"))))
    return done.select("page_id", F.explode(rows).alias("r")).select(
        "page_id", "r.form", F.col("r.pos").cast("bigint").alias("pos"), "r.href_in", "r.abs_href")
