"""Driver queries for listings, discovery and granule/FTP selection."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from gridcat.functions import requests as R
from gridcat.plans.registry import query
from gridcat.plans.views import table, view
from gridcat.session import scratch_dir
from gridcat.sources import listing as L

# one job per supplier; every tenth has no object result
JOBS = """
select 'job-' || cast(s_suppkey as string) as job_id,
       case when s_suppkey % 10 = 9 then null
            else 's3://bucket' || cast(s_suppkey % 3 as string) || '/out/job' || cast(s_suppkey as string) end as result
from {supplier}"""

DUCK_JP = f"""
, jobs as ({JOBS.format(supplier='supplier')}),
jp as (select job_id, split_part(substr(result, 6), '/', 1) as bucket,
              substr(result, 6 + length(split_part(substr(result, 6), '/', 1)) + 1) || '/' as prefix
       from jobs where result is not null)"""


def _jobs(spark, sf):
    return spark.sql(JOBS.format(supplier=f"parquet.`{sf}/supplier.parquet`"))


@query("list_by_suffix", "S2 U1 O5", views=["v_listing"], oracle=DUCK_JP + """
select distinct 's3://' || f.bucket || '/' || f.key as uri
from v_listing f join jp on f.bucket = jp.bucket and starts_with(f.key, jp.prefix)
where ends_with(f.key, '.nc4')
""")
def list_by_suffix(spark, sf):
    """Distinct ``.nc4`` outputs over all jobs: the listing joins the jobs on
    (bucket, ancestor folder) - an equi join, no prefix theta join."""
    return L.outputs_by_suffix(view(spark, sf, "v_listing"), L.job_prefixes(_jobs(spark, sf)), ".nc4")


@query("list_store_roots", "S3 W3 Q13", views=["v_listing"], oracle=DUCK_JP + """
, roots as (select distinct jp.job_id, 's3://' || f.bucket || '/' || regexp_extract(f.key, '^(.*)/[^/]*$', 1) as uri
            from v_listing f join jp on f.bucket = jp.bucket and starts_with(f.key, jp.prefix)
            where ends_with(regexp_extract(f.key, '^(.*)/[^/]*$', 1), '.zarr'))
select job_id, min(uri) as first_uri, cast(count(*) as bigint) as n from roots group by job_id
""")
def list_store_roots(spark, sf):
    """Distinct ``.zarr`` store folders per job and the one a job hands on
    (smallest URI - deterministic, unlike the original's set order)."""
    roots = L.store_roots(view(spark, sf, "v_listing"), L.job_prefixes(_jobs(spark, sf)), ".zarr")
    return L.pick_one(roots, ["job_id"], "uri")


_RESULT = """case l_linenumber % 3
  when 0 then 's3://bucket' || cast(l_suppkey % 3 as string) || '/out/' || cast(l_orderkey as string) || '/' ||
              cast(l_linenumber as string)
  when 1 then 'https://results.example/' || cast(l_orderkey as string) || '/' || cast(l_linenumber as string)
  else 'file:///work/' || cast(l_orderkey as string) end"""


@query("first_result", "S4", oracle=f"""
with r as (select l_orderkey, list({_RESULT} order by l_linenumber, {_RESULT}) as results from lineitem group by 1)
select 'job-' || cast(l_orderkey as string) as job_id,
       list_filter(results, lambda x: starts_with(x, 's3'))[1] as first_s3
from r where len(list_filter(results, lambda x: starts_with(x, 's3'))) > 0
""")
def first_result(spark, sf):
    """A job's result list is its lines in line order; the first entry
    starting ``s3`` is its output, jobs without one are skipped.  Computed as
    a partial ``min`` over (position, value) of the matching entries rather
    than by materialising each list, so a job with a huge list stays cheap."""
    li = table(spark, sf, "lineitem").select("l_orderkey", F.col("l_linenumber").alias("pos"),
                                             F.expr(_RESULT).alias("r"))
    first = (li.filter(F.col("r").startswith("s3"))
             .groupBy("l_orderkey").agg(F.min(F.struct("pos", "r")).alias("_f")))
    return first.select(F.concat(F.lit("job-"), F.col("l_orderkey").cast("string")).alias("job_id"),
                        F.col("_f.r").alias("first_s3"))


@query("glob_scan", "S5 O2", views=["v_listing"], oracle="""
select bucket, key from v_listing where regexp_matches(regexp_extract(key, '([^/]*)$', 1), '^[^/]*[.]nc[^/]*$')
""")
def glob_scan(spark, sf):
    """Keys whose file name matches the default ``*.nc*`` pattern."""
    return L.glob_filter(view(spark, sf, "v_listing"), "*.nc*")


@query("granule_lookup", "S6 W2 L3", views=["v_granules"], oracle="""
, req as (select distinct concept_id, granule_name from v_granules
          union all select distinct concept_id, 'missing granule' from v_granules),
best as (select concept_id, granule_name, granule_ur, url, n from (
           select *, row_number() over (partition by concept_id, granule_name order by seq) as rn,
                  count(*) over (partition by concept_id, granule_name) as n from v_granules) t where rn = 1)
select r.concept_id, r.granule_name, b.granule_ur, b.url, b.n > 1 as ambiguous,
       cast(case when b.n is null then 0 else least(b.n, 2) end as bigint) as n_found
from req r left join best b on r.concept_id = b.concept_id and r.granule_name = b.granule_name
""")
def granule_lookup(spark, sf):
    g = view(spark, sf, "v_granules")
    req = (g.select("concept_id", "granule_name").distinct()
           .unionByName(g.select("concept_id", F.lit("missing granule").alias("granule_name")).distinct()))
    out = L.granule_lookup(req, g, ["concept_id", "granule_name"], "seq")
    return out.select("concept_id", "granule_name", "granule_ur", "url", "ambiguous",
                      F.coalesce("n_found", F.lit(0)).cast("bigint").alias("n_found"))


FTP_KEYWORDS = ["widget", "."]


@query("ftp_filter", "S7", views=["v_ftp_lines"], oracle=r"""
, n as (select k, regexp_extract(ltrim(line), '^(?:\S+\s+){8}(.*)$', 1) as name from v_ftp_lines)
select k, name from n where contains(name, 'widget') and contains(name, '.')
""")
def ftp_filter(spark, sf):
    return L.ftp_matches(view(spark, sf, "v_ftp_lines"), FTP_KEYWORDS).select("k", "name")


@query("existence_check", "X29", views=["v_listing"], oracle="""
, c as (select 'bucket' || cast((p_partkey % 100) % 3 as string) as bucket,
                  'out/job' || cast(p_partkey % 100 as string) || '/a' || cast(p_partkey as string) || '.nc4' as key
           from part)
select c.bucket, c.key, exists (select 1 from v_listing f where f.bucket = c.bucket and f.key = c.key) as exists
from c
""")
def existence_check(spark, sf):
    """Which candidate objects exist in the listing (left join + flag)."""
    cand = table(spark, sf, "part").select(
        F.concat(F.lit("bucket"), ((F.col("p_partkey") % 100) % 3).cast("string")).alias("bucket"),
        F.concat(F.lit("out/job"), (F.col("p_partkey") % 100).cast("string"), F.lit("/a"),
                 F.col("p_partkey").cast("string"), F.lit(".nc4")).alias("key"))
    return L.existence(cand, view(spark, sf, "v_listing"))


@query("bundle_check", "S20 X30", views=["v_bundle_files"], oracle="""
, b as (select stem, list(distinct lower(ext)) as exts,
               count(*) filter (where lower(stem || upper(ext)) like '%.shp') as n_shp from v_bundle_files group by stem)
select stem, array_to_string(list_sort(list_filter(['.shp', '.shx', '.dbf'], lambda x: not list_contains(exts, x))), ',')
         as missing,
       len(list_filter(['.shp', '.shx', '.dbf'], lambda x: not list_contains(exts, x))) = 0 as complete,
       cast(n_shp as bigint) as n_shp
from b
""")
def bundle_check(spark, sf):
    """Shapefile bundles: which of .shp/.shx/.dbf each stem lacks, and how
    many of its files the case-insensitive format test calls ``shp``."""
    files = view(spark, sf, "v_bundle_files")
    n_shp = F.count_if(L.file_format(F.concat("stem", F.upper("ext"))) == "shp").cast("bigint").alias("n_shp")
    chk = L.bundle_check(files, extra_aggs=[n_shp])
    return chk.select("stem", F.array_join("missing", ",").alias("missing"),
                      (F.size("missing") == 0).alias("complete"), "n_shp")


@query("object_listing", "S1 S5", oracle="""
select distinct 'nation=' || cast(c_nationkey as string) || '/segment=' || c_mktsegment as folder, cast(1 as bigint) as n
from customer
""")
def object_listing(spark, sf):
    """Customers written as objects, one per nation and segment, and listed
    level by level: the folders found and their number of objects."""
    root = scratch_dir(spark, f"objects-{uuid.uuid4().hex}")
    rows = table(spark, sf, "customer").select(
        "c_custkey", F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment"))
    rows.repartition("nation", "segment").write.partitionBy("nation", "segment").parquet(root)
    found = L.list_objects(spark, root, "*.parquet")
    folder = F.regexp_extract("key", "(nation=[^/]*/segment=[^/]*)/[^/]*$", 1)
    return found.groupBy(F.url_decode(folder).alias("folder")).agg(F.count("*").cast("bigint").alias("n"))


@query("manifest_roundtrip", "S12", oracle="""
select cast(s_suppkey as integer) as seq, 's3://bucket' || cast(s_suppkey % 3 as string) || '/store-' || cast(s_suppkey as string) || '.zarr'
         as store_uri from supplier
""")
def manifest_roundtrip(spark, sf):
    """Store URIs written as a manifest and read back."""
    stores = table(spark, sf, "supplier").select(F.col("s_suppkey").cast("int").alias("seq"), F.concat(
        F.lit("s3://bucket"), (F.col("s_suppkey") % 3).cast("string"), F.lit("/store-"), F.col("s_suppkey").cast("string"),
        F.lit(".zarr")).alias("uri"))
    path = scratch_dir(spark, f"manifest-{uuid.uuid4().hex}")
    L.write_manifest(stores, path)
    return L.read_manifest(spark, path)


@query("folder_requests", "X8 X9 S1 S5", views=["v_listing"], oracle=DUCK_JP + """
select jp.job_id, 's3://' || f.bucket || '/' || f.key as input_s3, 's3_netcdf' as input_type,
       'netcdf2zarr,zarr2cog,catalog' as plan
from v_listing f join jp on f.bucket = jp.bucket and starts_with(f.key, jp.prefix)
where regexp_matches(regexp_extract(f.key, '([^/]*)$', 1), '^[^/]*[.]nc[^/]*$')
""")
def folder_requests(spark, sf):
    """Folder requests turned into one request per file, typed and planned."""
    folders = _jobs(spark, sf).where("result is not null").select(
        "job_id", F.concat("result", F.lit("/")).alias("input_s3"))
    each = L.expand_folders(folders, view(spark, sf, "v_listing"))
    typed = each.withColumn("input_type", R.detect_input_type(F.lit(None).cast("string"), "input_s3"))
    return typed.select("job_id", "input_s3", "input_type",
                        F.array_join(R.step_plan(F.lit("all"), "input_type"), ",").alias("plan"))
