"""Driver queries for URI functions, request checks and job records."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridcat.functions import jobs as J
from gridcat.functions import requests as R
from gridcat.functions import uris as U
from gridcat.plans.registry import query
from gridcat.plans.views import table, view



# ------------------------------------------------------------------ X1 X7
@query("parse_object_uri", "X1 X7", views=["v_uris"], oracle="""
, p as (select shape, k, uri, starts_with(uri, 's3://') as ok_scheme, substr(uri, 6) as rest from v_uris),
h as (select *, split_part(rest, '/', 1) as host,
             (starts_with(rest, 's3-') or starts_with(rest, 's3.'))
             and (contains(split_part(rest, '/', 1), 'amazonaws') or regexp_matches(split_part(rest, '/', 1), ':[0-9]+$'))
             as host_style, instr(rest, '/') > 0 as has_slash from p),
q as (select *, case when host_style then case when has_slash then substr(rest, instr(rest, '/') + 1) end
                     else rest end as path,
             case when not ok_scheme then 'invalid scheme' when host_style and not has_slash then 'missing bucket' end
             as error from h)
select shape, k, uri,
       case when error is null then split_part(path, '/', 1) end as bucket,
       case when error is null then case when instr(path, '/') > 0 then substr(path, instr(path, '/') + 1) else '' end
       end as key,
       error, starts_with(uri, 's3://') and length(uri) > 5 as valid
from q
""")
def parse_object_uri_q(spark, sf):
    u = view(spark, sf, "v_uris")
    p = U.parse_object_uri("uri")
    return u.select("shape", "k", "uri", p["bucket"].alias("bucket"), p["key"].alias("key"),
                    p["error"].alias("error"), U.is_valid_object_uri("uri").alias("valid"))


# ------------------------------------------------------------------ X2 X3
# by host name and the first slashes, with no pattern of the library's
_DUCK_HOST = "case when starts_with(href, 'https://') then split_part(substr(href, 9), '/', 1) end"


@query("http_to_object_uri", "X2 X3 Q1 Q2", views=["v_assets"], oracle=f"""
, h as (select *, {_DUCK_HOST} as host from v_assets),
p as (select *, substr(href, 10 + length(host)) as rest, split_part(host, '.s3.', 1) as sub from h),
u as (select *, case when host = 's3.amazonaws.com' or starts_with(host, 's3.') and ends_with(host, '.amazonaws.com')
                     then 's3://' || rest
                     when contains(host, '.s3.') and ends_with(host, '.amazonaws.com') then 's3://' || sub || '/' || rest end as uri,
             case when host = 's3.amazonaws.com' then 's3://' || rest
                  when host = sub || '.s3.amazonaws.com' then 's3://' || sub || '/' || rest end as narrow
      from p)
select item_id, asset_key, href, uri as object_uri, starts_with(href, 'https://') and contains(href, '.s3.') as needs_conversion,
       coalesce(uri, href) as rewritten,
       case when starts_with(href, 'https://') and contains(href, '.s3.') then narrow else href end as rewritten_strict
from u
""")
def http_to_object_uri_q(spark, sf):
    a = view(spark, sf, "v_assets")
    return a.select("item_id", "asset_key", "href", U.http_to_object_uri("href").alias("object_uri"),
                    U.needs_conversion("href").alias("needs_conversion"),
                    U.to_object_uri("href").alias("rewritten"),
                    U.to_object_uri("href", strict=True).alias("rewritten_strict"))


# ------------------------------------------------------------------ X8 X10 X19
@query("detect_input_type", "X8 X10 X19", views=["v_requests"], oracle="""
select request_id,
       case when granule_id is not null and length(granule_id) > 0 and granule_id <> 'none' then 'daac'
            when input_s3 is null then null
            when ends_with(input_s3, '.nc') or ends_with(input_s3, '.nc4') then 's3_netcdf'
            when ends_with(input_s3, '.zarr') or ends_with(input_s3, '.zarr/') then 's3_zarr'
            when ends_with(input_s3, '.gpkg') then 's3_gpkg'
            when ends_with(input_s3, '/') then 's3_folder' end as input_type,
       concat_ws(';',
         case when granule_id is not null and granule_id <> '' and (collection_id is null or collection_id = '')
              then 'collection id is required with a granule id' end,
         case when input_s3 is not null and not starts_with(input_s3, 's3://') then 'invalid object URL: ' || input_s3 end
       ) as violations,
       coalesce(nullif(concept_id, ''), collection_id) as concept
from v_requests
""")
def detect_input_type_q(spark, sf):
    r = view(spark, sf, "v_requests")
    return r.select("request_id", R.detect_input_type("granule_id", "input_s3").alias("input_type"),
                    F.array_join(R.request_violations("granule_id", "collection_id", "input_s3"), ";")
                    .alias("violations"),
                    R.concept_id_or_collection("concept_id", "collection_id").alias("concept"))


# ------------------------------------------------------------------ X9
_STEPS = "case request_id % 3 when 0 then 'all' when 1 then 'stage, netcdf2zarr' else 'zarr2cog,bogus , catalog' end"


@query("step_plan", "X9 Q20", views=["v_requests"], oracle=f"""
, r as (select request_id, {_STEPS} as steps,
          case when granule_id is not null and length(granule_id) > 0 and granule_id <> 'none' then 'daac'
               when ends_with(input_s3, '.nc') or ends_with(input_s3, '.nc4') then 's3_netcdf'
               when ends_with(input_s3, '.zarr') or ends_with(input_s3, '.zarr/') then 's3_zarr'
               when ends_with(input_s3, '.gpkg') then 's3_gpkg'
               when ends_with(input_s3, '/') then 's3_folder' end as input_type from v_requests),
p as (select request_id, input_type, steps,
        case when steps = 'all' then case input_type
               when 'daac' then ['stage', 'netcdf2zarr', 'zarr2cog', 'catalog']
               when 's3_netcdf' then ['netcdf2zarr', 'zarr2cog', 'catalog']
               when 's3_zarr' then ['zarr2cog', 'catalog'] when 's3_gpkg' then ['catalog'] end
             else list_transform(string_split(steps, ','), lambda x: trim(x)) end as plan from r)
select request_id, input_type, array_to_string(plan, ',') as plan,
       array_to_string(list_filter(plan, lambda x: not list_contains(['stage', 'netcdf2zarr', 'concat', 'zarr2cog',
         'catalog'], x)), ',') as invalid
from p
""")
def step_plan_q(spark, sf):
    r = view(spark, sf, "v_requests").select(
        "request_id", F.expr(_STEPS).alias("steps"),
        R.detect_input_type("granule_id", "input_s3").alias("input_type"))
    plan = R.step_plan("steps", "input_type")
    return r.select("request_id", "input_type", F.array_join(plan, ",").alias("plan"),
                    F.array_join(R.invalid_steps(plan), ",").alias("invalid"))


# ------------------------------------------------------------------ X11 X12 S16 S17 S22
@query("prefix_rewrite", "X11 X12 S16 S17 S22", views=["v_listing"], oracle="""
select bucket, key,
       case when starts_with(key, 'out/') then 'archive/' || substr(key, 5) else key end as dst_key,
       case when regexp_replace(regexp_replace(substr(key, length('out/' || split_part(key, '/', 2)) + 1), '^/+', ''),
                                '/+$', '') = '' then '.'
            else regexp_replace(regexp_replace(substr(key, length('out/' || split_part(key, '/', 2)) + 1), '^/+', ''),
                                '/+$', '') end as rel_key,
       concat_ws('/', 'staging', 'COL_' || substr(bucket, 7), nullif(regexp_extract(key, '([^/]*)$', 1), ''))
         as staged_key
from v_listing
""")
def prefix_rewrite_q(spark, sf):
    """The copy/download plan of a listing: target key after a prefix move
    (X11), path below the job folder (X12) and the staging key (S22)."""
    from gridcat.sources.listing import file_name, staged_key
    f = view(spark, sf, "v_listing")
    job_folder = F.concat(F.lit("out/"), F.split_part("key", F.lit("/"), F.lit(2)))
    return f.select("bucket", "key", U.prefix_rewrite("key", "out/", "archive/").alias("dst_key"),
                    U.relative_key("key", job_folder).alias("rel_key"),
                    staged_key(F.lit("/staging/"), F.concat(F.lit("COL_"), F.substring("bucket", 7, 10)),
                               file_name("key")).alias("staged_key"))


# ------------------------------------------------------------------ X15 X16 X28
_FNAME = """case p_partkey % 3
  when 0 then 'M2_' || cast(p_partkey as string) || '.flx.2025_' || p_type || '.nc4'
  when 1 then 'data_' || p_type || '_' || lower(replace(p_brand, '#', '')) || '.tif'
  else replace(p_name, ' ', '_') || '.tif' end"""


@query("product_names", "X15 X16 X28", oracle=f"""
with f as (select p_partkey, {_FNAME} as fname, lower(p_type) as variable,
                  'job-' || cast(p_partkey * 7919 as string) as job_id from part),
s as (select *, regexp_extract(fname, '^(.*?)([.][^.]*)?$', 1) as stem,
             regexp_extract(fname, '^(.*?)([.][^.]*)?$', 2) as ext from f)
select p_partkey, fname, stem, ext, stem || '.zarr' as zarr_name, stem || '_' || variable || '.tif' as tif_name,
       stem || '_preprocessed.nc' as pre_name, right(fname, 10) as short_name, right(job_id, 7) as short_job,
       coalesce(nullif(regexp_extract(stem, '_([A-Z][A-Z0-9]*)$', 1), ''),
                nullif(regexp_extract(stem, '_([A-Z]{{2,}})_', 1), ''),
                nullif(regexp_extract(stem, '_([^_]+)$', 1), ''), 'data') as raster_variable,
       'COL_' || cast(p_partkey % 5 as string) || '_' ||
       coalesce(nullif(regexp_extract(stem, '_([A-Z][A-Z0-9]*)$', 1), ''),
                nullif(regexp_extract(stem, '_([A-Z]{{2,}})_', 1), ''),
                nullif(regexp_extract(stem, '_([^_]+)$', 1), ''), 'data') as new_collection
from s
""")
def product_names_q(spark, sf):
    p = table(spark, sf, "part").select(
        "p_partkey", F.expr(_FNAME).alias("fname"), F.lower("p_type").alias("variable"),
        F.concat(F.lit("job-"), (F.col("p_partkey") * 7919).cast("string")).alias("job_id"))
    names = U.product_names("fname", "variable", F.lit(None))
    var = U.variable_from_filename("fname")
    return p.select("p_partkey", "fname", U.file_stem("fname").alias("stem"), U.file_ext("fname").alias("ext"),
                    names["zarr_name"].alias("zarr_name"), names["tif_name"].alias("tif_name"),
                    names["pre_name"].alias("pre_name"), U.short_id("fname", 10).alias("short_name"),
                    U.short_id("job_id", 7).alias("short_job"), var.alias("raster_variable"),
                    F.concat(F.lit("COL_"), (F.col("p_partkey") % 5).cast("string"), F.lit("_"), var)
                    .alias("new_collection"))


# ------------------------------------------------------------------ X13
_REQ_FIELDS = ["granule_id", "collection_id", "input_s3"]


@query("required_fields", "X13", oracle="""
with r as (select c_custkey,
                  case when c_custkey % 3 <> 0 then c_name end as granule_id,
                  case when c_custkey % 4 <> 1 then c_mktsegment end as collection_id,
                  case when c_custkey % 5 <> 2 then 's3://b/' || cast(c_custkey as string) || '.nc' end as input_s3
           from customer)
select c_custkey, concat_ws(',', case when granule_id is null then 'granule_id' end,
                                 case when collection_id is null then 'collection_id' end,
                                 case when input_s3 is null then 'input_s3' end) as missing
from r
""")
def required_fields_q(spark, sf):
    c = table(spark, sf, "customer").select(
        "c_custkey",
        F.when(F.col("c_custkey") % 3 != 0, F.col("c_name")).alias("granule_id"),
        F.when(F.col("c_custkey") % 4 != 1, F.col("c_mktsegment")).alias("collection_id"),
        F.when(F.col("c_custkey") % 5 != 2, F.concat(F.lit("s3://b/"), F.col("c_custkey").cast("string"),
                                                     F.lit(".nc"))).alias("input_s3"))
    return c.select("c_custkey", F.array_join(R.missing_fields(_REQ_FIELDS), ",").alias("missing"))


# ------------------------------------------------------------------ X14 O1
VARIABLES = "click, view"


@query("variable_select", "X14 O1 Q18", oracle="""
select event_id, event_type as variable, ts as time, value from events where event_type in ('click', 'view')
""")
def variable_select_q(spark, sf):
    """Cells of the selected variables; the predicate reaches the Parquet scan."""
    e = table(spark, sf, "events")
    return (e.filter(R.selects_variable(F.lit(VARIABLES), F.col("event_type")))
            .select("event_id", F.col("event_type").alias("variable"), F.col("ts").alias("time"), "value"))


# ------------------------------------------------------------------ X23 X24
@query("extent_and_grid_spec", "X23 X24 Q17 Q23", views=["v_extents"], oracle="""
, e as (select k, extent, resolution, case when resolution is null and k % 3 = 1 then 8 end as nx,
               case when resolution is null and k % 3 = 1 then 4 end as ny,
               string_split(regexp_replace(trim(extent), '[ ,]+', ' ', 'g'), ' ') as parts from v_extents),
n as (select *, try_cast(parts[1] as double) as x0, try_cast(parts[2] as double) as y0,
             try_cast(parts[3] as double) as x1, try_cast(parts[4] as double) as y1 from e),
v as (select *, case when len(parts) <> 4 then 'expected 4 fields, got ' || cast(len(parts) as string)
                     when x0 is null or y0 is null or x1 is null or y1 is null then 'non-number field'
                     when x0 < -180 or x0 > 180 or x1 < -180 or x1 > 180 then 'longitude outside [-180, 180]'
                     when y0 < -90 or y0 > 90 or y1 < -90 or y1 > 90 then 'latitude outside [-90, 90]'
                     when x0 >= x1 then 'min longitude >= max longitude'
                     when y0 >= y1 then 'min latitude >= max latitude' end as eerr from n),
g as (select *, case when eerr is not null then eerr
                     when resolution is not null and nx is not null then 'resolution and size are exclusive'
                     when resolution is not null and resolution <= 0 then 'resolution must be > 0'
                     when resolution is null and nx is null then 'resolution or size required' end as error from v)
select k, case when error is null then x0 end as min_lon, case when error is null then y0 end as min_lat,
       case when error is null then x1 end as max_lon, case when error is null then y1 end as max_lat,
       case when error is null then round(coalesce(resolution, (x1 - x0) / nx), 9) end as res_x,
       case when error is null then round(coalesce(resolution, (y1 - y0) / ny), 9) end as res_y,
       case when error is null then cast(case when resolution is not null then greatest(1, ceil((x1 - x0) / resolution - 1e-9)) else nx end as integer) end as nx,
       case when error is null then cast(case when resolution is not null then greatest(1, ceil((y1 - y0) / resolution - 1e-9)) else ny end as integer) end as ny,
       error
from g
""")
def extent_and_grid_spec_q(spark, sf):
    e = view(spark, sf, "v_extents").select(
        "k", "extent", "resolution",
        F.when(F.col("resolution").isNull() & (F.col("k") % 3 == 1), F.lit(8)).alias("nx"),
        F.when(F.col("resolution").isNull() & (F.col("k") % 3 == 1), F.lit(4)).alias("ny"))
    e = R.with_grid_spec(R.with_extent(e, "extent"), "extent_parsed", "resolution", "nx", "ny")
    g = F.col("grid")
    return e.select("k", g["min_lon"].alias("min_lon"), g["min_lat"].alias("min_lat"),
                    g["max_lon"].alias("max_lon"), g["max_lat"].alias("max_lat"),
                    F.round(g["res_x"], 9).alias("res_x"), F.round(g["res_y"], 9).alias("res_y"),
                    g["nx"].alias("nx"), g["ny"].alias("ny"), g["error"].alias("error"))


# ------------------------------------------------------------------ X20 X21
@query("error_message", "X20 X21", views=["v_job_records"], oracle="""
select k, coalesce(case when json_valid(error_details) then json_extract_string(error_details, '$.message') end,
                   error_details, nullif(response_code, ''), 'Unknown error') as message,
       coalesce(case when json_valid(record) then json_extract_string(record, '$.job_info.job_payload.payload_task_id')
                end, '') as task_id
from v_job_records
""")
def error_message_q(spark, sf):
    r = view(spark, sf, "v_job_records")
    return r.select("k", J.job_error_message("error_details", "response_code").alias("message"),
                    J.job_task_id("record").alias("task_id"))


# ------------------------------------------------------------------ X27
@query("nested_unwrap", "X27", views=["v_payloads"], oracle="""
, n as (select k, coalesce(nullif(json_extract_string(payload, '$.layers.layer[*].name'), []),
                           nullif(json_extract_string(payload, '$.layers[*].name'), []),
                           json_extract_string(payload, '$[*].name')) as names from v_payloads)
select k, unnest(names) as name from n
""")
def nested_unwrap_q(spark, sf):
    p = view(spark, sf, "v_payloads")
    return p.select("k", F.explode(J.unwrap_names("payload")).alias("n")).select("k", F.col("n.name").alias("name"))


# ------------------------------------------------------------------ X25 X26
STAC_HOST = "https://catalog.example"
MAP_HOST = "https://maps.example/gis"
WORKSPACE = "gridcat"


def duck_feature_url(layer: str) -> str:
    """DuckDB form of X26 over a layer expression."""
    return (f"'{MAP_HOST}/{WORKSPACE}{U.FEATURE_QUERY}{WORKSPACE}%3A' || "
            f"replace(url_encode({layer}), '%20', '+') || '{U.FEATURE_FORMAT}'")


@query("feature_urls", "X25 X26", oracle=f"""
select p_partkey, '{STAC_HOST}/stac/collections/' || p_brand || '/items/' || cast(p_partkey as string) as item_uri,
       {duck_feature_url("p_name || '_' || cast(p_partkey as string)")} as feature_url
from part
""")
def feature_urls_q(spark, sf):
    p = table(spark, sf, "part")
    layer = F.concat("p_name", F.lit("_"), F.col("p_partkey").cast("string"))
    return p.select("p_partkey", U.item_endpoint(F.lit(STAC_HOST), F.col("p_brand"),
                                                 F.col("p_partkey").cast("string")).alias("item_uri"),
                    U.feature_query_url(F.lit(MAP_HOST), F.lit(WORKSPACE), layer).alias("feature_url"))
