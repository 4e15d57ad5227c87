"""Input views over the driver tables (FIXTURES.md part B).

Each view body is plain SQL that runs unchanged in Spark SQL and DuckDB.
Table names are written as ``{name}`` placeholders: Spark reads the Parquet
file directly (``parquet.`path` ``) so column pruning and filter push-down
reach the scan; the DuckDB oracle binds them to its pre-registered views.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ("region nation customer supplier part orders lineitem events documents "
               "embeddings pages benchmark labels conversations").split()

VIEWS: dict[str, str] = {
    "v_items": """
select 'COL_' || substr(o_orderpriority, 1, 1) as collection_id,
       'item-' || cast(o_orderkey as string) as item_id,
       o_orderdate as item_ts,
       case when o_orderkey % 3 = 0 then 'existing' when o_orderkey % 3 = 1 then 'new' else 'both' end as side
from {orders}""",
    "v_assets": """
select 'item-' || cast(l_orderkey as string) as item_id,
       case when l_linenumber = 1 then 'asset' else 'aux' || cast(l_linenumber as string) end as asset_key,
       case l_suppkey % 4
         when 0 then 'https://b' || cast(l_suppkey as string) || '.s3.amazonaws.com/p/' || cast(l_partkey as string) || '.tif'
         when 1 then 'https://b' || cast(l_suppkey as string) || '.s3.us-west-2.amazonaws.com/p/' || cast(l_partkey as string) || '.tif'
         when 2 then 'https://s3.amazonaws.com/b' || cast(l_suppkey as string) || '/p/' || cast(l_partkey as string) || '.tif'
         else 's3://b' || cast(l_suppkey as string) || '/p/' || cast(l_partkey as string) || '.tif' end as href,
       l_shipdate as seq_ts, l_partkey as part, l_suppkey as supp, l_extendedprice as price
from {lineitem}""",
    "v_collections": """
select side, collection_id, min(o_orderdate) as start_ts,
       case when collection_id = 'COL_3' then null else max(o_orderdate) end as end_ts
from (select case when o_orderkey % 2 = 0 then 'new' else 'remote' end as side,
             'COL_' || substr(o_orderpriority, 1, 1) as collection_id, o_orderdate from {orders}) t
where not (side = 'remote' and collection_id = 'COL_5')
group by side, collection_id""",
    "v_listing": """
select distinct 'bucket' || cast(l_suppkey % 3 as string) as bucket,
       'out/job' || cast(l_suppkey as string) || '/' ||
       case l_linenumber % 5
         when 0 then 'a' || cast(l_orderkey as string) || '.zarr/.zmetadata'
         when 1 then 'a' || cast(l_orderkey as string) || '.zarr/PRECTOT/0.0'
         when 2 then 'a' || cast(l_orderkey as string) || '.nc4'
         when 3 then 'sub/'
         else 'catalog.json' end as key
from {lineitem}""",
    "v_uris": """
select l_linenumber as shape, l_orderkey as k,
       case l_linenumber % 4
         when 0 then 's3://bkt' || cast(l_suppkey as string) || '/p/' || cast(l_orderkey as string) || '.nc'
         when 1 then 's3://s3-us-west-2.amazonaws.com:80/bkt' || cast(l_suppkey as string) || '/p/' || cast(l_orderkey as string)
         when 2 then 's3://bkt' || cast(l_suppkey as string)
         else 'http://bkt/' || cast(l_orderkey as string) end as uri
from {lineitem}""",
    "v_requests": """
select o_orderkey as request_id,
       case when o_orderkey % 7 = 0 then 'G-' || cast(o_orderkey as string) when o_orderkey % 7 = 1 then 'none' end as granule_id,
       case o_orderkey % 7
         when 1 then 's3://b/f.nc' when 2 then 's3://b/f.nc4' when 3 then 's3://b/f.zarr/' when 4 then 's3://b/f.gpkg'
         when 5 then 's3://b/folder/' when 6 then 'https://b/f.txt' end as input_s3,
       case when o_orderkey % 5 <> 0 then 'COL_' || cast(o_orderkey % 5 as string) end as collection_id,
       case when o_orderkey % 4 = 0 then '' when o_orderkey % 4 = 1 then 'CON_' || cast(o_orderkey % 3 as string) end as concept_id
from {orders}""",
    "v_granules": """
select p_brand as concept_id, p_name as granule_name, 'UR-' || cast(p_partkey as string) as granule_ur,
       'https://archive.example/' || cast(p_partkey as string) || '.nc4' as url, p_partkey as seq
from {part}""",
    "v_ftp_lines": """
select p_partkey as k, '-rw-r--r--   1 ftp  ftp  ' || cast(p_size as string) || ' Jan  1  2025 ' || p_name ||
       case when p_size = 11 then '' else '.' || p_type end as line
from {part}""",
    "v_bundle_files": """
select distinct 'shape' || cast(l_orderkey as string) as stem,
       case l_linenumber when 1 then '.shp' when 2 then '.shx' when 3 then '.dbf' when 4 then '.prj' else '.cpg' end as ext
from {lineitem}""",
    "v_layers_after": """
select p_name || '_' || cast(p_partkey as string) as layer, p_partkey % 2 = 0 as in_before from {part}""",
    "v_expected_layers": """
select distinct split_part(p_name, ' ', 1) as expected from {part} union all select 'absent' as expected""",
    "v_payloads": """
select n_nationkey as k,
       case n_nationkey % 3
         when 0 then '{{"layers":{{"layer":[{{"name":"' || n_name || '"}}]}}}}'
         when 1 then '{{"layers":[{{"name":"' || n_name || '"}}]}}'
         else '[{{"name":"' || n_name || '"}}]' end as payload
from {nation}""",
    "v_job_records": """
select event_id as k,
       case event_id % 4 when 0 then '{{"message": "m' || cast(event_id as string) || '"}}' when 1 then 'plain text'
                         when 2 then '{{"other": 1}}' end as error_details,
       case when event_id % 8 = 3 then '500' end as response_code,
       case when event_id % 2 = 0 then '{{"job_info":{{"job_payload":{{"payload_task_id":"t' || cast(event_id as string) || '"}}}}}}'
            else '{{"job_info":{{}}}}' end as record
from {events}""",
    "v_job_status": """
select user_id as job_id,
       case event_type when 'click' then 'accepted' when 'signup' then 'queued' when 'view' then 'running'
                       when 'error' then 'Failed' else 'Succeeded' end as status,
       ts
from {events}""",
    "v_extents": """
select c_custkey as k,
       case c_custkey % 5 when 0 then '-180 -90 180 90' when 1 then '-200 -10 10 10' when 2 then '10 0 -10 5'
                          when 3 then '1 2 3' else 'a b c d' end as extent,
       case when c_custkey % 2 = 0 then cast(1 + c_custkey % 4 as double) / cast(4 as double) end as resolution
from {customer}""",
    "v_cells": """
select event_type as variable, ts as time,
       cast((event_id * 17) % 18000 as double) / cast(100 as double) - cast(90 as double) as lat,
       cast((event_id * 37 + user_id) % 36000 as double) / cast(100 as double) - cast(180 as double) as lon,
       value
from {events}""",
    "v_arrays": """
select vec_id as dataset_id, label as variable_id, embedding as values_f, vec_id % 20 as level, vec_id % 2 as part_no
from {embeddings}""",
}

# v_hrefs differs between dialects only in the exploding function.
_HREFS = """
select page_id, url, {explode}(regexp_extract_all(html, 'href="([^"]*)"', 1)) as href from {{pages}}"""
VIEWS_SPARK = dict(VIEWS, v_hrefs=_HREFS.format(explode="explode"))
VIEWS_DUCK = dict(VIEWS, v_hrefs=_HREFS.format(explode="unnest"))

_PLACEHOLDER = re.compile(r"(?<!\{)\{([a-z_]+)\}(?!\})")


def _tables_in(body: str) -> set[str]:
    return {m for m in _PLACEHOLDER.findall(body) if m in BASE_TABLES}


def spark_sql_text(name: str, sf_dir: str) -> str:
    body = VIEWS_SPARK[name]
    return body.format(**{t: f"parquet.`{sf_dir}/{t}.parquet`" for t in BASE_TABLES})


def duck_sql_text(name: str) -> str:
    return VIEWS_DUCK[name].format(**{t: t for t in BASE_TABLES})


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The named view as a DataFrame over the Parquet files in ``sf_dir``."""
    return spark.sql(spark_sql_text(name, sf_dir))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_views(sql: str, names: list[str]) -> str:
    """Prefix a DuckDB query with the view bodies it uses, as CTEs."""
    ctes = ",\n".join(f"{n} as ({duck_sql_text(n)}\n)" for n in names)
    return f"with {ctes}\n{sql}" if names else sql
