"""Driver queries for layer reconciliation, GeoPackage inventory and job status."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridcat.functions.uris import feature_query_url
from gridcat.operators import jobs as JO
from gridcat.operators import layers as LY
from gridcat.plans.pipelines import publish_layers
from gridcat.plans.q_requests import MAP_HOST, WORKSPACE, duck_feature_url
from gridcat.plans.registry import query
from gridcat.plans.views import table, view

@query("layer_reconcile", "U2 C7 X26", views=["v_layers_after", "v_expected_layers"], oracle=f"""
, nl as (select distinct layer from v_layers_after where not in_before),
ex as (select distinct expected from v_expected_layers),
m as (select e.expected, n.layer,
             case when n.layer = e.expected then 0
                  when regexp_matches(substr(n.layer, length(e.expected) + 1), '^[0-9]+$') then 1 else 2 end as r
      from ex e join nl n on starts_with(n.layer, e.expected)),
p as (select expected, layer, n from (select *, row_number() over (partition by expected order by r, length(layer), layer)
        as rn, count(*) over (partition by expected) as n from m) t where rn = 1),
pre as (select distinct layer from v_layers_after)
select ex.expected,
       case when p.layer is not null then 'published' when pre.layer is not null then 'pre-existing'
            else 'missing' end as outcome,
       p.layer, cast(coalesce(p.n, 0) as bigint) as n_matches, coalesce(p.n > 1, false) as ambiguous,
       case when p.layer is not null then {duck_feature_url('p.layer')} end as feature_url
from ex left join p on ex.expected = p.expected left join pre on pre.layer = ex.expected
union all
select null, 'published', layer, 1, false, {duck_feature_url('layer')} from nl where not exists (select 1 from p)
""")
def layer_reconcile(spark, sf):
    """Expected table names vs. layers found after publishing: which layer
    each name became, which were already there, which are missing, and the
    feature-query URL of every published layer."""
    after = view(spark, sf, "v_layers_after")
    before = after.filter("in_before")
    out = LY.reconcile(view(spark, sf, "v_expected_layers"), after, before)
    return out.withColumn("feature_url", F.when(F.col("outcome") == "published", feature_query_url(
        F.lit(MAP_HOST), F.lit(WORKSPACE), F.col("layer"))))


@query("latest_job_status", "W4 X22 C11", views=["v_job_status"], oracle="""
, l as (select job_id, status from (select *, row_number() over (partition by job_id order by ts desc, status desc)
          as rn from v_job_status) t where rn = 1),
c as (select job_id, status, case when lower(trim(status)) in ('failed', 'deleted', 'revoked') then 'failed'
                                  when lower(trim(status)) in ('accepted', 'running', 'queued') then 'pending'
                                  when lower(trim(status)) = 'succeeded' then 'succeeded' else 'unknown' end as cls
      from l)
select o_orderkey as product_id, o_custkey % 150 as job_id, c.status,
       case c.cls when 'succeeded' then 'catalog' when 'pending' then 'wait' when 'failed' then 'drop' else 'hold' end
         as action
from orders left join c on o_custkey % 150 = c.job_id
""")
def latest_job_status(spark, sf):
    """Each order is a product of job ``custkey % 150``; its fate follows the
    latest status of that job."""
    latest = JO.latest_status(view(spark, sf, "v_job_status"))
    products = table(spark, sf, "orders").select(F.col("o_orderkey").alias("product_id"),
                                                 (F.col("o_custkey") % 150).alias("job_id"))
    return JO.gate_products(products, latest).select("product_id", "job_id", "status", "action")


@query("layer_exists", "C6", views=["v_layers_after", "v_expected_layers"], oracle="""
, e as (select distinct expected from v_expected_layers union select distinct layer from v_layers_after where in_before)
select expected, exists (select 1 from v_layers_after l where l.layer = e.expected) as exists from e
""")
def layer_exists(spark, sf):
    """Which expected names and earlier layers exist by that very name."""
    after = view(spark, sf, "v_layers_after")
    names = view(spark, sf, "v_expected_layers").select("expected").unionByName(
        after.where("in_before").select(F.col("layer").alias("expected")))
    return LY.existing_names(names, after)


@query("layer_fallback", "U3", views=["v_layers_after"], oracle="""
select cast(null as string) as expected, 'published' as outcome, layer, cast(1 as bigint) as n_matches, false as ambiguous
from (select distinct layer from v_layers_after where not in_before) t
union all
select distinct 'no such ' || layer, 'missing', null, 0, false from v_layers_after
""")
def layer_fallback(spark, sf):
    """No expected name matches: every new layer counts as published."""
    after = view(spark, sf, "v_layers_after")
    expected = after.select(F.concat(F.lit("no such "), "layer").alias("expected"))
    return LY.reconcile(expected, after, after.where("in_before"))


@query("publish_layers", "P6 U2 U3 C6 C7 X26", views=["v_layers_after"], oracle=f"""
, t as (select distinct 'upload' || cast(p_size % 5 as string) || '.gpkg' as file, split_part(p_name, ' ', 1) as tab from part
        union all select 'upload9.gpkg', 'absent'),
nl as (select distinct layer from v_layers_after where not in_before),
m as (select e.tab, n.layer, case when n.layer = e.tab then 0
             when regexp_matches(substr(n.layer, length(e.tab) + 1), '^[0-9]+$') then 1 else 2 end as r
      from (select distinct tab from t) e join nl n on starts_with(n.layer, e.tab)),
p as (select tab, layer, n from (select *, row_number() over (partition by tab order by r, length(layer), layer) as rn,
        count(*) over (partition by tab) as n from m) x where rn = 1),
pre as (select distinct layer from v_layers_after)
select t.file, t.tab as "table",
       case when p.layer is not null then 'published' when pre.layer is not null then 'pre-existing' else 'missing' end as outcome,
       p.layer, coalesce(p.n > 1, false) as ambiguous,
       case when p.layer is not null then {duck_feature_url('p.layer')} end as feature_url
from t left join p on t.tab = p.tab left join pre on pre.layer = t.tab
union all
select null, null, 'published', layer, false, {duck_feature_url('layer')} from nl where not exists (select 1 from p)
""")
def publish_layers_q(spark, sf):
    """Uploaded files and their tables against the layers found afterwards."""
    part = table(spark, sf, "part")
    tables = part.select(F.concat(F.lit("upload"), (F.col("p_size") % 5).cast("string"), F.lit(".gpkg")).alias("file"),
                         F.split_part("p_name", F.lit(" "), F.lit(1)).alias("table")).distinct()
    tables = tables.unionByName(spark.range(1).select(F.lit("upload9.gpkg").alias("file"), F.lit("absent").alias("table")))
    after = view(spark, sf, "v_layers_after")
    return publish_layers(tables, after, after.where("in_before"), MAP_HOST, WORKSPACE)
