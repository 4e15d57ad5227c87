"""Driver queries for the end-to-end pipelines P1-P4 (P5 is ``catalog_ingest``,
P6 is ``publish_layers``)."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridcat.operators import cells as CE
from gridcat.operators import grid as G
from gridcat.operators import tiles as TI
from gridcat.plans import pipelines as P
from gridcat.plans.q_grid import DUCK_CELLS, NX, _duck_exact
from gridcat.plans.registry import query
from gridcat.plans.views import view


@query("land_surface_preprocess", "P1 X17 X14 S9", views=["v_arrays"], oracle=DUCK_CELLS + """
, sel as (select dataset_id, variable, y, x, value * cast(1000 as double) + 273.15 as value from cells
          where variable in ('var0', 'var3', 'var7') and value is not null)
select dataset_id, variable, y, x, round(value, 6) as value from sel
""")
def land_surface_preprocess(spark, sf):
    a = (view(spark, sf, "v_arrays").withColumn("variable", F.concat(F.lit("var"), F.col("variable_id").cast("string")))
         .withColumnRenamed("values_f", "values"))
    cells = CE.array_to_cells(a, "values", NX, keep=["dataset_id", "variable", "level"]).withColumnRenamed("level", "Time")
    chunks = P.land_surface_preprocess(cells, {"time": "Time"}, "var0, var3 var7", 1000.0, 273.15, cy=4, cx=4)
    back = CE.chunks_to_cells(chunks, ["dataset_id", "variable"])
    return back.select("dataset_id", "variable", "y", "x", F.round("value", 6).alias("value"))


_LEVEL = "case variable when 'click' then 0 when 'view' then 19 else 7 end"


@query("estuary_preprocess", "P2 A9 W5 W6 C10", views=["v_cells"], oracle=f"""
, pts as (select variable, {_LEVEL} as level, day(cast(time as date)) % 2 + 1 as part, cast(time as date) as day,
                 lat + lon / cast(180 as double) as lat2, lon + lat / cast(90 as double) as lon2, cast(round(value * 100) as bigint) as cents from v_cells),
b as (select variable, level, part, day, floor((lat2 + 90) / 10) as iy, floor((lon2 + 180) / 10) as ix, count(cents) as n,
             sum(cents) as cents
      from pts where lon2 >= -180 and lon2 <= 180 and lat2 >= -90 and lat2 <= 90 group by all),
s as (select b.*, dense_rank() over (partition by variable order by day) as slice from b),
f as (select variable || '_d' || cast(slice as string) || '_s' || cast(level as string) || '_' || cast(part as string)
             || '.nc' as name, 's' || cast(level as string) || '_' || cast(part as string) as suffix, n, cents, level from s),
lv as (select min(level) as lo, max(level) as hi from f),
routes as (select * from (values ('s0_1', 'surface_nowcast'), ('s0_2', 'surface_forecast'),
                                 ('s19_1', 'bottom_nowcast'), ('s19_2', 'bottom_forecast')) r(suffix, collection_suffix))
select r.suffix, r.collection_suffix, cast(count(distinct f.name) as bigint) as n_files,
       cast(count(*) as bigint) as n_cells, cast(sum(f.n) as bigint) as n_points, cast(sum(f.cents) as bigint) as cents,
       cast(count(*) filter (where f.level = lv.lo) as bigint) as n_surface_cells,
       cast(count(*) filter (where f.level = lv.hi and f.level <> lv.lo) as bigint) as n_bottom_cells
from f left join routes r on f.suffix = r.suffix cross join lv group by 1, 2
""")
def estuary_preprocess(spark, sf):
    c = view(spark, sf, "v_cells")
    pts = c.select("variable", F.expr(_LEVEL).alias("level"),
                   (F.dayofmonth(F.to_date("time")) % 2 + 1).alias("part"), F.to_date("time").alias("day"),
                   (F.col("lat") + F.col("lon") / F.lit(180.0)).alias("lat"),
                   (F.col("lon") + F.col("lat") / F.lit(90.0)).alias("lon"), G.to_units("value").alias("value"))
    routed = P.estuary_preprocess(pts, G.Grid(-180.0, -90.0, 180.0, 90.0, 10.0), spark=spark)
    return (routed.groupBy("suffix", "collection_suffix")
            .agg(F.count_distinct("name").cast("bigint").alias("n_files"), F.count("*").cast("bigint").alias("n_cells"),
                 F.sum("n").cast("bigint").alias("n_points"),
                 F.sum("total").cast("bigint").alias("cents"),
                 F.count_if(F.col("level_role") == "surface").cast("bigint").alias("n_surface_cells"),
                 F.count_if(F.col("level_role") == "bottom").cast("bigint").alias("n_bottom_cells")))


@query("gridding_preprocess", "P3 X23 X24 C8 A8 C9 C12 A7", views=["v_cells"], oracle="""
, b as (select variable, cast(least(floor((lat + 90) / 10), 17) as bigint) as iy,
               cast(least(floor((lon + 180) / 10), 35) as bigint) as ix, value from v_cells),
s as (select variable, iy, ix, cast(round(value_mean * 1000000) as bigint) as m from (
        select variable, iy, ix, {exact_cells} as value_mean from b group by all) t),
scaffold as (select v.variable, cast(gy.iy as bigint) as iy, cast(gx.ix as bigint) as ix
             from (select distinct variable from v_cells) v, generate_series(0, 17) gy(iy), generate_series(0, 35) gx(ix)),
d as (select scaffold.iy, scaffold.ix, s.m from scaffold left join s
      on scaffold.variable = s.variable and scaffold.iy = s.iy and scaffold.ix = s.ix)
select iy, ix, {exact_grids} as mean, cast(count(m) as bigint) as n_grids from d group by all
""".format(exact_cells=_duck_exact("sum(cast(round(value * 100) as bigint))", "count(value)"),
           exact_grids=_duck_exact("sum(m)", "count(m)", 6, 6)))
def gridding_preprocess(spark, sf):
    out = P.gridding_preprocess(spark, view(spark, sf, "v_cells"), "-180 -90 180 90", 10.0, value_digits=2)
    return out.select("iy", "ix", "mean", "n_grids")


@query("array_ingest", "P4 S8 S9 S10 S11 S18 A11", views=["v_arrays"], oracle=DUCK_CELLS + """
, i as (select dataset_id, variable, min(x) as west, min(y) as south, max(x) as east, max(y) as north,
             cast(count(value) as bigint) as n_item from cells where value is not null group by all)
select c.dataset_id, c.variable, c.y, c.x, c.value, i.west, i.south, i.east, i.north, i.n_item
from cells c join i using (dataset_id, variable) where c.value is not null
""")
def array_ingest(spark, sf):
    a = (view(spark, sf, "v_arrays").withColumn("variable", F.concat(F.lit("var"), F.col("variable_id").cast("string")))
         .withColumnRenamed("values_f", "values"))
    tiles, items = P.array_ingest(a, NX, ["dataset_id", "variable"], chunk=4, tile=4, store="part_no")
    cells = TI.tiles_to_cells(tiles, ["dataset_id", "variable"])
    return cells.join(items.select("dataset_id", "variable", "west", "south", "east", "north",
                                   F.col("n").alias("n_item")), ["dataset_id", "variable"])
