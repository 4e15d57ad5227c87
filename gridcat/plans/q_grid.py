"""Driver queries for arrays, chunks, stores, tiles and grids."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from gridcat.operators import cells as CE
from gridcat.operators import grid as G
from gridcat.operators import slices as SL
from gridcat.operators import tiles as TI
from gridcat.plans.registry import query
from gridcat.plans.views import view
from gridcat.session import scratch_dir

NX = 8  # v_arrays are 8x8 grids


def _cells(spark, sf):
    """v_arrays flattened: (dataset_id, variable, y, x, value)."""
    a = view(spark, sf, "v_arrays").withColumn("variable", F.concat(F.lit("var"), F.col("variable_id").cast("string")))
    return CE.array_to_cells(a, "values_f", NX, keep=["dataset_id", "variable"])


DUCK_CELLS = """
, cells as (select dataset_id, 'var' || cast(variable_id as string) as variable, cast(i // 8 as integer) as y,
                   cast(i % 8 as integer) as x, cast(values_f[i + 1] as double) as value
            from v_arrays, range(0, len(values_f)) t(i))"""


# ------------------------------------------------------------------ S8 C13 X17 X18
@query("array_to_cells", "S8 C13 X17 X18", views=["v_arrays"], oracle=DUCK_CELLS + """
select dataset_id, variable, y, x, cast(-78.75 as double) + y * cast(22.5 as double) as lat,
       cast(-157.5 as double) + x * cast(45 as double) as lon, value, 'lat' as y_dim, 'lon' as x_dim,
       'EPSG:4326' as crs
from cells
""")
def array_to_cells_q(spark, sf):
    """Arrays -> cells with coordinates looked up from the axes (named as in
    the file, renamed to lat/lon) and the spatial dims + CRS tagged."""
    cells = _cells(spark, sf)
    lat_axis = spark.range(NX).select(F.col("id").cast("int").alias("idx"),
                                      (F.lit(-78.75) + F.col("id") * F.lit(22.5)).alias("latitude"))
    lon_axis = spark.range(NX).select(F.col("id").cast("int").alias("idx"),
                                      (F.lit(-157.5) + F.col("id") * F.lit(45.0)).alias("longitude"))
    out = CE.attach_coords(cells, lat_axis, lon_axis)
    out = CE.rename_coords(out, lat="latitude", lon="longitude")
    out = CE.tag_spatial_dims(out.withColumn("dims", F.array(F.lit("lat"), F.lit("lon"))), "dims")
    return out.select("dataset_id", "variable", "y", "x", "lat", "lon", "value", "y_dim", "x_dim", "crs")


# ------------------------------------------------------------------ S9 S10
def _mosaic(cells):
    """The 8x8 arrays laid out as blocks of big rasters, four time steps, so
    that the default 256x256 chunks and tiles are filled."""
    d = F.col("dataset_id")
    return cells.select("variable", (d % 4).cast("int").alias("t"),
                        (F.col("y") + NX * (F.floor(d / 4) % 32) + 256 * F.floor(d / 4096)).cast("int").alias("y"),
                        (F.col("x") + NX * (F.floor(d / 128) % 32)).cast("int").alias("x"), "value")


DUCK_MOSAIC = DUCK_CELLS + """
, mosaic as (select variable, cast(dataset_id % 4 as integer) as t,
                    cast(y + 8 * ((dataset_id // 4) % 32) + 256 * (dataset_id // 4096) as integer) as y,
                    cast(x + 8 * ((dataset_id // 128) % 32) as integer) as x, max(value) as value
             from cells where value is not null group by all)"""


@query("chunk_roundtrip", "S9 S10", views=["v_arrays"], oracle=DUCK_MOSAIC + """
select variable, t, y, x, value from mosaic
""")
def chunk_roundtrip(spark, sf):
    """cells -> chunks of 2 x 256 x 256 -> partitioned store -> cells is
    lossless; a repeated cell keeps its greatest value."""
    chunks = CE.cells_to_chunks(_mosaic(_cells(spark, sf)), ["variable"], ct=2, t="t")
    path = CE.write_chunks(chunks, scratch_dir(spark, f"chunks-{uuid.uuid4().hex}"))
    back = CE.chunks_to_cells(CE.read_chunks(spark, path), ["variable"], with_t=True)
    return back.select("variable", "t", "y", "x", "value")


# ------------------------------------------------------------------ S11 S12 W7 U4
@query("store_concat", "S11 W7 U4", views=["v_arrays"], oracle="""
, c as (select 'store-' || cast(variable_id as string) as store, variable_id as seq, dataset_id,
               'v' || cast(dataset_id % 3 as string) as variable, cast(dataset_id % 10 as integer) as day,
               cast(i // 8 as integer) as y, cast(i % 8 as integer) as x, cast(values_f[i + 1] as double) as value
        from v_arrays, range(0, len(values_f)) t(i)),
w as (select * from (select *, row_number() over (partition by variable, day, y, x
                                                   order by seq desc, dataset_id desc) as rn from c) t where rn = 1),
r as (select variable, day, cast(dense_rank() over (partition by variable order by day) - 1 as integer) as t
      from (select distinct variable, day from w) d)
select w.variable, w.day, r.t, w.y, w.x, w.value, w.store, w.dataset_id
from w join r on w.variable = r.variable and w.day = r.day
""")
def store_concat(spark, sf):
    """Each label is one store; the manifest orders stores by label; the
    concatenation keeps, per (variable, day, y, x), the later store's cell
    and re-indexes the days per variable."""
    a = view(spark, sf, "v_arrays").select(
        F.concat(F.lit("store-"), F.col("variable_id").cast("string")).alias("store"), "dataset_id",
        F.concat(F.lit("v"), (F.col("dataset_id") % 3).cast("string")).alias("variable"),
        (F.col("dataset_id") % 10).cast("int").alias("day"), "values_f")
    cells = CE.array_to_cells(a, "values_f", NX, keep=["store", "dataset_id", "variable", "day"])
    manifest = view(spark, sf, "v_arrays").select(
        F.col("variable_id").alias("seq"),
        F.concat(F.lit("store-"), F.col("variable_id").cast("string")).alias("store")).distinct()
    merged = CE.concat_stores(cells, manifest, keys=["variable", "day", "y", "x"], tie=["dataset_id"])
    out = CE.reindex_time(merged, ["variable"], "day", "t")
    return out.select("variable", "day", "t", "y", "x", "value", "store", "dataset_id")


# ------------------------------------------------------------------ S18
@query("raster_tiles", "S18", views=["v_arrays"], oracle=DUCK_MOSAIC + """
, s as (select variable, t, cast(y // 256 as integer) as ty, cast(x // 256 as integer) as tx,
               cast(count(*) as bigint) as n, min(value) as vmin, max(value) as vmax from mosaic group by all)
select m.variable, m.t, m.y, m.x, m.value, s.n, s.vmin, s.vmax
from mosaic m join s on s.variable = m.variable and s.t = m.t and s.ty = m.y // 256 and s.tx = m.x // 256
""")
def raster_tiles(spark, sf):
    """256x256 tiles written as a partitioned store and read back: every value
    at its place, with the statistics of its tile."""
    tiles = TI.cells_to_tiles(_mosaic(_cells(spark, sf)), ["variable", "t"])
    path = TI.write_tiles(tiles, scratch_dir(spark, f"tiles-{uuid.uuid4().hex}"))
    return TI.tiles_to_cells(spark.read.parquet(path), ["variable", "t", "n", "vmin", "vmax"])


# ------------------------------------------------------------------ C8 A8
G1 = G.Grid(-180.0, -90.0, 180.0, 90.0, 1.0)


def _duck_exact(total: str, n: str, in_digits: int = 2, out_digits: int = 6) -> str:
    """DuckDB form of grid.exact_mean (same integer rounding, one division)."""
    num = f"(cast({total} as bigint) * {2 * 10 ** (out_digits - in_digits)} + {n})"
    den = f"(2 * {n})"
    return (f"case when {n} > 0 then cast(({num} - ((({num} % {den}) + {den}) % {den})) // {den} as double) / "
            f"cast({10 ** out_digits} as double) end")


def _exact_stats(points, grid, keys=("variable",)):
    """Bin statistics with the exact mean of 2-decimal values (sum of cents)."""
    s = G.bin_mean(points.withColumn("cents", G.to_units("value")), grid, list(keys), value="cents")
    return s.withColumn("mean", G.exact_mean("total", "n"))


def _duck_bins(res: int, nx: int, ny: int, lat: str = "lat", lon: str = "lon", src: str = "v_cells") -> str:
    return f"""
select variable, cast(least(floor(({lat} - cast(-90 as double)) / cast({res} as double)), {ny - 1}) as bigint) as iy,
       cast(least(floor(({lon} - cast(-180 as double)) / cast({res} as double)), {nx - 1}) as bigint) as ix,
       value, cast(round(value * 100) as bigint) as cents
from {src} where {lon} >= -180 and {lon} <= 180 and {lat} >= -90 and {lat} <= 90"""


@query("point_to_grid", "C8 A8", views=["v_cells"], oracle=f"""
, b as ({_duck_bins(1, 360, 180)})
select variable, iy, ix, {_duck_exact("sum(cents)", "count(value)")} as mean, cast(count(value) as bigint) as n
from b group by all
""")
def point_to_grid(spark, sf):
    s = _exact_stats(view(spark, sf, "v_cells"), G1)
    return s.select("variable", "iy", "ix", "mean", "n")


# ------------------------------------------------------------------ C9
G10 = G.Grid(-180.0, -90.0, 180.0, 90.0, 10.0)


@query("dense_grid", "C9", views=["v_cells"], oracle=f"""
, b as ({_duck_bins(1, 360, 180)}),
s as (select variable, iy, ix, {_duck_exact("sum(cents)", "count(value)")} as mean, cast(count(value) as bigint) as n
      from b group by all),
scaffold as (select v.variable, cast(gy.iy as bigint) as iy, cast(gx.ix as bigint) as ix
             from (select distinct variable from v_cells) v, generate_series(0, 179) gy(iy), generate_series(0, 359) gx(ix))
select scaffold.variable, scaffold.iy, scaffold.ix, s.mean, cast(coalesce(s.n, 0) as bigint) as n
from scaffold left join s on scaffold.variable = s.variable and scaffold.iy = s.iy and scaffold.ix = s.ix
""")
def dense_grid(spark, sf):
    """Every cell of a 1-degree grid per variable, empty ones with n = 0."""
    cells = view(spark, sf, "v_cells")
    stats = _exact_stats(cells, G1).select("variable", "iy", "ix", "mean", "n")
    return G.densify(stats, G.dense_scaffold(G1, cells)).select("variable", "iy", "ix", "mean", "n")


# ------------------------------------------------------------------ A9
G05 = G.Grid(-180.0, -90.0, 180.0, 90.0, 0.5)


@query("curvilinear_regrid", "A9", views=["v_cells"], oracle=f"""
, sk as (select variable, lat + lon / cast(180 as double) as lat2, lon + lat / cast(90 as double) as lon2, value
         from v_cells),
b as ({_duck_bins('0.5', 720, 360, 'lat2', 'lon2', 'sk')})
select variable, iy, ix, {_duck_exact("sum(cents)", "count(value)")} as mean, cast(count(value) as bigint) as n
from b group by all
""")
def curvilinear_regrid(spark, sf):
    """Points on a skewed (curvilinear) grid - 2-d lat/lon per point - to a
    regular 0.5-degree grid by bin mean."""
    c = view(spark, sf, "v_cells")
    sk = c.select("variable", (F.col("lat") + F.col("lon") / F.lit(180.0)).alias("lat"),
                  (F.col("lon") + F.col("lat") / F.lit(90.0)).alias("lon"), "value")
    s = _exact_stats(sk, G05)
    return s.select("variable", "iy", "ix", "mean", "n")


# ------------------------------------------------------------------ C12 A7
@query("combine_grids", "C12 A7", views=["v_cells"], oracle=f"""
, b as ({_duck_bins(10, 36, 18)}),
g as (select variable, iy, ix, cast(round({_duck_exact("sum(cents)", "count(value)")} * 1000000) as bigint) as m
      from b group by all)
select iy, ix, cast(sum(m) as double) / cast(1000000 as double) as sum,
       {_duck_exact("sum(m)", "count(m)", 6, 6)} as mean,
       median(cast(m as double)) / cast(1000000 as double) as median,
       cast(min(m) as double) / cast(1000000 as double) as min,
       cast(max(m) as double) / cast(1000000 as double) as max,
       case when count(m) > 0 then true end as mean_agrees, cast(count(m) as bigint) as n_grids
from g group by all
""")
def combine_grids(spark, sf):
    """Each variable is one gridded output (one config); combine the outputs
    per cell with all five methods, one aggregate for all."""
    g = _exact_stats(view(spark, sf, "v_cells"), G10)
    # per-grid means as exact integers of 1e-6 units, so every combination is
    # exact; the mean is the operator's own, rounded as fixed-point values are
    micro = g.select("iy", "ix", F.round(F.col("mean") * F.lit(1000000)).cast("bigint").alias("m"))
    c = G.combine_grids(micro.select("iy", "ix", F.col("m").cast("double").alias("mean")))
    scaled = [(F.col(m) / F.lit(1e6)).alias(m) for m in ("sum", "median", "min", "max")]
    exact = G.exact_mean(F.round("sum").cast("bigint"), F.col("n_grids"), 6, 6)
    return c.select("iy", "ix", *scaled, exact.alias("mean"),
                    (F.abs(F.col("mean") / F.lit(1e6) - exact) < 1e-6).alias("mean_agrees"), "n_grids")


# ------------------------------------------------------------------ A10
@query("overview_pyramid", "A10", views=["v_arrays"], oracle=DUCK_CELLS + """
, lv as (select unnest([1, 2, 3]) as level)
select dataset_id, variable, level, y >> level as y, x >> level as x, round(sum(value) / count(value), 6) as mean,
       cast(count(value) as bigint) as n
from cells, lv where value is not null group by all
""")
def overview_pyramid(spark, sf):
    p = TI.overview_levels(_cells(spark, sf), ["dataset_id", "variable"], [1, 2, 3])
    return p.select("dataset_id", "variable", "level", "y", "x", F.round("mean", 6).alias("mean"), "n")


# ------------------------------------------------------------------ A11
@query("derive_items", "A11", views=["v_cells"], oracle="""
select variable, cast(time as date) as day, min(lon) as west, min(lat) as south, max(lon) as east, max(lat) as north,
       cast(count(value) as bigint) as n
from v_cells group by all
""")
def derive_items(spark, sf):
    c = view(spark, sf, "v_cells").withColumn("day", F.to_date("time"))
    return TI.derive_items(c, ["variable", "day"])


# ------------------------------------------------------------------ W5
@query("time_slices", "W5", views=["v_cells"], oracle="""
, d as (select variable, cast(time as date) as day, count(*) as n from v_cells group by all)
select variable, day, cast(dense_rank() over (partition by variable order by day) as integer) as slice,
       cast(n as bigint) as n from d
""")
def time_slices(spark, sf):
    c = view(spark, sf, "v_cells").withColumn("day", F.to_date("time"))
    per_day = c.groupBy("variable", "day").agg(F.count("*").cast("bigint").alias("n"))
    return SL.time_slices(per_day, ["variable"], "day").select("variable", "day", "slice", "n")


# ------------------------------------------------------------------ W6 C10 L1
_FILE = "'dataset' || cast(dataset_id as string) || '_s' || cast(level as string) || '_' || cast(part_no + 1 as string) || '.nc'"


@query("level_route", "W6 C10 L1", views=["v_arrays"], oracle=f"""
, f as (select {_FILE} as name, level, part_no from v_arrays),
lv as (select part_no, min(level) as lo, max(level) as hi from f group by 1),
routes as (select * from (values ('s0_1', 'surface_nowcast'), ('s0_2', 'surface_forecast'),
                                 ('s19_1', 'bottom_nowcast'), ('s19_2', 'bottom_forecast')) r(suffix, collection_suffix))
select r.suffix, r.collection_suffix, min(f.name) as first_file, cast(count(*) as bigint) as n_files,
       cast(count(*) filter (where f.level = lv.lo) as bigint) as n_surface,
       cast(count(*) filter (where f.level = lv.hi) as bigint) as n_bottom
from f join lv on f.part_no = lv.part_no left join routes r on ends_with(f.name, '_' || r.suffix || '.nc')
group by 1, 2
""")
def level_route(spark, sf):
    """Sliced files named ``..._s<level>_<1|2>.nc`` routed to the four
    surface/bottom x nowcast/forecast collections; surface and bottom are also
    derived from the data (lowest/highest level per part).  Files without a
    route are one row with NULLs."""
    f = view(spark, sf, "v_arrays").select(F.expr(_FILE).alias("name"), "level", "part_no")
    f = SL.pick_levels(f, ["part_no"], "level")
    routed = SL.route_files(f, SL.routes_table(spark))
    return (routed.groupBy("suffix", "collection_suffix")
            .agg(F.min("name").alias("first_file"), F.count("*").cast("bigint").alias("n_files"),
                 F.count_if(F.col("level_role") == "surface").cast("bigint").alias("n_surface"),
                 F.count_if(F.col("level_role") == "bottom").cast("bigint").alias("n_bottom")))
