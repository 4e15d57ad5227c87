"""Driver queries for the block operators and the mesh regridding."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from gridcat.operators import blocks as BL
from gridcat.operators import cells as CE
from gridcat.operators import grid as G
from gridcat.operators import mesh as ME
from gridcat.plans.q_grid import DUCK_CELLS, DUCK_MOSAIC, NX
from gridcat.plans.registry import query
from gridcat.plans.views import view
from gridcat.session import scratch_dir


def _variable():
    return F.concat(F.lit("var"), F.col("variable_id").cast("string")).alias("variable")


def _mosaic_blocks(spark, sf):
    """The 8x8 arrays as blocks of big rasters, four time steps (the places of q_grid's mosaic)."""
    d = F.col("dataset_id")
    arrays = view(spark, sf, "v_arrays").select(
        _variable(), (d % 4).cast("int").alias("t"), "values_f",
        (NX * (F.floor(d / 4) % 32) + 256 * F.floor(d / 4096)).alias("y0"), (NX * (F.floor(d / 128) % 32)).alias("x0"))
    return BL.array_to_blocks(arrays, "values_f", [NX, NX], ["variable", "t"], ["y0", "x0"])


# ------------------------------------------------------------------ S18 S10
@query("retile", "S18 S9 S10", views=["v_arrays"], oracle=DUCK_MOSAIC + """
select variable, t, cast(y // 28 * 28 as integer) as ty0, cast(x // 28 * 28 as integer) as tx0, y, x, value
from mosaic where value is not null
""")
def retile(spark, sf):
    """8x8 blocks -> chunks of 20x12 -> tiles of 28x28, written and read back: no size divides
    another, and the shuffles carry pieces of blocks."""
    keys = ["variable", "t"]
    chunks = BL.retile(_mosaic_blocks(spark, sf), keys, [20, 12])
    tiles = BL.retile(chunks, keys, [28, 28])
    path = CE.write_chunks(tiles, scratch_dir(spark, f"retiled-{uuid.uuid4().hex}"))
    back = CE.read_chunks(spark, path).withColumns({"ty0": F.col("origin")[0], "tx0": F.col("origin")[1]})
    return BL.blocks_to_cells(back, [*keys, "ty0", "tx0"], ["y", "x"])


# ------------------------------------------------------------------ S11 U4 W7
STEPS = 5


@query("store_append", "S11 U4 W7 S9", views=["v_arrays"], oracle="""
, c as (select 'store-' || cast(dataset_id % 4 as string) as store, 3 - dataset_id % 4 as seq,
               'v' || cast((dataset_id // 4) % 3 as string) as variable, dataset_id // 12 as step, values_f
        from v_arrays),
len as (select store, seq, variable, max(step) + 1 as steps from c group by all),
o as (select store, variable, coalesce(sum(steps) over (partition by variable order by seq
             rows between unbounded preceding and 1 preceding), 0) as off from len)
select c.variable, cast(c.step + o.off as integer) as t, cast(i // 8 as integer) as y, cast(i % 8 as integer) as x,
       cast(values_f[i + 1] as double) as value
from c join o on c.store = o.store and c.variable = o.variable, range(0, len(values_f)) r(i)
""")
def store_append(spark, sf):
    """Four stores of chunks of five steps, appended in manifest order; their lengths are
    no multiples of five, so chunks are cut at the seams and after them."""
    d = F.col("dataset_id")
    planes = view(spark, sf, "v_arrays").select(
        F.concat(F.lit("store-"), (d % 4).cast("string")).alias("store"),
        F.concat(F.lit("v"), (F.floor(d / 4) % 3).cast("string")).alias("variable"),
        F.floor(d / 12).cast("int").alias("step"), "values_f")
    keys = ["store", "variable"]
    chunks = BL.retile(BL.array_to_blocks(planes, "values_f", [1, NX, NX], keys, ["step", 0, 0]), keys, [STEPS, NX, NX])
    lengths = planes.groupBy(*keys).agg((F.max("step") + 1).alias("steps"))
    manifest = planes.select("store").distinct().withColumn("seq", 3 - F.substring("store", 7, 9).cast("int"))
    merged = BL.append_stores(chunks, manifest, lengths, ["variable"], STEPS)
    return BL.blocks_to_cells(merged, ["variable"], ["t", "y", "x"])


# ------------------------------------------------------------------ S8 n-d
@query("array_4d_to_cells", "S8 S9 S10", views=["v_arrays"], oracle="""
select 'var' || cast(variable_id as string) as variable, cast(2 * (dataset_id // 8) + i // 32 as integer) as time,
       cast(2 * (dataset_id % 2) + (i // 16) % 2 as integer) as level,
       cast(4 * ((dataset_id // 2) % 2) + (i // 4) % 4 as integer) as y,
       cast(4 * ((dataset_id // 4) % 2) + i % 4 as integer) as x, cast(values_f[i + 1] as double) as value
from v_arrays, range(0, len(values_f)) t(i)
""")
def array_4d_to_cells(spark, sf):
    """Arrays of (time, level, y, x) at places of a larger grid, as chunks of 3x3x5x3 in
    a partitioned store, and back to cells named by their dims."""
    d = F.col("dataset_id")
    arrays = view(spark, sf, "v_arrays").select(
        _variable(), "values_f", (2 * F.floor(d / 8)).alias("t0"), (2 * (d % 2)).alias("l0"),
        (4 * (F.floor(d / 2) % 2)).alias("y0"), (4 * (F.floor(d / 4) % 2)).alias("x0"))
    blocks = BL.array_to_blocks(arrays, "values_f", [2, 2, 4, 4], ["variable"], ["t0", "l0", "y0", "x0"])
    path = CE.write_chunks(BL.retile(blocks, ["variable"], [3, 3, 5, 3]), scratch_dir(spark, f"nd-{uuid.uuid4().hex}"))
    return BL.blocks_to_cells(CE.read_chunks(spark, path), ["variable"], ["time", "level", "y", "x"])


# ------------------------------------------------------------------ A10
@query("overview_tiles", "A10 S18", views=["v_arrays"], oracle=DUCK_MOSAIC + """
, lv as (select unnest([1, 2, 3]) as level)
select variable, t, level, cast(y >> level as integer) as y, cast(x >> level as integer) as x,
       round(sum(value) / count(value), 6) as value
from mosaic, lv where value is not null group by all
""")
def overview_tiles(spark, sf):
    """Three overview levels of 16x16 tiles, each from the 2x2 tiles below."""
    keys = ["variable", "t"]
    tiles = BL.retile(_mosaic_blocks(spark, sf), keys, [16, 16])
    found = BL.overview_tiles(tiles, keys, [1, 2, 3], 16)
    cells = BL.blocks_to_cells(found, [*keys, "level"], ["y", "x"])
    return cells.withColumn("value", F.round("value", 6))


# ------------------------------------------------------------------ A9
MESH_GRID = G.Grid(-180.0, -90.0, 180.0, 90.0, 0.5)
_MESH_LON = "cast(-170 as double) + (dataset_id % 30) * cast(11.0 as double) + x * cast(1.25 as double) + y * cast(0.25 as double)"
_MESH_LAT = ("cast(-80 as double) + ((dataset_id // 30) % 14) * cast(11.0 as double) + y * cast(1.25 as double)"
             " - x * cast(0.25 as double) + x * y * cast(0.03125 as double)")


@query("mesh_regrid", "A9", views=["v_arrays"], oracle=DUCK_CELLS + f"""
, p as (select dataset_id, y, x, {_MESH_LON} as lon, {_MESH_LAT} as lat, value from cells),
q as (select a.dataset_id, a.y, a.x, a.lon as x00, a.lat as y00, a.value as v00, b.lon as x01, b.lat as y01, b.value as v01,
             c.lon as x10, c.lat as y10, c.value as v10, d.lon as x11, d.lat as y11, d.value as v11
      from p a join p b on b.dataset_id = a.dataset_id and b.y = a.y and b.x = a.x + 1
               join p c on c.dataset_id = a.dataset_id and c.y = a.y + 1 and c.x = a.x
               join p d on d.dataset_id = a.dataset_id and d.y = a.y + 1 and d.x = a.x + 1),
n as (select *, cast(greatest(0, ceil((least(y00, y01, y10, y11) + 90) / 0.5 - 0.5 - 1e-9)) as bigint) as iy0,
             cast(least(359, floor((greatest(y00, y01, y10, y11) + 90) / 0.5 - 0.5 + 1e-9)) as bigint) as iy1,
             cast(greatest(0, ceil((least(x00, x01, x10, x11) + 180) / 0.5 - 0.5 - 1e-9)) as bigint) as ix0,
             cast(least(719, floor((greatest(x00, x01, x10, x11) + 180) / 0.5 - 0.5 + 1e-9)) as bigint) as ix1 from q),
r as (select *, unnest(range(iy0, iy1 + 1)) as iy from n),
s as (select *, unnest(range(ix0, ix1 + 1)) as ix from r),
h as (select *, x01 - x00 as ex, y01 - y00 as ey, x10 - x00 as fx, y10 - y00 as fy, x00 - x01 + x11 - x10 as gx,
             y00 - y01 + y11 - y10 as gy, -180 + (ix + 0.5::double) * 0.5::double - x00 as hx,
             -90 + (iy + 0.5::double) * 0.5::double - y00 as hy from s),
k as (select *, gx * fy - gy * fx as a, ex * fy - ey * fx + (hx * gy - hy * gx) as b, hx * ey - hy * ex as k from h),
w as (select *, b * b - 4 * a * k as w from k where b * b - 4 * a * k >= 0),
g as (select *, -0.5::double * (b + case when b < 0 then -sqrt(w) else sqrt(w) end) as q from w),
v as (select *, unnest([case when q <> 0 then k / q end, case when a <> 0 then q / a end]) as v,
             unnest([1, 2]) as root_no from g),
u as (select *, case when abs(ex + gx * v) >= abs(ey + gy * v)
                     then case when ex + gx * v <> 0 then (hx - fx * v) / (ex + gx * v) end
                     else (hy - fy * v) / (ey + gy * v) end as u from v where v is not null),
i as (select *, row_number() over (partition by dataset_id, iy, ix order by y, x, root_no) as rn
      from u where u between -1e-9 and 1 + 1e-9 and v between -1e-9 and 1 + 1e-9),
m as (select dataset_id, iy, ix, least(greatest(u, 0), 1) as u, least(greatest(v, 0), 1) as v, v00, v01, v10, v11
      from i where rn = 1)
select dataset_id, iy, ix, round((1 - u) * (1 - v) * v00 + u * (1 - v) * v01 + (1 - u) * v * v10 + u * v * v11, 6) as value
from m
""")
def mesh_regrid(spark, sf):
    """Every 8x8 array on a skewed and warped mesh of its own (latitude and longitude per
    point), on the cells of a half-degree grid; the mesh is coarser than the grid."""
    arrays = view(spark, sf, "v_arrays")
    cells = BL.blocks_to_cells(BL.array_to_blocks(arrays, "values_f", [NX, NX], ["dataset_id"]), ["dataset_id"], ["y", "x"])
    lon, lat = (F.expr(s.replace("//", "div")) for s in (_MESH_LON, _MESH_LAT))
    points = cells.withColumns({"lon": lon, "lat": lat})
    found = ME.regrid_mesh(points, MESH_GRID, ["dataset_id"])
    return found.select("dataset_id", "iy", "ix", F.round("value", 6).alias("value"))
