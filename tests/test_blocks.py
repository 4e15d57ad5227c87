"""Block algebra, store append, overviews and mesh regridding on literal rows and against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridcat.operators import blocks as BL
from gridcat.operators import cells as CE
from gridcat.operators import grid as G
from gridcat.operators import mesh as ME

SCHEMA = "k string, origin array<int>, shape array<int>, values array<double>"


def as_blocks(spark, array, sizes, key="a", at=None):
    """The whole array cut into blocks of ``sizes``, edge blocks smaller; NaN as NULL."""
    rows = []
    for corner in np.ndindex(*(-(-n // s) for n, s in zip(array.shape, sizes))):
        low = [c * s for c, s in zip(corner, sizes)]
        part = array[tuple(slice(a, a + s) for a, s in zip(low, sizes))]
        place = [int(a + (o or 0)) for a, o in zip(low, at or [0] * len(low))]
        rows.append((key, place, [int(n) for n in part.shape], [None if np.isnan(v) else float(v) for v in part.ravel()]))
    return spark.createDataFrame(rows, SCHEMA)


def as_array(df, shape):
    out = np.full(shape, np.nan)
    for r in df.collect():
        part = np.array([np.nan if v is None else v for v in r["values"]]).reshape(r["shape"])
        place = tuple(slice(o, o + n) for o, n in zip(r["origin"], r["shape"]))
        inside = tuple(slice(0, max(0, min(n, s - o))) for o, n, s in zip(r["origin"], r["shape"], shape))
        view = out[place]
        assert np.isnan(view).all()     # no cell twice
        out[place] = part[inside]
        assert np.isnan(part).sum() >= part.size - part[inside].size
    return out


def numbers(*shape, seed=1):
    draw = np.random.default_rng(seed)
    out = draw.integers(-99, 99, shape).astype(float)
    out[draw.random(shape) < 0.1] = np.nan
    return out


@pytest.mark.parametrize("shape, was, now", [
    ((23, 31), (8, 8), (5, 7)), ((23, 31), (5, 7), (8, 8)), ((9,), (4,), (3,)), ((16, 16), (8, 8), (8, 8)),
    ((5, 3, 6, 7), (2, 2, 4, 4), (3, 3, 5, 3)), ((4, 9), (4, 9), (2, 4))])
def test_retile(spark, shape, was, now):
    array = numbers(*shape)
    found = BL.retile(as_blocks(spark, array, was), ["k"], list(now))
    assert {tuple(r["shape"]) for r in found.select("shape").collect()} == {tuple(now)}     # tiles are whole
    np.testing.assert_array_equal(as_array(found, shape), array)


def test_retile_negative_origin_gap_and_overlap(spark):
    rows = [("a", [-3, 2], [2, 2], [1.0, 2.0, 3.0, 4.0]), ("b", [0, 0], [1, 1], [None])]
    found = {(r["k"], *r["origin"]): r["values"] for r in BL.retile(spark.createDataFrame(rows, SCHEMA), ["k"], [2, 4]).collect()}
    assert found == {("a", -4, 0): [None] * 6 + [1.0, 2.0], ("a", -2, 0): [None, None, 3.0, 4.0] + [None] * 4,
                     ("b", 0, 0): [None] * 8}
    twice = spark.createDataFrame([("a", [0], [3], [1.0, 2.0, 3.0]), ("a", [2], [2], [5.0, 6.0])], SCHEMA)
    with pytest.raises(Exception, match="blocks overlap"):
        BL.retile(twice, ["k"], [8]).collect()
    assert BL.retile(twice.limit(0), ["k"], [8]).collect() == []


def test_retile_shuffles_blocks_not_cells(spark):
    df = as_blocks(spark, numbers(64, 64), (16, 16))
    pieces = BL.cut(df, ["k"], [24, 24])
    assert pieces.count() == 25         # 16 blocks, those that a border crosses in two or four pieces
    plan = BL.retile(df, ["k"], [24, 24])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "posexplode" not in plan


def test_array_to_blocks_and_cells(spark):
    rows = [("a", [1.0, float("nan"), None, 4.0, 5.0, 6.0], [1, 2, 3]), ("b", None, [1, 1, 1])]
    arrays = spark.createDataFrame(rows, "k string, values array<double>, shape array<int>")
    blocks = BL.array_to_blocks(arrays, keep=["k"], origin=[7, 0, 2], axes=3)
    cells = BL.blocks_to_cells(blocks, ["k"], ["time", "level", "x"])
    assert sorted(map(tuple, cells.collect())) == [("a", 7, 0, 2, 1.0), ("a", 7, 1, 2, 4.0), ("a", 7, 1, 3, 5.0), ("a", 7, 1, 4, 6.0)]
    assert BL.blocks_to_cells(blocks, ["k"], ["time", "level", "x"], absent=True).count() == 6
    wrong = spark.createDataFrame([("a", [1.0], [1, 2, 3])], arrays.schema)
    with pytest.raises(Exception, match="values its shape says"):
        BL.array_to_blocks(wrong, keep=["k"], axes=3).collect()


def stores(spark, lengths, steps):
    """Stores of random planes of 2x3, chunked by ``steps`` with padded last chunks; the whole array."""
    chunks, rows, whole = None, [], []
    for i, n in enumerate(lengths):
        array = numbers(n, 2, 3, seed=i)
        whole.append(array)
        padded = np.full((-(-n // steps) * steps, 2, 3), np.nan)
        padded[:n] = array
        part = as_blocks(spark, padded, (steps, 2, 2), "v").withColumn("store", F.lit(f"s{i}"))
        chunks = part if chunks is None else chunks.unionByName(part)
        rows.append((f"s{i}", "v", n))
    manifest = spark.createDataFrame([(i, f"s{i}") for i in range(len(lengths))], "seq int, store string")
    return chunks, manifest, spark.createDataFrame(rows, "store string, k string, steps int"), np.concatenate(whole)


@pytest.mark.parametrize("lengths, steps", [([4, 8, 3], 4), ([3, 5, 1, 6], 4), ([1, 1, 1, 1, 1], 4), ([7], 3)])
def test_append_stores(spark, lengths, steps):
    chunks, manifest, sizes, whole = stores(spark, lengths, steps)
    merged = BL.append_stores(chunks, manifest, sizes, ["k"], steps)
    rows = merged.collect()
    assert all(r["origin"][0] % steps == 0 and r["shape"][0] <= steps for r in rows)
    assert max(r["origin"][0] + r["shape"][0] for r in rows) == len(whole)
    np.testing.assert_array_equal(as_array(merged, whole.shape), whole)
    # the same cells as the cell-wise concatenation with the times counted on
    cells = BL.blocks_to_cells(chunks, ["store", "k"], ["t", "y", "x"])
    offsets = BL.time_offsets(sizes, manifest, ["k"])
    timed = cells.join(offsets, ["store", "k"]).withColumn("time", F.col("t") + F.col("offset")).select(
        "store", F.col("k").alias("variable"), "time", "y", "x", "value")
    want = CE.concat_stores(timed, manifest).select("variable", "time", "y", "x", "value")
    got = BL.blocks_to_cells(merged, ["k"], ["t", "y", "x"])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_append_of_aligned_stores_opens_and_shuffles_no_chunk(spark):
    chunks, manifest, sizes, _ = stores(spark, [4, 8, 3], 4)
    merged = BL.append_stores(chunks, manifest, sizes, ["k"], 4)
    plan = merged._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "Aggregate" not in plan
    with pytest.raises(Exception, match="store not in the manifest"):
        BL.append_stores(chunks, manifest.where("seq > 0"), sizes, ["k"], 4).collect()


def test_overview_tiles(spark):
    array = numbers(40, 56)
    tiles = BL.retile(as_blocks(spark, array, (7, 9)), ["k"], [8, 8])
    found = BL.overview_tiles(tiles, ["k"], [1, 3], 8)
    cells = {(r["level"], r["y"], r["x"]): r["value"] for r in BL.blocks_to_cells(found, ["k", "level"], ["y", "x"]).collect()}
    want = {}
    for z in (1, 3):
        for y in range(0, 40, 1 << z):
            for x in range(0, 56, 1 << z):
                part = array[y:y + (1 << z), x:x + (1 << z)]
                if not np.isnan(part).all():
                    want[z, y >> z, x >> z] = np.nanmean(part)
    assert cells.keys() == want.keys() and all(abs(cells[k] - want[k]) < 1e-9 for k in want)
    counts = found.where("level = 3").select(F.aggregate("n", F.lit(0).cast("bigint"), lambda a, b: a + b).alias("n"))
    assert sum(r.n for r in counts.collect()) == np.count_nonzero(~np.isnan(array))


# ---------------------------------------------------------------- A9
def warped(spark, ny, nx, field, hole=()):
    rows = []
    for y in range(ny):
        for x in range(nx):
            lon, lat = 10 + 1.1 * x + 0.3 * y, 20 + 0.9 * y - 0.2 * x + 0.02 * x * y
            rows.append(("v", y, x, lon, lat, None if (y, x) in hole else field(lon, lat)))
    return spark.createDataFrame(rows, "variable string, y int, x int, lon double, lat double, value double")


def test_linear_field_is_exact_and_no_hole_is_left(spark):
    grid = G.Grid(9.0, 18.0, 24.0, 30.0, 0.25)
    points = warped(spark, 9, 10, lambda lon, lat: 3 * lon - 2 * lat + 7)
    got = {(r.iy, r.ix): r.value for r in ME.regrid_mesh(points, grid).collect()}
    for (iy, ix), value in got.items():
        lon, lat = 9 + (ix + 0.5) * 0.25, 18 + (iy + 0.5) * 0.25
        assert abs(value - (3 * lon - 2 * lat + 7)) < 1e-9
    by_row = {}
    for iy, ix in got:
        by_row.setdefault(iy, []).append(ix)
    assert all(sorted(xs) == list(range(min(xs), max(xs) + 1)) for xs in by_row.values())     # the mesh is convex
    coarse = G.bin_mean(points, grid).count()
    assert len(got) > 5 * coarse        # the bin mean leaves most cells empty


def test_mesh_edges_holes_repeats_and_parallelograms(spark):
    # the grid's centres lie on the mesh's own points and edges: each cell once
    square = [("v", y, x, float(x), float(y), float(10 * y + x)) for y in range(4) for x in range(4)]
    points = spark.createDataFrame(square + [square[5]], "variable string, y int, x int, lon double, lat double, value double")
    grid = G.Grid(-0.25, -0.25, 3.25, 3.25, 0.5)
    got = {(r.iy, r.ix): r.value for r in ME.regrid_mesh(points, grid).collect()}
    assert got == {(i, j): 10 * i / 2 + j / 2 for i in range(7) for j in range(7)}
    # a missing value makes its quads NULL, a missing point removes them
    some = ME.regrid_mesh(points.withColumn("value", F.when(~((F.col("y") == 1) & (F.col("x") == 1)), F.col("value"))), grid)
    assert {(r.iy, r.ix) for r in some.collect() if r.value is None} >= {(1, 1), (1, 3), (3, 3)}
    cut = {(r.iy, r.ix) for r in ME.regrid_mesh(points.where("not (y = 3 and x = 3)"), grid).collect()}
    assert cut == {(i, j) for i in range(7) for j in range(7)} - {(5, 5), (5, 6), (6, 5), (6, 6)}
    assert ME.regrid_mesh(points.limit(0), grid).collect() == []
