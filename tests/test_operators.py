"""Operator tests with literal rows and properties: catalog merge, cells,
chunks, grids, tiles, slices, layers, jobs."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from gridcat.operators import cells as CE
from gridcat.operators import grid as G
from gridcat.operators import jobs as JO
from gridcat.operators import layers as LY
from gridcat.operators import notify as NO
from gridcat.operators import slices as SL
from gridcat.operators import tiles as TI
from gridcat.operators import upsert as UP

from conftest import rows

D = dt.datetime


# ---------------------------------------------------------------- W1 C4 C5 A1 C3 A6 S15
def test_dedupe_last_wins(spark):
    df = spark.createDataFrame([("i1", 1, "a"), ("i1", 3, "c"), ("i1", 2, "b"), ("i2", 1, "x")],
                               "id string, seq int, v string")
    assert rows(UP.dedupe_last_wins(df, ["id"], ["seq"])) == [
        {"id": "i1", "seq": 3, "v": "c"}, {"id": "i2", "seq": 1, "v": "x"}]


def test_insert_and_upsert(spark):
    old = spark.createDataFrame([("c", "1", 1), ("c", "2", 2)], "cid string, iid string, v int")
    new = spark.createDataFrame([("c", "2", 20), ("c", "3", 30)], "cid string, iid string, v int")
    ins, conf = UP.insert_items(old, new, ["cid", "iid"])
    assert [r.iid for r in ins.collect()] == ["3"] and [r.iid for r in conf.collect()] == ["2"]
    once = UP.upsert_items(old, new, ["cid", "iid"])
    assert rows(once) == [{"cid": "c", "iid": "1", "v": 1}, {"cid": "c", "iid": "2", "v": 20},
                          {"cid": "c", "iid": "3", "v": 30}]
    twice = UP.upsert_items(once, new, ["cid", "iid"])  # C5 is idempotent
    assert rows(twice) == rows(once)


def test_temporal_extent_union(spark):
    iv = spark.createDataFrame([("A", D(2020, 1, 1), D(2020, 6, 1)), ("A", D(2019, 1, 1), None),
                                ("B", None, None)], "c string, start_ts timestamp, end_ts timestamp")
    out = {r.c: (r.extent_start, r.extent_end) for r in UP.merge_temporal_extent(iv, "c").collect()}
    assert out["A"] == (D(2019, 1, 1), D(2020, 6, 1))   # Q5: the open end is ignored
    assert out["B"] == (None, None)
    kept = {r.c: r.extent_end for r in UP.merge_temporal_extent(iv, "c", keep_open=True).collect()}
    assert kept["A"] is None


def test_temporal_extent_commutative(spark):
    a = [("X", D(2020, 1, 1), D(2020, 2, 1)), ("X", D(2021, 1, 1), D(2021, 3, 1))]
    s = "c string, start_ts timestamp, end_ts timestamp"
    r1 = UP.merge_temporal_extent(spark.createDataFrame(a, s), "c").first()
    r2 = UP.merge_temporal_extent(spark.createDataFrame(a[::-1], s), "c").first()
    assert r1 == r2


def test_upsert_collections(spark):
    s = "collection_id string, start_ts timestamp, end_ts timestamp"
    new = spark.createDataFrame([("A", D(2021, 1, 1), D(2021, 2, 1)), ("N", D(2022, 1, 1), D(2022, 1, 2))], s)
    remote = spark.createDataFrame([("A", D(2020, 1, 1), D(2020, 5, 1)), ("R", D(2019, 1, 1), None),
                                    ("E", D(2018, 1, 1), D(2018, 2, 1))], s)
    counts = spark.createDataFrame([("A", 3), ("N", 1)], "collection_id string, n_new_items long")
    out = {r.collection_id: r for r in UP.upsert_collections(new, remote, counts).collect()}
    assert out["A"].action == "update" and (out["A"].extent_start, out["A"].extent_end) == (D(2020, 1, 1),
                                                                                          D(2021, 2, 1))
    assert out["N"].action == "create" and out["R"].action == "unchanged"   # Q7
    assert out["R"].extent_end is None


def test_ingest_summary(spark):
    per = spark.createDataFrame([("A", True, 5, 0), ("B", False, 3, 2), ("C", True, 1, 0)],
                                "collection_id string, ok boolean, n_items long, n_conflicts long")
    r = NO.ingest_summary(per).first()
    assert (r.collections_ingested, r.collections_failed, r.items_ingested, r.item_conflicts) == (2, 1, 6, 2)
    assert rows(NO.failed_collections(per)) == [{"collection_id": "B", "n_items": 3, "n_conflicts": 2}]


def test_distinct_asset_uris_first_seen(spark):
    a = spark.createDataFrame([("asset", "u1", 3), ("asset", "u1", 1), ("aux", "u2", 0), ("asset", "u3", 2)],
                              "asset_key string, uri string, seq int")
    assert rows(NO.distinct_asset_uris(a, ["seq"])) == [{"uri": "u1", "first_seq": 1}, {"uri": "u3", "first_seq": 2}]


def test_item_versions(spark, tmp_path):
    items = spark.createDataFrame([("c", "1")], "collection_id string, item_id string")
    root = str(tmp_path / "items")
    UP.write_item_version(items, root, 0)
    UP.write_item_version(items, root, 1)
    assert UP.latest_version(spark, root) == 1
    assert spark.read.parquet(f"{root}/v=00000001").count() == 1


# ---------------------------------------------------------------- S8 S9 S10 S11 W7 X17
def _grid_cells(spark, ny=5, nx=7, holes=()):
    data = [("d", "v", y, x, None if (y, x) in holes else float(y * 10 + x)) for y in range(ny) for x in range(nx)]
    return spark.createDataFrame(data, "dataset_id string, variable string, y int, x int, value double")


def test_array_to_cells(spark):
    arr = spark.createDataFrame([("d", [1.0, 2.0, float("nan"), 4.0, 5.0, 6.0], [2, 3])],
                                "dataset_id string, values array<double>, shape array<int>")
    out = rows(CE.array_to_cells(arr, "values", keep=["dataset_id"]), order=lambda d: (d["y"], d["x"]))
    assert [(r["y"], r["x"], r["value"]) for r in out] == [
        (0, 0, 1.0), (0, 1, 2.0), (0, 2, None), (1, 0, 4.0), (1, 1, 5.0), (1, 2, 6.0)]


@pytest.mark.parametrize("cy,cx", [(2, 3), (4, 4), (256, 256)])
def test_chunk_roundtrip_is_identity(spark, cy, cx):
    cells = _grid_cells(spark, holes={(1, 1), (4, 6)})
    back = CE.chunks_to_cells(CE.cells_to_chunks(cells, ["dataset_id", "variable"], cy=cy, cx=cx),
                              ["dataset_id", "variable"])
    assert rows(back) == rows(cells.filter(F.col("value").isNotNull()))


def test_concat_later_store_wins_and_reindex(spark):
    s = "store string, variable string, time int, y int, x int, value double"
    a = spark.createDataFrame([("A", "v", 10, 0, 0, 1.0), ("A", "v", 20, 0, 0, 2.0)], s)
    b = spark.createDataFrame([("B", "v", 20, 0, 0, 9.0), ("B", "v", 30, 0, 0, 3.0)], s)
    manifest = spark.createDataFrame([(0, "A"), (1, "B")], "seq int, store string")
    out = CE.reindex_time(CE.concat_stores([a, b], manifest), ["variable"], "time", "t")
    got = sorted((r.time, r.t, r.value, r.store) for r in out.collect())
    assert got == [(10, 0, 1.0, "A"), (20, 1, 9.0, "B"), (30, 2, 3.0, "B")]


def test_rename_coords_missing_fails(spark):
    df = spark.createDataFrame([(1.0,)], "latitude double")
    assert CE.rename_coords(df, lat="latitude").columns == ["lat"]
    with pytest.raises(ValueError):
        CE.rename_coords(df, lon="longitude")


# ---------------------------------------------------------------- C8 C9 C12 A7 A8 A10 S18
def test_cell_assignment_edges(spark):
    g = G.Grid(0.0, 0.0, 10.0, 10.0, 5.0)
    pts = spark.createDataFrame([(0.0, 0.0, 1.0), (10.0, 10.0, 2.0), (4.999, 5.0, 3.0), (10.5, 1.0, 4.0)],
                                "lon double, lat double, value double")
    got = sorted((r.iy, r.ix, r.value) for r in G.assign_cells(pts, g).collect())
    assert got == [(0, 0, 1.0), (1, 0, 3.0), (1, 1, 2.0)]   # max edge -> last cell, outside dropped


def test_bin_mean_and_dense(spark):
    g = G.Grid(0.0, 0.0, 4.0, 2.0, 1.0)
    pts = spark.createDataFrame([("v", 0.5, 0.5, 1.0), ("v", 0.6, 0.4, 3.0), ("v", 3.5, 1.5, None)],
                                "variable string, lon double, lat double, value double")
    stats = G.bin_mean(pts, g)
    dense = G.densify(stats, G.dense_scaffold(g, pts, tile=2))
    assert dense.count() == 8
    r = {(x.iy, x.ix): (x.mean, x.n) for x in dense.collect()}
    assert r[(0, 0)] == (2.0, 2) and r[(1, 3)] == (None, 0) and r[(0, 1)] == (None, 0)
    for tile in (1, 3, 256):   # the tile sizes the work, never the result
        assert rows(G.dense_scaffold(g, pts, tile=tile)) == rows(G.dense_scaffold(g, pts))


def test_combine_methods(spark):
    s = "iy long, ix long, mean double"
    grids = [spark.createDataFrame([(0, 0, 1.0), (0, 1, None)], s), spark.createDataFrame([(0, 0, 2.0)], s),
             spark.createDataFrame([(0, 0, 10.0), (0, 1, None)], s), spark.createDataFrame([(0, 0, 4.0)], s)]
    out = {(r.iy, r.ix): r for r in G.combine_grids(grids).collect()}
    c = out[(0, 0)]
    assert (c["sum"], c["mean"], c["median"], c["min"], c["max"], c["n_grids"]) == (17.0, 4.25, 3.0, 1.0, 10.0, 4)
    assert out[(0, 1)]["mean"] is None and out[(0, 1)]["n_grids"] == 0   # all-null cell stays null


def test_pyramid_preserves_totals(spark):
    cells = _grid_cells(spark, 8, 8, holes={(3, 3)})
    base_total = cells.agg(F.sum("value")).first()[0]
    pyr = TI.overview_levels(cells, ["dataset_id", "variable"], [1, 2, 3])
    for z in (1, 2, 3):
        lvl = pyr.filter(F.col("level") == z)
        assert abs(lvl.agg(F.sum("total")).first()[0] - base_total) < 1e-9
        assert lvl.agg(F.sum("n")).first()[0] == 63
    assert pyr.filter(F.col("level") == 3).count() == 1


def test_tiles(spark):
    t = TI.cells_to_tiles(_grid_cells(spark, 5, 7), ["dataset_id", "variable"], size=4)
    got = {(r.ty, r.tx): (r.n, len(r["values"])) for r in t.collect()}
    assert got == {(0, 0): (16, 16), (0, 1): (12, 16), (1, 0): (4, 16), (1, 1): (3, 16)}


# ---------------------------------------------------------------- W5 W6 C10 L1
def test_slices_levels_routes(spark):
    files = spark.createDataFrame([("a_s0_1.nc", 0, 1), ("b_s19_2.nc", 19, 1), ("c_s10_1.nc", 10, 1),
                                   ("d_s0_1.nc", 0, 1)], "name string, level int, part int")
    lv = {r.name: r.level_role for r in SL.pick_levels(files, ["part"]).collect()}
    assert lv == {"a_s0_1.nc": "surface", "b_s19_2.nc": "bottom", "c_s10_1.nc": None, "d_s0_1.nc": "surface"}
    routed = SL.first_per_route(SL.route_files(files, SL.routes_table(spark)))
    assert {(r.suffix, r.first_file, r.n_files) for r in routed.collect()} == {("s0_1", "a_s0_1.nc", 2),
                                                                            ("s19_2", "b_s19_2.nc", 1)}
    steps = spark.createDataFrame([("v", 5), ("v", 1), ("v", 5), ("w", 3)], "variable string, day int")
    assert sorted((r.variable, r.day, r.slice) for r in SL.time_slices(steps, ["variable"], "day").collect()) == \
        [("v", 1, 1), ("v", 5, 2), ("v", 5, 2), ("w", 3, 1)]


# ---------------------------------------------------------------- U2 U3 C7 S19
def test_layer_matching_rules(spark):
    exp = spark.createDataFrame([("roads",), ("rivers",), ("lakes",), ("parks",)], "expected string")
    after = spark.createDataFrame([("roads1",), ("roads_2020",), ("rivers",), ("rivers_big",), ("lakes",)],
                                  "layer string")
    before = spark.createDataFrame([("lakes",)], "layer string")
    out = {r.expected: r for r in LY.reconcile(exp, after, before).collect()}
    assert out["roads"].layer == "roads1" and out["roads"].ambiguous        # Q14: name + digits first
    assert out["rivers"].layer == "rivers" and out["rivers"].n_matches == 2  # exact first
    assert out["lakes"].outcome == "pre-existing" and out["parks"].outcome == "missing"


def test_layer_fallback(spark):
    exp = spark.createDataFrame([("zzz",)], "expected string")
    after = spark.createDataFrame([("a",), ("b",)], "layer string")
    before = spark.createDataFrame([("b",)], "layer string")
    out = LY.reconcile(exp, after, before).collect()
    assert {(r.expected, r.outcome, r.layer) for r in out} == {("zzz", "missing", None), (None, "published", "a")}



# ---------------------------------------------------------------- W4 C11
def test_latest_status_and_gate(spark):
    st = spark.createDataFrame([(1, "accepted", D(2024, 1, 1)), (1, "Succeeded", D(2024, 1, 2)),
                                (2, "running", D(2024, 1, 1)), (3, "Failed", D(2024, 1, 3))],
                               "job_id long, status string, ts timestamp")
    latest = JO.latest_status(st)
    prods = spark.createDataFrame([(10, 1), (11, 2), (12, 3), (13, 4)], "product_id long, job_id long")
    got = {r.product_id: r.action for r in JO.gate_products(prods, latest).collect()}
    assert got == {10: "catalog", 11: "wait", 12: "drop", 13: "hold"}


def test_notification_messages_bounded_per_item(spark):
    a = spark.createDataFrame([("C1", "i1", "asset", "s3://b/x", 1), ("C1", "i1", "aux", "s3://b/y", 2),
                               ("C1", "i2", "asset", "s3://b/x", 3)],
                              "collection_id string, item_id string, asset_key string, uri string, seq int")
    rows_ = NO.notification_rows(a, F.lit("CON"), F.lit("job"), "https://h", ["seq"])
    assert rows_.filter("kind = 'ogc'").count() == 3 and rows_.filter("kind = 'uri'").count() == 1
    ok = spark.createDataFrame([("C2",)], "collection_id string")
    assert NO.notification_rows(a, F.lit("CON"), F.lit("job"), "https://h", ["seq"], ok).count() == 0  # Q11
    import json
    msgs = NO.notification_messages(rows_.withColumn("item", F.regexp_extract("uri", "items/(.*)$", 1)), ["item"])
    parsed = sorted((json.loads(m.message) for m in msgs.collect()), key=lambda d: (len(d["ogc"]), d["uris"]))
    assert parsed[-1]["ogc"] == ["https://h/stac/collections/C1/items/i1"] * 2


def test_collection_extent_with_bbox(spark):
    items = spark.createDataFrame([("C", D(2020, 1, 1), [0.0, 1.0, 2.0, 3.0]), ("C", D(2021, 1, 1), [-1.0, 2.0, 1.0, 5.0])],
                                  "collection_id string, item_ts timestamp, bbox array<double>")
    r = UP.derive_collection_extent(items, bbox="bbox").first()
    assert (r.start_ts, r.end_ts, r.west, r.south, r.east, r.north) == (D(2020, 1, 1), D(2021, 1, 1), -1.0, 1.0,
                                                                        2.0, 5.0)


def test_upsert_latest_and_insert_status(spark):
    s = "cid string, iid string, seq int, v string"
    old = spark.createDataFrame([("c", "1", 5, "o1"), ("c", "1", 7, "o1b"), ("c", "2", 1, "o2")], s)
    new = spark.createDataFrame([("c", "2", 0, "n2"), ("c", "3", 1, "n3"), ("c", "3", 2, "n3b")], s)
    got = {r.iid: r.v for r in UP.upsert_latest(old, new, ["cid", "iid"], ["seq"]).collect()}
    assert got == {"1": "o1b", "2": "n2", "3": "n3b"}   # new wins even with a smaller seq
    st = {r.iid: r.status for r in UP.insert_status(old, new, ["cid", "iid"]).collect()}
    assert st == {"2": "conflict", "3": "inserted"}


def test_exact_mean_is_order_free(spark):
    # 32 values whose true mean ends in ...0625: a float avg may round either way
    vals = [(i, 57.0 + (0.01 if i < 13 else 0.0)) for i in range(32)]
    df = spark.createDataFrame(vals, "i int, value double").withColumn("u", G.to_units("value"))
    a = df.agg(G.exact_mean(F.sum("u"), F.count("u")).alias("m")).first().m
    b = df.orderBy(F.desc("i")).agg(G.exact_mean(F.sum("u"), F.count("u")).alias("m")).first().m
    assert a == b == 57.004063   # 57.0040625 rounded half-up


# ---------------------------------------------------------------- rules that hold off the fixture
def test_chunk_assembly_is_linear_and_settles_repeats(spark):
    import time
    n = 256
    cells = spark.range(n * n).where("id % 7 <> 3").select(
        F.lit("d").alias("dataset_id"), F.lit("v").alias("variable"), (F.col("id") / n).cast("int").alias("y"),
        (F.col("id") % n).cast("int").alias("x"), F.col("id").cast("double").alias("value"))
    repeated = cells.unionByName(cells.where("x % 5 = 0")
                                 .withColumn("value", F.col("value") - 0.5))
    t0 = time.time()
    chunks = CE.cells_to_chunks(repeated, ["dataset_id", "variable"]).collect()
    assert time.time() - t0 < 20 and len(chunks) == 1
    got = chunks[0]["values"]
    assert got == [None if i % 7 == 3 else float(i) for i in range(n * n)]


def test_concat_overlap_and_unlisted_store_fail(spark):
    s = "store string, variable string, time int, y int, x int, value double"
    a = spark.createDataFrame([("A", "v", 10, 0, 0, 1.0)], s)
    b = spark.createDataFrame([("B", "v", 10, 0, 0, 9.0)], s)
    manifest = spark.createDataFrame([(0, "A"), (1, "B")], "seq int, store string")
    with pytest.raises(Exception, match="stores overlap"):
        CE.concat_stores([a, b], manifest, on_overlap="error").collect()
    with pytest.raises(Exception, match="store not in the manifest"):
        CE.concat_stores([a, b], manifest.where("seq = 0")).collect()


def test_upsert_collections_sums_intervals_and_keeps_metadata(spark):
    s = "collection_id string, start_ts timestamp, end_ts timestamp, title string"
    new = spark.createDataFrame([("A", D(2018, 1, 1), D(2019, 1, 1), "new"), ("A", D(2020, 1, 1), D(2021, 1, 1), "new"),
                                 ("N", None, None, "fresh")], s)
    remote = spark.createDataFrame([("A", D(2015, 1, 1), D(2016, 1, 1), "old")], s)
    counts = spark.createDataFrame([("A", 2)], "collection_id string, n_new_items long")
    out = rows(UP.upsert_collections(new, remote, counts, metadata=["title"]), order=lambda r: r["collection_id"])
    assert [(r["collection_id"], r["action"], r["extent_start"], r["extent_end"], r["title"]) for r in out] == [
        ("A", "update", D(2015, 1, 1), D(2021, 1, 1), "old"), ("N", "create", None, None, "fresh")]


def test_collection_intervals_from_documents(spark):
    docs = spark.createDataFrame([("A", [["2020-01-01T00:00:00Z", None], ["2018-01-01T00:00:00Z", "2019-01-01T00:00:00Z"]]),
                                  ("B", None)], "collection_id string, i array<array<string>>")
    out = rows(UP.collection_intervals(docs, intervals="i"))
    assert sorted((r["collection_id"], str(r["start_ts"]), str(r["end_ts"])) for r in out) == [
        ("A", "2018-01-01 00:00:00", "2019-01-01 00:00:00"), ("A", "2020-01-01 00:00:00", "None"), ("B", "None", "None")]


def test_routes_of_any_shape(spark):
    files = spark.createDataFrame([("x_mid_1.nc",), ("as0_1.nc",), ("y_s0_1.nc",), ("other.nc",), ("s0_1.txt",), (None,)],
                                  "name string")
    routes = spark.createDataFrame([("mid_1", "m"), ("s0_1", "surface"), ("y_s0_1", "longer")],
                                   "suffix string, collection_suffix string")
    got = {r["name"]: r["collection_suffix"] for r in SL.route_files(files, routes).collect()}
    assert got == {"x_mid_1.nc": "m", "as0_1.nc": "surface", "y_s0_1.nc": "longer", "other.nc": None, "s0_1.txt": None,
                   None: None}


def test_grid_size_rule_is_one(spark):
    from gridcat.functions.requests import grid_spec, parse_extent
    spec = spark.range(1).select(grid_spec(parse_extent(F.lit("-0.2 -0.2 0.1 0.1")), F.lit(0.1)).alias("g")).first().g
    grid = G.Grid(-0.2, -0.2, 0.1, 0.1, 0.1)
    assert (spec.nx, spec.ny) == (grid.nx, grid.ny) == (3, 3)


def test_notification_pages_split_a_hot_item(spark):
    assets = spark.range(3000).select(
        F.lit("c").alias("collection_id"), F.lit("hot").alias("item_id"), F.concat(F.lit("a"), "id").alias("asset_key"),
        F.concat(F.lit("s3://b/"), "id").alias("uri"), F.col("id").alias("seq"))
    notice = NO.notification_rows(assets, F.lit("C"), F.lit("J"), "https://h", ["seq"], keep=["collection_id", "item_id"])
    pages = NO.notification_messages(notice, ["collection_id", "item_id"], page_size=100)
    sizes = [r.n for r in pages.select(F.size(F.from_json("message", "ogc array<string>")["ogc"]).alias("n")).collect()]
    assert sum(sizes) == 3000 and max(sizes) < 200
    assert NO.endpoint_uris(assets, "https://h", distinct=True).count() == 1


def test_item_pages_grow_in_number_with_the_collection(spark):
    from gridcat.plans.q_catalog import ITEM_PAGE, _item_pages
    items = spark.range(8 * ITEM_PAGE).select(
        F.when(F.col("id") < 10, "small").otherwise("hot").alias("id"), F.col("id").alias("c_custkey"),
        F.struct(F.col("id").cast("string").alias("id")).alias("feature"))
    pages = _item_pages(items).select("id", F.size("features").alias("n"), "features").collect()
    assert max(r.n for r in pages) < 1.5 * ITEM_PAGE and sum(r.id == "small" for r in pages) == 1
    assert sorted(int(f.id) for r in pages for f in r.features) == list(range(8 * ITEM_PAGE))
