"""Listings, copies, manifests, catalog JSON scans and the streaming operators."""

import datetime as dt
import json
import os

import pytest

from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridcat.operators.upsert import dedupe_last_wins, latest_version
from gridcat.sources import catalog as CA
from gridcat.sources import copy as CP
from gridcat.sources import listing as L
from gridcat.streaming import streams as ST

D = dt.datetime


def _make_tree(root):
    for rel in ["job1/a.zarr/.zmetadata", "job1/a.zarr/T/0.0", "job1/b.nc4", "job2/c.nc4", "job2/d.txt"]:
        p = os.path.join(root, rel)
        os.makedirs(os.path.dirname(p), exist_ok=True)
        with open(p, "w") as fh:
            fh.write(rel)


# ---------------------------------------------------------------- S1 S2 S3 S5 X29
def test_list_objects_and_discovery(spark, tmp_path):
    root = str(tmp_path / "bucket")
    _make_tree(root)
    files = L.list_objects(spark, root)
    assert files.count() == 5 and files.filter(F.col("size") > 0).count() == 5
    nc = L.list_objects(spark, root, glob="*.nc*")
    assert sorted(os.path.basename(r.key) for r in nc.collect()) == ["b.nc4", "c.nc4"]
    listing = spark.createDataFrame([("bk", "out/job1/a.zarr/.zmetadata"), ("bk", "out/job1/a.zarr/T/0.0"),
                                     ("bk", "out/job1/b.nc4"), ("bk", "out/job10/x.nc4"), ("bk", "out/job2/c.nc4")],
                                    "bucket string, key string")
    jobs = spark.createDataFrame([("j1", "s3://bk/out/job1"), ("j2", "s3://bk/out/job2/"), ("j3", None)],
                                 "job_id string, result string")
    jp = L.job_prefixes(jobs)
    assert sorted(r.uri for r in L.outputs_by_suffix(listing, jp, ".nc4").collect()) == \
        ["s3://bk/out/job1/b.nc4", "s3://bk/out/job2/c.nc4"]      # job10 is not below job1/
    assert [r.uri for r in L.store_roots(listing, jp).collect()] == ["s3://bk/out/job1/a.zarr"]
    ex = L.existence(spark.createDataFrame([("bk", "out/job1/b.nc4"), ("bk", "nope")], "bucket string, key string"),
                     listing)
    assert sorted((r.key, r.exists) for r in ex.collect()) == [("nope", False), ("out/job1/b.nc4", True)]


def test_glob_and_helpers(spark):
    assert L.glob_to_regex("*.nc*") == r"^[^/]*\.nc[^/]*$"
    df = spark.createDataFrame([(["x", "s3://a", "s3://b"],), (["x"],)], "r array<string>")
    st = spark.createDataFrame([("/pre/", "/COL/", "f.nc"), ("", "C", "g.nc")], "p string, c string, n string")
    assert [r.k for r in st.select(L.staged_key("p", "c", "n").alias("k")).collect()] == ["pre/COL/f.nc", "C/g.nc"]


def test_ftp_and_granules_and_bundles(spark):
    lines = spark.createDataFrame([(1, "-rw-r--r--   1 ftp  ftp  10 Jan  1  2025 big area file.nc"),
                                   (2, "-rw-r--r--   1 ftp  ftp  10 Jan  1  2025 area_nodot"),
                                   (3, "short")], "k int, line string")
    assert [r.name for r in L.ftp_matches(lines, ["area", "."]).collect()] == ["big area file.nc"]
    g = spark.createDataFrame([("C", "n", "UR2", 2), ("C", "n", "UR1", 1)], "cid string, name string, ur string, seq int")
    req = spark.createDataFrame([("C", "n"), ("C", "zz")], "cid string, name string")
    got = {r.name: (r.ur, r.ambiguous, r.n_found) for r in L.granule_lookup(req, g, ["cid", "name"]).collect()}
    assert got == {"n": ("UR1", True, 2), "zz": (None, None, None)}
    b = spark.createDataFrame([("s", ".SHP"), ("s", ".dbf"), ("t", ".shp"), ("t", ".shx"), ("t", ".dbf")],
                              "stem string, ext string")
    assert {r.stem: r.missing for r in L.bundle_check(b).collect()} == {"s": [".shx"], "t": []}


# ---------------------------------------------------------------- S12 S16 S17
def test_manifest_roundtrip(spark, tmp_path):
    stores = spark.createDataFrame([(1, "s3://b/x.zarr"), (0, "s3://b/w.zarr")], "seq int, uri string")
    path = str(tmp_path / "manifest")
    L.write_manifest(stores, path)
    assert sorted(tuple(r) for r in L.read_manifest(spark, path).collect()) == [(0, "s3://b/w.zarr"),
                                                                               (1, "s3://b/x.zarr")]
    legacy = tmp_path / "legacy.json"
    legacy.write_text(json.dumps(["s3://b/a.zarr", "s3://b/b.zarr"]))
    assert [tuple(r) for r in L.read_manifest(spark, str(legacy)).orderBy("seq").collect()] == \
        [(0, "s3://b/a.zarr"), (1, "s3://b/b.zarr")]


def test_copy_objects(spark, tmp_path):
    root = str(tmp_path / "src")
    _make_tree(root)
    files = L.list_objects(spark, root).withColumn("bucket", F.lit("local"))
    prefix = files.first().key.split("job1/")[0] if "job1/" in files.first().key else None
    prefix = [r.key for r in files.collect() if "job1/" in r.key][0].split("job1/")[0]
    plan = CP.plan_download(files.filter(F.col("key").contains("job1/")), prefix + "job1", str(tmp_path / "dst"),
                            scheme="file")
    plan = plan.withColumn("src", F.regexp_replace("src", "^file://local/", "/"))
    res = CP.copy_objects(plan.unionByName(spark.createDataFrame([("/no/such/file", str(tmp_path / "x"))],
                                                                 "src string, dst string")))
    out = {os.path.relpath(r.dst, str(tmp_path / "dst")) if r.ok else "FAILED": r for r in res.collect()}
    assert set(out) == {"a.zarr/.zmetadata", "a.zarr/T/0.0", "b.nc4", "FAILED"}
    assert (tmp_path / "dst" / "a.zarr" / "T" / "0.0").read_text() == "job1/a.zarr/T/0.0"
    assert out["FAILED"].error


def test_prefix_copy_plan(spark):
    files = spark.createDataFrame([("b", "in/x/1.nc"), ("b", "in/y/"), ("b", "other/in/2.nc")],
                                  "bucket string, key string")
    plan = CP.plan_prefix_copy(files, "b", "in/", "d", "out/")
    assert [(r.src, r.dst) for r in plan.collect()] == [("s3://b/in/x/1.nc", "s3://d/out/x/1.nc")]


# ---------------------------------------------------------------- S13 S14 C1 C2 A2
def test_catalog_json_walk(spark, tmp_path):
    d = tmp_path / "cat"
    d.mkdir()
    (d / "catalog.json").write_text(json.dumps({"type": "Catalog", "id": "root", "links": [
        {"rel": "child", "href": "./c1/collection.json"}]}))
    (d / "c1").mkdir()
    (d / "c1" / "collection.json").write_text(json.dumps({"type": "Collection", "id": "c1", "links": [
        {"rel": "item", "href": "./i1.json"}, {"rel": "items", "href": "./items.json"}]}))
    (d / "c1" / "items.json").write_text(json.dumps({"type": "FeatureCollection", "features": [
        {"id": "i1", "assets": {"data": {"href": "https://bk.s3.amazonaws.com/k.tif"}}},
        {"id": "i2", "assets": {"data": {"href": "./local.tif"}}}]}))
    cols = CA.read_stac(spark, str(d), "collection", glob="collection.json")
    r = CA.normalize_catalog(cols).select(CA.link_by_rel("links", "items").alias("h")).first()
    assert r.h.endswith("/cat/c1/items.json")
    pages = CA.read_stac(spark, str(d / "c1"), "item_page", glob="items.json")
    feats = CA.item_features(pages, max_items=1).select("feature.id").collect()
    assert [f.id for f in feats] == ["i1"]
    links = spark.createDataFrame([("root", "c1", "child"), ("c1", "i1", "item"), ("c1", "i2", "item"),
                                   ("root", "sub", "child"), ("sub", "c2", "child"), ("c2", "i3", "item")],
                                  "parent_id string, child_id string, rel string")
    walked = CA.walk_catalog(links, spark.createDataFrame([("root",)], "root_id string"))
    assert sorted(r.item_id for r in walked.collect() if r.item_id) == ["i1", "i2", "i3"]
    assets = spark.createDataFrame([("i1", True), ("i1", True), ("i2", False), ("i3", True)], "item_id string, converted boolean")
    counts = CA.catalog_counts(walked, assets)
    total = counts.filter(F.col("root_id").isNull()).first()
    assert (total.n_collections, total.n_items, total.assets_converted) == (4, 3, 3)   # root and sub hold no items


def test_walk_has_no_depth_bound_and_survives_cycles(spark):
    links = spark.createDataFrame([(f"n{i}", f"n{i + 1}", "child") for i in range(30)] + [("n30", "n0", "child"),
                                                                                      ("n30", "deep", "item")],
                                  "parent_id string, child_id string, rel string")
    walked = CA.walk_catalog(links, spark.createDataFrame([("n0",)], "root_id string"))
    assert walked.count() == 31 and [r.item_id for r in walked.where("item_id is not null").collect()] == ["deep"]


def test_walk_takes_logarithmic_rounds(spark, monkeypatch):
    """A chain of 24 levels, a diamond, a nested root, a loop and a self loop; five rounds after the first table."""
    kids = [("r", "c0")] + [(f"c{i}", f"c{i + 1}") for i in range(23)] + [
        ("r", "c5"), ("c9", "x"), ("c10", "x"), ("x", "y"), ("q", "q"), ("lost", "c3"), ("u", "v"), ("v", "u")]
    links = spark.createDataFrame([(a, b, "child") for a, b in kids], "parent_id string, child_id string, rel string")
    base = {}
    real = CA.scratch_dir

    def kept(s, name):
        base["path"] = real(s, name)
        return base["path"]
    monkeypatch.setattr(CA, "scratch_dir", kept)
    roots = spark.createDataFrame([("r",), ("c20",), ("q",), ("v",), ("none",), (None,)], "root_id string")
    got = {(r.root_id, r.node_id) for r in CA.walk_nodes(links, roots).collect()}
    chain = [f"c{i}" for i in range(24)]
    want = {("r", n) for n in ["r", *chain, "x", "y"]} | {("c20", n) for n in chain[20:]} | {
        ("q", "q"), ("v", "v"), ("v", "u"), ("none", "none")}
    assert got == want
    rounds = [d for d in os.listdir(base["path"].removeprefix("file:")) if d.startswith("round=")]
    assert len(rounds) <= 1 + 6


def test_counts_use_no_expand(spark):
    walked = spark.createDataFrame([("r", "a", "i1"), ("r", "a", "i2"), ("r", "b", None), ("s", "a", "i1"), ("s", None, None)],
                                   "root_id string, collection_id string, item_id string")
    assets = spark.createDataFrame([("i1", True), ("i1", True), ("i2", False)], "item_id string, converted boolean")
    counts = CA.catalog_counts(walked, assets)
    assert "Expand" not in counts._jdf.queryExecution().executedPlan().toString()
    got = {(r.root_id, r.collection_id): (r.n_collections, r.n_items, r.assets_converted) for r in counts.collect()
           if r.root_id != "s" or r.collection_id}
    assert got == {("r", "a"): (1, 2, 2), ("r", "b"): (1, 0, 0), ("s", "a"): (1, 1, 2), ("r", None): (2, 2, 2), (None, None): (2, 3, 4)}
    assert CA.catalog_counts(walked.limit(0), assets).count() == 0


# ---------------------------------------------------------------- T1 T2 T3 T5
SCHEMA = T.StructType([T.StructField("job_id", T.LongType()), T.StructField("status", T.StringType()),
                       T.StructField("ts", T.TimestampType())])


def stage_files(df, path, n_files, order=None):
    """``n_files`` files of consecutive slices by ``order``, written one after
    another, so a file stream takes them as files that arrive over time."""
    rows_ = sorted(df.collect(), key=lambda r: r[order]) if order else df.collect()
    size = -(-len(rows_) // n_files)
    for i in range(n_files):
        part = df.sparkSession.createDataFrame(rows_[i * size:(i + 1) * size], df.schema)
        part.coalesce(1).write.mode("append").parquet(path)


def test_job_gate_late_and_repeated_statuses(spark, tmp_path):
    """Several batches; a repeat of the first status and an out-of-order one change nothing, and a
    row behind the watermark does not reopen a decided gate."""
    h, t0 = dt.timedelta(hours=1), D(2024, 1, 1)
    batches = [[(1, "accepted", t0 + h), (2, "accepted", t0)],
               [(1, "accepted", t0), (1, "accepted", t0 + h), (1, "Succeeded", t0 + 3 * h)],
               [(1, "Failed", t0 + 2 * h), (9, "running", t0 + 100 * h)],
               [(2, "Succeeded", t0 + h), (9, "running", t0 + 101 * h)]]
    for part in batches:
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    out = str(tmp_path / "out")
    stream = ST.read_files(spark, str(tmp_path / "in"), SCHEMA, max_files=1)
    ST.run_available(ST.job_gate(stream).writeStream.format("parquet").option("path", out).outputMode("append"),
                     str(tmp_path / "ck"))
    got = sorted((r.job_id, r.outcome, r.ts) for r in spark.read.parquet(out).collect())
    assert got == [(1, "succeeded", t0 + 3 * h), (2, "timeout", t0 + 48 * h)]


def test_job_gate_stream(spark, tmp_path):
    h = dt.timedelta(hours=1)
    t0 = D(2024, 1, 1)
    data = [(1, "accepted", t0), (1, "running", t0 + h), (1, "running", t0 + h + dt.timedelta(minutes=5)),
            (1, "Succeeded", t0 + 2 * h),
            (2, "accepted", t0), (2, "Failed", t0 + 3 * h),
            (3, "accepted", t0),                                   # silent job
            (4, "accepted", t0), (4, "Succeeded", t0 + 60 * h),     # success after the deadline
            (9, "running", t0 + 100 * h)]                          # late-dated row moves the watermark
    df = spark.createDataFrame(data, SCHEMA)
    stage_files(df, str(tmp_path / "in"), 3, "ts")
    stream = ST.read_files(spark, str(tmp_path / "in"), SCHEMA, max_files=1)
    out = str(tmp_path / "out")
    ST.run_available(ST.job_gate(stream, max_wait_hours=48).writeStream.format("parquet")
                     .option("path", out).outputMode("append"), str(tmp_path / "ck"))
    got = {r.job_id: (r.outcome, r.ts) for r in spark.read.parquet(out).collect()}
    assert got[1] == ("succeeded", t0 + 2 * h)
    assert got[2] == ("failed", t0 + 3 * h)
    assert got[3] == ("timeout", t0 + 48 * h)
    assert got[4] == ("timeout", t0 + 48 * h)
    assert 9 not in got


def test_streams_run_in_a_session_with_the_default_state_store(spark, tmp_path):
    """The gate and what reads it run whatever state store the session is set to, and leave it so."""
    from gridcat.plans import q_stream
    key = "spark.sql.streaming.stateStore.providerClass"
    hdfs = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    h, t0 = dt.timedelta(hours=1), D(2024, 1, 1)
    rows_ = [(1, t0, 1, "view"), (2, t0 + 2 * h, 1, "purchase"), (3, t0, 2, "click"), (4, t0 + 3 * h, 2, "error"),
             (5, t0 + 200 * h, 3, "signup")]
    spark.createDataFrame([(i, t, u, e, 0.0, None) for i, t, u, e in rows_], q_stream.EVENTS_SCHEMA) \
        .write.parquet(str(tmp_path / "events.parquet"))
    before = spark.conf.get(key)
    spark.conf.set(key, hdfs)
    try:
        gate = {(r.job_id, r.outcome, r.ts) for r in q_stream.stream_job_gate(spark, str(tmp_path)).collect()}
        released = [(r.product_id, r.g_ts) for r in q_stream.stream_product_gate(spark, str(tmp_path)).collect()]
        outcomes = [(r.product_id, r.outcome) for r in q_stream.stream_product_outcomes(spark, str(tmp_path)).collect()]
        assert spark.conf.get(key) == hdfs
    finally:
        spark.conf.set(key, before)
    assert gate == {(1, "succeeded", t0 + 2 * h), (2, "failed", t0 + 3 * h)}
    assert released == [(1, t0 + 2 * h)] and outcomes == [(1, "released")]


def test_streams_run_in_a_second_session_and_in_threads(spark, tmp_path):
    """The gate and what reads it run in a session that is not the active one, and several at
    once, whatever state store the sessions are set to."""
    from concurrent.futures import ThreadPoolExecutor
    from gridcat.plans import q_stream
    key = "spark.sql.streaming.stateStore.providerClass"
    hdfs = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    h, t0 = dt.timedelta(hours=1), D(2024, 1, 1)
    rows_ = [(1, t0, 1, "view"), (2, t0 + 2 * h, 1, "purchase"), (3, t0, 2, "click"), (4, t0 + 3 * h, 2, "error"),
             (5, t0 + 200 * h, 3, "signup")]
    spark.createDataFrame([(i, t, u, e, 0.0, None) for i, t, u, e in rows_], q_stream.EVENTS_SCHEMA) \
        .write.parquet(str(tmp_path / "events.parquet"))

    def run(build):
        return sorted(tuple(r) for r in build(other, str(tmp_path)).collect())

    before = spark.conf.get(key)
    other = spark.newSession()
    try:
        for session in (spark, other):
            session.conf.set(key, hdfs)
        with ThreadPoolExecutor(4) as pool:
            gate, released, outcomes, _ = pool.map(run, [
                q_stream.stream_job_gate, q_stream.stream_product_gate, q_stream.stream_product_outcomes,
                q_stream.stream_status_dedupe])
        assert other.conf.get(key) == hdfs and spark.conf.get(key) == hdfs
    finally:
        spark.conf.set(key, before)
    assert gate == [(1, "succeeded", t0 + 2 * h), (2, "failed", t0 + 3 * h)]
    assert released == [(1, 1, t0, t0 + 2 * h)]
    assert outcomes == [(1, 1, t0, t0 + 2 * h, "released")]


def test_state_stores_take_no_disk_in_advance(spark):
    """A stream has a store for every partition, four for a join's; preallocated logs of empty ones
    filled the disk."""
    key = "spark.sql.streaming.stateStore.rocksdb.allowFAllocate"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        with ST.rocksdb_state(spark):
            assert spark.conf.get(key) == "false"
        assert spark.conf.get(key) == "true"
    finally:
        spark.conf.set(key, before)


def test_job_gate_state_falls_and_restarts(spark, tmp_path):
    """State holds the jobs whose deadline is ahead of the watermark; a restart goes on from the checkpoint."""
    h, t0 = dt.timedelta(hours=1), D(2024, 1, 1)
    src, out, ck = (str(tmp_path / n) for n in ("in", "out", "ck"))
    rows_now = []

    def arrive(rows_):
        spark.createDataFrame(rows_, SCHEMA).coalesce(1).write.mode("append").parquet(src)
        q = (ST.job_gate(ST.read_files(spark, src, SCHEMA, max_files=1)).writeStream.format("parquet").option("path", out)
             .outputMode("append").option("checkpointLocation", ck).trigger(availableNow=True).start())
        q.awaitTermination()
        assert q.exception() is None
        rows_now.append(q.lastProgress["stateOperators"][0]["numRowsTotal"])
    arrive([(i, "accepted", t0 + i * h / 60) for i in range(40)] + [(1, "Succeeded", t0 + h)])
    arrive([(2, "Failed", t0 + 3 * h), (2, "Succeeded", t0 + 4 * h), (50, "running", t0 + 40 * h)])
    arrive([(50, "Succeeded", t0 + 41 * h), (51, "running", t0 + 60 * h)])
    arrive([(51, "running", t0 + 61 * h)])
    got = {r.job_id: (r.outcome, r.ts) for r in spark.read.parquet(out).collect()}
    assert got == {1: ("succeeded", t0 + h), 2: ("failed", t0 + 3 * h), 50: ("succeeded", t0 + 41 * h)} | {
        i: ("timeout", t0 + i * h / 60 + 48 * h) for i in range(40) if i not in (1, 2)}
    assert spark.read.parquet(out).count() == len(got)
    assert rows_now[0] >= 40 and rows_now[-1] <= 8      # a value and a timer of jobs 50 and 51 are left


def test_product_outcomes_over_batches(spark, tmp_path):
    """Several batches with repeats, a late row and products that no success reaches."""
    h, t0 = dt.timedelta(hours=1), D(2024, 1, 1)
    ps = T.StructType([T.StructField("product_id", T.LongType()), T.StructField("p_job_id", T.LongType()), T.StructField("p_ts", T.TimestampType())])
    gs = T.StructType([T.StructField("g_job_id", T.LongType()), T.StructField("g_ts", T.TimestampType())])
    products = [[(1, 1, t0), (2, 2, t0), (1, 1, t0)], [(3, 1, t0 + h), (2, 2, t0), (4, 4, t0 + 2 * h)], [(5, 9, t0 + 100 * h)],
                [(6, 1, t0), (7, 9, t0 + 101 * h)], [(8, 9, t0 + 200 * h)]]
    gates = [[(1, t0 + 5 * h)], [(4, t0 + 90 * h), (9, t0 + 99 * h)], [(9, t0 + 103 * h)], [(2, t0 + 49 * h), (9, t0 + 104 * h)],
             [(77, t0 + 200 * h)]]
    for part in products:
        spark.createDataFrame(part, ps).coalesce(1).write.mode("append").parquet(str(tmp_path / "p"))
    for part in gates:
        spark.createDataFrame(part, gs).coalesce(1).write.mode("append").parquet(str(tmp_path / "g"))
    out = str(tmp_path / "out")

    def run():
        p, g = (ST.read_files(spark, str(tmp_path / n), schema, max_files=1) for n, schema in (("p", ps), ("g", gs)))
        ST.run_available(ST.product_outcomes(p, g).writeStream.format("parquet").option("path", out).outputMode("append"),
                         str(tmp_path / "ck"))
    run()
    run()       # a restart adds nothing
    got = sorted((r.product_id, r.outcome, r.g_ts) for r in spark.read.parquet(out).collect())
    # 2: its success came too late; 6 arrived behind the watermark and is dropped; 8 is still open
    assert got == sorted([(1, "released", t0 + 5 * h), (2, "expired", None), (3, "released", t0 + 5 * h), (4, "expired", None),
                          (5, "released", t0 + 103 * h), (5, "released", t0 + 104 * h), (7, "released", t0 + 103 * h),
                          (7, "released", t0 + 104 * h)], key=str) or got == sorted(
        [(1, "released", t0 + 5 * h), (2, "expired", None), (3, "released", t0 + 5 * h), (4, "expired", None),
         (5, "released", t0 + 103 * h), (5, "released", t0 + 104 * h), (7, "released", t0 + 103 * h), (7, "released", t0 + 104 * h)])


def test_dedupe_drops_late_rows_over_batches(spark, tmp_path):
    t0, minute = D(2024, 1, 1), dt.timedelta(minutes=1)
    batches = [[(1, "running", t0), (1, "running", t0 + minute)], [(1, "running", t0 + 30 * minute), (2, "running", t0 + 300 * minute)],
               [(2, "running", t0 + 301 * minute)], [(3, "running", t0 + 100 * minute)],
               [(1, "running", t0 + 301 * minute), (2, "running", t0 + 302 * minute)]]
    for part in batches:
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    out = str(tmp_path / "out")
    ST.run_available(ST.dedupe_statuses(ST.read_files(spark, str(tmp_path / "in"), SCHEMA, max_files=1)).writeStream.format("parquet")
                     .option("path", out).outputMode("append"), str(tmp_path / "ck"))
    got = sorted((r.job_id, r.ts) for r in spark.read.parquet(out).collect())
    # job 3 is behind the watermark (t0 + 240 min); job 1 comes again after its key has left the state
    assert got == [(1, t0), (1, t0 + 301 * minute), (2, t0 + 300 * minute)]


def test_notification_sink(spark, tmp_path):
    """A failing send fails no batch and is tried again; a replayed batch sends nothing twice."""
    schema = T.StructType([T.StructField("message_id", T.StringType()), T.StructField("payload", T.StringType())])
    log, down, root = tmp_path / "log", tmp_path / "down", str(tmp_path / "out")
    log.mkdir()
    down.touch()

    def send(message_id, payload, log=str(log), down=str(down)):
        if payload == "never" or payload == "later" and os.path.exists(down):
            raise ConnectionError("no answer")
        with open(os.path.join(log, message_id), "a") as f:
            f.write(payload)
    fn = ST.notification_batches(root, send, max_attempts=3)
    first = spark.createDataFrame([("a", "now"), ("b", "later"), ("c", "never"), ("a", "now")], schema)
    fn(first, 0)
    fn(first, 0)        # a replay
    assert (log / "a").read_text() == "now"
    down.unlink()
    fn(spark.createDataFrame([("d", "now")], schema), 1)
    assert (log / "b").read_text() == "later"
    for batch in (2, 3, 4):
        fn(spark.createDataFrame([], schema), batch)
    got = {r.message_id: (r.sent, r.attempt, r.error) for r in ST.notification_results(spark, root).collect()}
    assert got == {"a": (True, 1, None), "b": (True, 2, None), "c": (False, 3, "ConnectionError: no answer"), "d": (True, 1, None)}


def test_file_stream_each_file_once(spark, tmp_path):
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.LongType())])
    src = str(tmp_path / "in")
    stage_files(spark.createDataFrame([("a", i) for i in range(10)] + [("b", 1)], schema), src, 3, "v")
    counts = str(tmp_path / "counts")

    def sink(df, _):
        df.write.mode("overwrite").parquet(counts)
    ck = str(tmp_path / "ck")
    q = ST.file_counts(ST.read_files(spark, src, schema, max_files=1), "k")
    ST.run_available(q.writeStream.outputMode("complete").foreachBatch(sink), ck)
    ST.run_available(ST.file_counts(ST.read_files(spark, src, schema, max_files=1), "k")
                     .writeStream.outputMode("complete").foreachBatch(sink), ck)  # restart: nothing new
    assert {r.k: r.n for r in spark.read.parquet(counts).collect()} == {"a": 10, "b": 1}


def test_file_rows_name_their_file_once(spark, tmp_path):
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.LongType())])
    src, out, ck = (str(tmp_path / n) for n in ("in", "out", "ck"))
    want = set()

    def arrive(lo, hi):
        before = set(os.listdir(src)) if os.path.exists(src) else set()
        spark.createDataFrame([("a", i) for i in range(lo, hi)], schema).coalesce(1).write.mode("append").parquet(src)
        (new,) = [f for f in set(os.listdir(src)) - before if f.endswith(".parquet")]
        want.update((i, new) for i in range(lo, hi))

    def run():
        rows_ = ST.with_file(ST.read_files(spark, src, schema, max_files=1))
        ST.run_available(rows_.writeStream.format("parquet").option("path", out).outputMode("append"), ck)
    arrive(0, 4)
    arrive(4, 6)
    run()
    run()
    arrive(6, 7)
    run()
    got = [(r.v, r.file) for r in spark.read.parquet(out).collect()]
    assert len(got) == 7 and set(got) == want


def _upsert_schema():
    return T.StructType([T.StructField("cid", T.StringType()), T.StructField("id", T.StringType()),
                         T.StructField("seq", T.IntegerType()), T.StructField("v", T.StringType())])


def _upsert_stream(spark, src, root, ck, schema, **kw):
    fn = ST.upsert_batch_partitioned(root, ["cid", "id"], ["seq"], ["cid"], schema, **kw)
    ST.run_available(ST.read_files(spark, src, schema, max_files=1).writeStream.foreachBatch(fn), ck)


def test_upsert_stream_with_a_second_checkpoint_loses_nothing(spark, tmp_path):
    schema, root = _upsert_schema(), str(tmp_path / "tbl")
    spark.createDataFrame([("A", "x", 0, "old")], schema).write.partitionBy("cid").parquet(f"{root}/live")
    for run, rows_ in enumerate(([("A", "x", 5, "first"), ("A", "y", 1, "first")], [("A", "x", 9, "second"), ("A", "q", 1, "second")])):
        src = str(tmp_path / f"in{run}")
        spark.createDataFrame(rows_, schema).write.parquet(src)
        _upsert_stream(spark, src, root, str(tmp_path / f"ck{run}"), schema)
    got = {r.id: (r.seq, r.v) for r in spark.read.schema(schema).parquet(f"{root}/live").collect()}
    assert got == {"x": (9, "second"), "y": (1, "first"), "q": (1, "second")}
    assert not [f for _, _, fs in os.walk(f"{root}/_staging") for f in fs]      # stages are dropped


def test_upsert_stream_replays_after_a_crash_before_the_swap(spark, tmp_path):
    schema, root, src, ck = _upsert_schema(), str(tmp_path / "tbl"), str(tmp_path / "in"), str(tmp_path / "ck")
    spark.createDataFrame([("A", "x", 0, "old"), ("B", "y", 0, "old")], schema).write.partitionBy("cid").parquet(f"{root}/live")
    spark.createDataFrame([("A", "x", 5, "new"), ("A", "z", 1, "new")], schema).write.parquet(src)
    with pytest.raises(Exception):
        _upsert_stream(spark, src, root, ck, schema, fail_after_stage=lambda batch: True)
    _upsert_stream(spark, src, root, ck, schema)
    got = {(r.cid, r.id): r.v for r in spark.read.schema(schema).parquet(f"{root}/live").collect()}
    assert got == {("A", "x"): "new", ("A", "z"): "new", ("B", "y"): "old"}


def test_upsert_batch_shuffles_its_rows_once(spark, tmp_path, monkeypatch):
    """merged rows go through one shuffle, laid out as the table's partitions, large ones in slices."""
    monkeypatch.setattr(ST, "SLICE_ROWS", 3)
    schema = _upsert_schema()
    rows_ = spark.createDataFrame([("A", f"x{i % 10}", i, f"v{i}") for i in range(20)] + [("B", "y", 1, "b"), (None, "z", 1, "n")], schema)
    ST.partition_slices(rows_, ["cid"]).write.parquet(str(tmp_path / "slices"))
    slices = spark.read.parquet(str(tmp_path / "slices"))
    assert {(r.cid, r["_slices"]) for r in slices.collect()} == {("A", 7), ("B", 1), (None, 1)}
    got = ST.dedupe_by_partition(rows_, slices, ["cid", "id"], ["seq"], ["cid"])
    assert sorted(tuple(r) for r in got.collect() if r.cid) == sorted(
        [("A", f"x{i % 10}", i, f"v{i}") for i in range(10, 20)] + [("B", "y", 1, "b")])
    assert got.filter("cid is null").count() == 1
    plan = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Exchange hashpartitioning") == 1 and "Exchange RoundRobin" not in plan
    writes, root = [], str(tmp_path / "tbl")
    original = ST._swap
    monkeypatch.setattr(ST, "_swap", lambda *a: (writes.append(sorted(os.listdir(a[1]))), original(*a)))
    ST.upsert_batch_partitioned(root, ["cid", "id"], ["seq"], ["cid"], schema)(rows_, 0)
    assert {n for n in writes[0] if n.startswith("cid=")} == {"cid=A", "cid=B", "cid=__HIVE_DEFAULT_PARTITION__"}
    assert spark.read.schema(schema).parquet(f"{root}/live").count() == 12


def test_upsert_keeps_rows_of_a_null_partition(spark, tmp_path):
    """Rows whose partition has no name outlast batches that bring more of them, and those that do not."""
    schema, root = _upsert_schema(), str(tmp_path / "tbl")
    fn = ST.upsert_batch_partitioned(root, ["cid", "id"], ["seq"], ["cid"], schema)
    for n, rows_ in enumerate(([(None, "x", 0, "old"), (None, "y", 0, "old"), ("A", "a", 0, "old")],
                               [(None, "x", 1, "new"), (None, "z", 1, "new")], [("A", "a", 2, "new")])):
        fn(spark.createDataFrame(rows_, schema), n)
    got = {(r.cid, r.id): r.v for r in spark.read.schema(schema).parquet(f"{root}/live").collect()}
    assert got == {(None, "x"): "new", (None, "y"): "old", (None, "z"): "new", ("A", "a"): "new"}


def test_upsert_swap_goes_on_after_a_crash_in_it(spark, tmp_path, monkeypatch):
    """A swap that ended with one folder moved and the next one's place empty is finished by the replay."""
    schema, root = _upsert_schema(), str(tmp_path / "tbl")
    spark.createDataFrame([("A", "x", 0, "old"), ("B", "y", 0, "old"), ("C", "c", 0, "old")], schema) \
        .write.partitionBy("cid").parquet(f"{root}/live")
    batch = spark.createDataFrame([("A", "x", 5, "new"), ("B", "z", 1, "new")], schema)
    original = ST._swap

    def cut_short(spark_, stage, live, parts):
        for name, moved in (("cid=A", True), ("cid=B", False)):
            for f in os.listdir(f"{live}/{name}"):
                os.remove(f"{live}/{name}/{f}")
            os.rmdir(f"{live}/{name}")
            if moved:
                os.rename(f"{stage}/{name}", f"{live}/{name}")
        raise RuntimeError("crash in the swap")
    fn = ST.upsert_batch_partitioned(root, ["cid", "id"], ["seq"], ["cid"], schema)
    monkeypatch.setattr(ST, "_swap", cut_short)
    with pytest.raises(RuntimeError):
        fn(batch, 3)
    monkeypatch.setattr(ST, "_swap", original)
    fn(batch, 3)
    got = {(r.cid, r.id): r.v for r in spark.read.schema(schema).parquet(f"{root}/live").collect()}
    assert got == {("A", "x"): "new", ("B", "y"): "old", ("B", "z"): "new", ("C", "c"): "old"}


def test_dedupe_within_watermark(spark, tmp_path):
    t0 = D(2024, 1, 1)
    df = spark.createDataFrame([(1, "running", t0), (1, "running", t0 + dt.timedelta(minutes=10)),
                                (1, "Succeeded", t0 + dt.timedelta(minutes=20))], SCHEMA)
    stage_files(df, str(tmp_path / "in"), 1)
    s = ST.dedupe_statuses(ST.read_files(spark, str(tmp_path / "in"), SCHEMA))
    out = str(tmp_path / "out")
    ST.run_available(s.writeStream.format("parquet").option("path", out).outputMode("append"), str(tmp_path / "ck"))
    assert sorted(r.status for r in spark.read.parquet(out).collect()) == ["Succeeded", "running"]


def test_partitioned_upsert_replay(spark, tmp_path):
    schema = T.StructType([T.StructField("cid", T.StringType()), T.StructField("id", T.StringType()),
                           T.StructField("seq", T.IntegerType()), T.StructField("v", T.StringType())])
    root = str(tmp_path / "tbl")
    spark.createDataFrame([("A", "x", 0, "old"), ("B", "y", 0, "old")], schema) \
        .write.partitionBy("cid").parquet(f"{root}/live")
    b_files = sorted(os.listdir(f"{root}/live/cid=B"))
    fn = ST.upsert_batch_partitioned(root, ["cid", "id"], ["seq"], ["cid"], schema)
    batch = spark.createDataFrame([("A", "x", 5, "new"), ("A", "z", 1, "new")], schema)
    fn(batch, 0)
    fn(batch, 0)  # replay: same staged rows, same partitions
    got = {(r.cid, r.id): r.v for r in spark.read.schema(schema).parquet(f"{root}/live").collect()}
    assert got == {("A", "x"): "new", ("A", "z"): "new", ("B", "y"): "old"}
    assert sorted(os.listdir(f"{root}/live/cid=B")) == b_files   # untouched partition not rewritten


def test_fs_uri_normalisation():
    from gridcat.sources.fs import normalize_uri, open_fs
    assert normalize_uri("s3a://b/k") == "s3://b/k" and normalize_uri("s3n://b/k") == "s3://b/k"
    assert normalize_uri("file:/tmp/x") == "file:///tmp/x"
    cache = {}
    assert open_fs("file:///tmp/a", cache)[1] == "/tmp/a" and open_fs("file:///tmp/b", cache)[1] == "/tmp/b"
    assert len(cache) == 1 and open_fs("/tmp/c")[1] == "/tmp/c"


def test_granule_fields_are_required(spark):
    from gridcat import schemas
    recs = spark.createDataFrame([(("G1", ([("u1",), ("u2",)],)),), ((None, ([],)),)], schemas.GRANULE)
    got = [(r.granule_ur, r.url, r.violation) for r in L.granule_fields(recs).collect()]
    assert got == [("G1", "u1", None), (None, None, "missing: GranuleUR, OnlineAccessURL")]


def test_checkpoint_folder_has_to_be_shared(monkeypatch):
    from types import SimpleNamespace
    from gridcat import session
    conf = SimpleNamespace(get=lambda *a: None)
    fake = SimpleNamespace(sparkContext=SimpleNamespace(getConf=lambda: conf, master="spark://host:7077"), conf=conf)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(fake)
    assert int(session.cluster_conf(100 << 40, 1000, 8)["spark.sql.shuffle.partitions"]) == 409_600
