"""Literal-row tests for the Column functions (URIs, requests, job records),
including the quirk decisions Q1-Q4, Q15, Q17, Q18, Q21-Q23."""

from pyspark.sql import functions as F

from gridcat.functions import jobs as J
from gridcat.functions import requests as R
from gridcat.functions import uris as U


def one(spark, col, **cols):
    """Evaluate a Column over one literal row."""
    df = spark.createDataFrame([tuple(cols.values())], ", ".join(f"{k} string" for k in cols))
    return df.select(col.alias("r")).first()["r"]


def many(spark, fn, values, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {typ}")
    return [r["r"] for r in df.select(F.monotonically_increasing_id().alias("i"), fn(F.col("v")).alias("r"))
            .orderBy("i").collect()]


# ---------------------------------------------------------------- X1 X7
def test_parse_object_uri(spark):
    out = many(spark, U.parse_object_uri, [
        "s3://bkt/a/b.nc", "s3://bkt", "s3://s3-us-west-2.amazonaws.com:80/bkt/p/k", "s3://s3.amazonaws.com/bkt",
        "http://x/y", "s3://s3-data/k"])
    assert (out[0]["bucket"], out[0]["key"], out[0]["error"]) == ("bkt", "a/b.nc", None)
    assert (out[1]["bucket"], out[1]["key"]) == ("bkt", "")
    assert (out[2]["bucket"], out[2]["key"]) == ("bkt", "p/k")
    assert (out[3]["bucket"], out[3]["key"]) == ("bkt", "")
    assert out[4]["bucket"] is None and out[4]["error"] == "invalid scheme"
    # Q4: a bucket literally called s3-data is a bucket, not a host
    assert (out[5]["bucket"], out[5]["key"]) == ("s3-data", "k")


def test_valid_object_uri(spark):
    assert many(spark, U.is_valid_object_uri, ["s3://", "s3://b", "http://b"]) == [False, True, False]


# ---------------------------------------------------------------- X2 X3
def test_http_to_object_uri_both_styles_and_regions(spark):
    out = many(spark, U.http_to_object_uri, [
        "https://tides.s3.amazonaws.com/2021/run.nc",
        "https://s3.amazonaws.com/tides/2021/run.nc",
        "https://b.s3.us-west-2.amazonaws.com/p/x.tif",      # Q1 regional
        "https://s3-us-west-2.amazonaws.com/b/p/x.tif",      # regional path style
        "https://my.dotted.bucket.s3.amazonaws.com/k",       # Q3
        "https://example.com/x"])
    assert out == ["s3://tides/2021/run.nc", "s3://tides/2021/run.nc", "s3://b/p/x.tif",
                   "s3://b/p/x.tif", "s3://my.dotted.bucket/k", None]


def test_to_object_uri_keeps_unmatched_and_strict_mode(spark):
    hrefs = ["https://b.s3.us-west-2.amazonaws.com/k", "https://www.example.com/a.s3.tif", "s3://b/k"]
    assert many(spark, U.to_object_uri, hrefs) == ["s3://b/k", "https://www.example.com/a.s3.tif", "s3://b/k"]
    # strict reproduces the original: regional host passes the gate, no pattern -> NULL
    strict = many(spark, lambda c: U.to_object_uri(c, strict=True), hrefs)
    assert strict == [None, None, "s3://b/k"]
    assert many(spark, U.needs_conversion, ["https://s3.amazonaws.com/b/k"]) == [False]  # Q2


# ---------------------------------------------------------------- X4 X5 X6
def test_normalize_href(spark):
    base = "https://host.example/cat/col/collection.json?x=1#f"
    out = many(spark, lambda c: U.normalize_href(c, F.lit(base)),
               ["./items/a.json", "../other/b.json", "/root.json", "c.json", "https://x/y", "s3://b/k",
                "a/./b/../c.json", ""])
    assert out == ["https://host.example/cat/col/items/a.json", "https://host.example/cat/other/b.json",
                   "https://host.example/root.json", "https://host.example/cat/col/c.json", "https://x/y",
                   "s3://b/k", "https://host.example/cat/col/a/c.json", base]


def test_normalize_href_s3_base(spark):
    base = "s3://bkt/cat/collection.json"
    out = many(spark, lambda c: U.normalize_href(c, F.lit(base)), ["item.json", "./x/i.json", "bkt/other/k.json"])
    # Q21: relative to the base key's folder; bucket-prefixed gains the scheme
    assert out == ["s3://bkt/cat/item.json", "s3://bkt/cat/x/i.json", "s3://bkt/other/k.json"]


def test_normalize_href_is_idempotent(spark):
    base = F.lit("https://h.example/a/b/c.json")
    df = spark.createDataFrame([("../x/./y.json",), ("z.json",)], "h string")
    once = df.select(U.normalize_href("h", base).alias("h"))
    twice = once.select(U.normalize_href("h", base).alias("h"))
    assert sorted(r.h for r in once.collect()) == sorted(r.h for r in twice.collect())


def test_normalize_links_and_assets(spark):
    df = spark.createDataFrame(
        [("https://h.example/c/col.json", [("item", "./i.json")], {"data": ("../d.tif",)})],
        "base string, links array<struct<rel:string,href:string>>, assets map<string,struct<href:string>>")
    r = df.select(U.normalize_links("links", F.col("base")).alias("l"),
                  U.normalize_assets("assets", F.col("base")).alias("a")).first()
    assert r.l[0].href == "https://h.example/c/i.json"
    assert r.a["data"].href == "https://h.example/d.tif"


# ---------------------------------------------------------------- X11 X12
def test_prefix_rewrite_and_relative(spark):
    assert many(spark, lambda c: U.prefix_rewrite(c, "in/", "out/"), ["in/a/in/b", "x/in/a"]) == \
        ["out/a/in/b", "x/in/a"]  # Q22: anchored
    assert many(spark, lambda c: U.relative_key(c, "data/run1"), ["data/run1/a/b.nc", "data/run1/", "data/run1"]) == \
        ["a/b.nc", ".", "."]


# ---------------------------------------------------------------- X15 X16 X28
def test_product_names_and_variable(spark):
    assert many(spark, U.file_stem, ["a.b.nc", "noext", "x.tif"]) == ["a.b", "noext", "x"]
    assert many(spark, U.variable_from_filename, [
        "REAN2_400.tavg1_2d_flx_Nx.20250331_PRECTOT.tif", "data_TEMP_analysis.tif", "plain_name.tif",
        "single.tif", "s3://b/k/run_SWE.tif"]) == ["PRECTOT", "TEMP", "name", "data", "SWE"]
    assert many(spark, lambda c: U.short_id(c, 7), ["abcdefghij"]) == ["defghij"]


def test_endpoints(spark):
    assert one(spark, U.item_endpoint(F.lit("https://h"), F.col("c"), F.col("i")), c="C1", i="it") == \
        "https://h/stac/collections/C1/items/it"
    url = one(spark, U.feature_query_url(F.lit("https://m"), F.lit("ws"), F.col("l")), l="a b")
    assert url.startswith("https://m/ws/ows?service=WFS") and "typeName=ws%3Aa+b" in url


# ---------------------------------------------------------------- X8 X9 X10 X13 X14 X19
def test_detect_input_type(spark):
    df = spark.createDataFrame([
        ("G1", None), ("none", "s3://b/f.nc4"), (None, "s3://b/f.zarr/"), (None, "s3://b/f.gpkg"),
        (None, "s3://b/dir/"), (None, "s3://b/f.txt"), ("", "s3://b/f.nc")], "g string, u string")
    out = [r.t for r in df.select(R.detect_input_type("g", "u").alias("t")).collect()]
    assert out == ["daac", "s3_netcdf", "s3_zarr", "s3_gpkg", "s3_folder", None, "s3_netcdf"]


def test_step_plan(spark):
    df = spark.createDataFrame([("all", "s3_zarr"), ("stage, concat ,catalog", "daac"), ("zarr2cog,bad", None)],
                               "s string, t string")
    r = df.select(R.step_plan("s", "t").alias("p")).withColumn("bad", R.invalid_steps("p")).collect()
    assert r[0].p == ["zarr2cog", "catalog"]
    assert r[1].p == ["stage", "concat", "catalog"] and r[1].bad == []
    assert r[2].bad == ["bad"]


def test_violations_and_required(spark):
    df = spark.createDataFrame([("G", None, "https://x"), (None, "C", "s3://b/k"), (None, None, None)],
                               "g string, c string, u string")
    v = [r.v for r in df.select(R.request_violations("g", "c", "u").alias("v")).collect()]
    assert v[0] == ["collection id is required with a granule id", "invalid object URL: https://x"]
    assert v[1] == [] and v[2] == []
    m = [r.m for r in df.select(R.missing_fields(["g", "c", "u"]).alias("m")).collect()]
    assert m == [["c"], ["g"], ["g", "c", "u"]]
    assert one(spark, R.concept_id_or_collection(F.col("a"), F.col("b")), a="", b="C") == "C"


def test_selects_variable(spark):
    df = spark.createDataFrame([("a, b c", "b"), ("a,b", "c"), ("*", "z"), (None, "q")], "l string, v string")
    assert [r.s for r in df.select(R.selects_variable("l", "v").alias("s")).collect()] == [True, False, True, True]


def test_extent_and_grid(spark):
    df = spark.createDataFrame([("-10,-5,10,5", 0.5), ("0 0 1 1", 0.0), ("1 2 3", 1.0), ("10 0 -10 5", 1.0)],
                               "e string, r double")
    st = R.with_grid_spec(R.with_extent(df, "e"), "extent_parsed", "r").collect()
    assert (st[0].grid.nx, st[0].grid.ny, st[0].grid.error) == (40, 20, None)   # Q17: commas accepted
    assert st[1].grid.error == "resolution must be > 0"                         # Q23
    assert st[2].grid.error.startswith("expected 4 fields")
    assert st[3].grid.error == "min longitude >= max longitude"
    size = spark.createDataFrame([("0 0 10 5",)], "e string").select(
        R.grid_spec(R.parse_extent("e"), None, F.lit(4), F.lit(2)).alias("g")).first().g
    assert (size.res_x, size.res_y, size.nx) == (2.5, 2.5, 4)


# ---------------------------------------------------------------- X20 X21 X22 X27
def test_job_records(spark):
    df = spark.createDataFrame([('{"message": "boom"}', None), ("not json", "500"), (None, "404"), (None, None)],
                               "d string, c string")
    assert [r.m for r in df.select(J.job_error_message("d", "c").alias("m")).collect()] == \
        ["boom", "not json", "404", "Unknown error"]
    ids = many(spark, J.job_task_id, ['{"job_info":{"job_payload":{"payload_task_id":"t1"}}}', '{"job_info":{}}',
                                      "garbage", None])
    assert ids == ["t1", "", "", ""]


def test_status_class(spark):
    # Q15: queued is pending (catalog-job classification), failed is terminal
    assert many(spark, J.status_class, ["Succeeded", "queued", "Failed", "deleted", "weird", None]) == \
        ["succeeded", "pending", "failed", "failed", "unknown", "unknown"]


def test_unwrap_names(spark):
    out = many(spark, J.unwrap_names, ['{"layers":{"layer":[{"name":"a"}]}}', '{"layers":[{"name":"b"}]}',
                                       '[{"name":"c"}]', '{"other":1}', "oops"])
    assert [[x.name for x in o] for o in out] == [["a"], ["b"], ["c"], [], []]


def test_input_type_error_and_default_pattern(spark):
    from gridcat.sources.listing import default_pattern, file_format
    assert one(spark, R.input_type_error(F.col("g"), F.col("u")), g=None, u="s3://b/f.txt") == \
        "unsupported file type: s3://b/f.txt"
    assert many(spark, default_pattern, [".zarr", ".TIF", None]) == ["*.zarr", "*.tif", "*.nc*"]
    assert many(spark, file_format, ["a.GPKG", "b.Zip", "c.shp", "d.nc"]) == ["gpkg", "zip", "shp", None]
