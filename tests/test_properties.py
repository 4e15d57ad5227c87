"""
idempotent, A1 does not depend on how the intervals are grouped, and the
overview pyramid preserves the total."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridcat.functions.uris import normalize_href
from gridcat.operators import cells as CE
from gridcat.operators import tiles as TI
from gridcat.operators import upsert as UP

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(ny=st.integers(1, 9), nx=st.integers(1, 9), cy=st.integers(1, 5), cx=st.integers(1, 5),
       holes=st.sets(st.tuples(st.integers(0, 8), st.integers(0, 8)), max_size=10))
def test_chunk_roundtrip(spark, ny, nx, cy, cx, holes):
    data = [("d", "v", y, x, None if (y, x) in holes else float(y * 100 + x)) for y in range(ny) for x in range(nx)]
    cells = spark.createDataFrame(data, "dataset_id string, variable string, y int, x int, value double")
    back = CE.chunks_to_cells(CE.cells_to_chunks(cells, ["dataset_id", "variable"], cy=cy, cx=cx),
                              ["dataset_id", "variable"])
    want = sorted(tuple(r) for r in cells.filter(F.col("value").isNotNull()).collect())
    assert sorted(tuple(r) for r in back.collect()) == want


SEG = st.sampled_from(["a", "b", ".", "..", "c.json", "d"])


@SETTINGS
@given(parts=st.lists(SEG, min_size=1, max_size=5), lead=st.sampled_from(["", "./", "../", "/"]))
def test_normalize_href_idempotent(spark, parts, lead):
    href = lead + "/".join(parts)
    base = F.lit("https://h.example/x/y/z.json")
    df = spark.createDataFrame([(href,)], "h string")
    once = df.select(normalize_href("h", base).alias("h")).first().h
    twice = spark.createDataFrame([(once,)], "h string").select(normalize_href("h", base).alias("h")).first().h
    assert once == twice and once.startswith("https://h.example/") and "/./" not in once and "/../" not in once


DAY = st.integers(0, 400).map(lambda d: dt.datetime(2020, 1, 1) + dt.timedelta(days=d))


@SETTINGS
@given(iv=st.lists(st.tuples(st.one_of(st.none(), DAY), st.one_of(st.none(), DAY)), min_size=1, max_size=6),
       split=st.integers(0, 6))
def test_extent_union_associative(spark, iv, split):
    s = "c string, start_ts timestamp, end_ts timestamp"
    rows = [("C", a, b) for a, b in iv]
    whole = UP.merge_temporal_extent(spark.createDataFrame(rows, s), "c").first()
    k = min(split, len(rows))
    parts = [r for r in (rows[:k], rows[k:]) if r]
    partial = [UP.merge_temporal_extent(spark.createDataFrame(p, s), "c").first() for p in parts]
    merged = UP.merge_temporal_extent(spark.createDataFrame(
        [("C", p.extent_start, p.extent_end) for p in partial], s), "c").first()
    assert (whole.extent_start, whole.extent_end) == (merged.extent_start, merged.extent_end)


@SETTINGS
@given(n=st.integers(1, 12), z=st.integers(1, 4))
def test_pyramid_total(spark, n, z):
    data = [("d", "v", y, x, float((y * 7 + x * 3) % 11)) for y in range(n) for x in range(n)]
    cells = spark.createDataFrame(data, "dataset_id string, variable string, y int, x int, value double")
    lvl = TI.overview_levels(cells, ["dataset_id", "variable"], [z])
    assert lvl.agg(F.sum("total")).first()[0] == sum(r[4] for r in data)
    assert lvl.agg(F.sum("n")).first()[0] == n * n
