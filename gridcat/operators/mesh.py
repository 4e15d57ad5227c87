"""Regridding from a curvilinear mesh to a regular grid.

IDs: A9 (C8's cells).  A model's native grid carries a latitude and a longitude per
point.  Four neighbouring points are a quad; a target cell takes its value from
the quad that covers its centre, with inverse bilinear weights, so the grid has
no hole inside the mesh however coarse the mesh is, and a field that is linear
in longitude and latitude comes out exactly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcat.functions.arrays import let
from gridcat.operators.grid import Grid

EDGE = 1e-9     # how far beyond an edge, in parts of the quad, a centre still counts as covered
_CORNERS = ((0, 0), (0, 1), (1, 0), (1, 1))


def mesh_quads(points: DataFrame, keys: Sequence[str], y: str = "y", x: str = "x", lon: str = "lon", lat: str = "lat",
               value: str = "value") -> DataFrame:
    """The quads of a mesh: ``(keys..., y, x, lon00, lat00, v00, lon01, ...)``, named by its least
    corner (suffix: y step, x step).  Every point goes to the four quads it is a corner of
    and a quad is one aggregate row; one that lacks a corner or a corner's place is left out.  Of
    points that repeat an index the greatest place counts."""
    corner = F.explode(F.array(*(F.struct(F.lit(a).alias("dy"), F.lit(b).alias("dx")) for a, b in _CORNERS)))
    placed = points.where(F.col(lon).isNotNull() & F.col(lat).isNotNull() & ~F.isnan(lon) & ~F.isnan(lat))
    dealt = placed.select(*keys, F.col(y).alias("_y"), F.col(x).alias("_x"),
                          F.struct(F.col(lon).cast("double").alias("lon"), F.col(lat).cast("double").alias("lat"),
                                   F.col(value).cast("double").alias("v")).alias("_p"), corner.alias("_c"))
    met = dealt.groupBy(*keys, (F.col("_y") - F.col("_c.dy")).alias("y"), (F.col("_x") - F.col("_c.dx")).alias("x")).agg(
        *(F.max(F.when((F.col("_c.dy") == a) & (F.col("_c.dx") == b), F.col("_p"))).alias(f"_p{a}{b}")
          for a, b in _CORNERS))
    for a, b in _CORNERS:
        met = met.where(F.col(f"_p{a}{b}").isNotNull())
    return met.select(*keys, "y", "x", *(F.col(f"_p{a}{b}.{f}").alias(f"{f}{a}{b}")
                                         for a, b in _CORNERS for f in ("lon", "lat", "v")))


def covered_cells(quads: DataFrame, grid: Grid, keys: Sequence[str]) -> DataFrame:
    """Each quad's target cells, those whose centre it covers, with the centre's place
    ``(u, v)`` in the quad (x and y direction, 0 to 1).  Candidates are the cells of the quad's
    bounding box, exploded by row and then by column."""
    def span(axis: str, start: float, step: float, n: int) -> Column:
        corners = [F.col(f"{axis}{a}{b}") for a, b in _CORNERS]
        low = F.ceil((F.least(*corners) - F.lit(start)) / F.lit(step) - F.lit(0.5 + EDGE))
        high = F.floor((F.greatest(*corners) - F.lit(start)) / F.lit(step) - F.lit(0.5 - EDGE))
        low, high = F.greatest(low, F.lit(0)), F.least(high, F.lit(n - 1))
        return F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<bigint>"))

    rows = quads.select("*", F.explode(span("lat", grid.min_lat, grid.ry, grid.ny)).alias("iy"))
    cells = rows.select("*", F.explode(span("lon", grid.min_lon, grid.res_x, grid.nx)).alias("ix"))
    found = cells.select("*", F.explode(F.slice(_places(grid), 1, 1)).alias("_at"))
    inside = lambda f: F.least(F.greatest(F.col(f"_at.{f}"), F.lit(0.0)), F.lit(1.0)).alias(f)
    return found.select(*keys, "y", "x", "iy", "ix", inside("u"), inside("v"), "v00", "v01", "v10", "v11")


def _places(grid: Grid) -> Column:
    """The places ``(u, v)`` inside a quad that are mapped to a cell's centre: at most two, none if the quad does
    not cover it.  Intermediate values are bound once each, in structs; as columns they
    would be inlined into one another."""
    c, lon0, lat0 = F.col, F.lit(grid.min_lon), F.lit(grid.min_lat)
    sides = F.struct(
        (c("lon01") - c("lon00")).alias("ex"), (c("lat01") - c("lat00")).alias("ey"), (c("lon10") - c("lon00")).alias("fx"),
        (c("lat10") - c("lat00")).alias("fy"), (c("lon00") - c("lon01") + c("lon11") - c("lon10")).alias("gx"),
        (c("lat00") - c("lat01") + c("lat11") - c("lat10")).alias("gy"),
        (lon0 + (c("ix") + F.lit(0.5)) * F.lit(grid.res_x) - c("lon00")).alias("hx"),
        (lat0 + (c("iy") + F.lit(0.5)) * F.lit(grid.ry) - c("lat00")).alias("hy"))

    def cross(s: Column, a: str, b: str) -> Column:
        return s[f"{a}x"] * s[f"{b}y"] - s[f"{a}y"] * s[f"{b}x"]

    def place(s: Column, v: Column) -> Column:
        dx, dy = s["ex"] + s["gx"] * v, s["ey"] + s["gy"] * v
        u = F.when(F.abs(dx) >= F.abs(dy), F.when(dx != 0, (s["hx"] - s["fx"] * v) / dx)).otherwise(
            (s["hy"] - s["fy"] * v) / dy)
        return F.struct(u.alias("u"), v.alias("v"))

    def roots(s: Column, t: Column) -> Column:
        # v solves a*v*v + b*v + k = 0; the larger of the two sums as q keeps both roots exact where a is small
        q = F.lit(-0.5) * (t["b"] + F.when(t["b"] < 0, -F.sqrt(t["w"])).otherwise(F.sqrt(t["w"])))
        return let(q, lambda x: F.transform(F.array(F.when(x != 0, t["k"] / x), F.when(t["a"] != 0, x / t["a"])),
                                            lambda v: place(s, v)))

    def solved(s: Column) -> Column:
        terms = F.struct(cross(s, "g", "f").alias("a"), (cross(s, "e", "f") + cross(s, "h", "g")).alias("b"),
                         cross(s, "h", "e").alias("k"))
        return let(terms, lambda t: let(
            F.struct(t["a"].alias("a"), t["b"].alias("b"), t["k"].alias("k"),
                     (t["b"] * t["b"] - F.lit(4.0) * t["a"] * t["k"]).alias("w")),
            lambda r: F.when(r["w"] >= 0, roots(s, r))))

    return F.filter(let(sides, solved), lambda p: p["u"].between(-EDGE, 1 + EDGE) & p["v"].between(-EDGE, 1 + EDGE))


def regrid_mesh(points: DataFrame, grid: Grid, keys: Sequence[str] = ("variable",), y: str = "y", x: str = "x",
                lon: str = "lon", lat: str = "lat", value: str = "value") -> DataFrame:
    """A field on a curvilinear mesh (``keys..., y, x, lon, lat, value``) on the cells of a
    regular grid: ``(keys..., iy, ix, value)``.

    A cell has a row where the mesh covers its centre; its value is NULL where one of the
    quad's corners has none.  A centre on a shared edge, or under a fold of the mesh, takes
    the quad of the least index.  Quads are exploded to cells, never searched for, so there is
    no range join; both shuffles are on bounded keys (a quad, a cell)."""
    cells = covered_cells(mesh_quads(points, keys, y, x, lon, lat, value), grid, keys)
    u, v = F.col("u"), F.col("v")
    mixed = ((F.lit(1.0) - u) * (F.lit(1.0) - v) * F.col("v00") + u * (F.lit(1.0) - v) * F.col("v01")
             + (F.lit(1.0) - u) * v * F.col("v10") + u * v * F.col("v11"))
    best = cells.groupBy(*keys, "iy", "ix").agg(F.min(F.struct("y", "x", mixed.alias("value")))["value"].alias("value"))
    return best.select(*keys, "iy", "ix", "value")
