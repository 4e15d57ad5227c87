"""Regular-grid operators: point -> cell, bin statistics, dense scaffold,
multi-grid combine.

IDs: C8, C9, C12, A7, A8, A9.  Range joins are avoided: a point's cell is
computed (``floor``), never searched for.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcat.functions.requests import SIZE_TOLERANCE

DEFAULT_RESOLUTION = 0.005  # degrees; the estuary regrid default


@dataclass(frozen=True)
class Grid:
    """A regular lon/lat grid: extent plus resolution (cell size in degrees)."""
    min_lon: float = -180.0
    min_lat: float = -90.0
    max_lon: float = 180.0
    max_lat: float = 90.0
    res_x: float = DEFAULT_RESOLUTION
    res_y: float | None = None

    @property
    def ry(self) -> float:
        return self.res_y if self.res_y is not None else self.res_x

    @property
    def nx(self) -> int:
        return cell_count(self.max_lon - self.min_lon, self.res_x)

    @property
    def ny(self) -> int:
        return cell_count(self.max_lat - self.min_lat, self.ry)

    @classmethod
    def from_size(cls, min_lon, min_lat, max_lon, max_lat, nx: int, ny: int) -> "Grid":
        return cls(min_lon, min_lat, max_lon, max_lat, (max_lon - min_lon) / nx, (max_lat - min_lat) / ny)


def cell_count(span: float, resolution: float) -> int:
    """Cells that cover ``span``; a remainder within ``SIZE_TOLERANCE`` of a
    cell is rounding noise.  The one rule for grids, X24 included."""
    return max(1, math.ceil(span / resolution - SIZE_TOLERANCE))


def assign_cells(points: DataFrame, grid: Grid, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """Add integer cell keys ``(iy, ix)``; points outside the extent are
    dropped (the extent test is a plain range predicate, pushed to the scan)."""
    inside = ((F.col(lon) >= grid.min_lon) & (F.col(lon) <= grid.max_lon)
              & (F.col(lat) >= grid.min_lat) & (F.col(lat) <= grid.max_lat))
    return (points.filter(inside)
            .withColumn("ix", F.least(F.floor((F.col(lon) - F.lit(grid.min_lon)) / F.lit(grid.res_x)),
                                      F.lit(grid.nx - 1)).cast("bigint"))
            .withColumn("iy", F.least(F.floor((F.col(lat) - F.lit(grid.min_lat)) / F.lit(grid.ry)),
                                      F.lit(grid.ny - 1)).cast("bigint")))


def bin_mean(points: DataFrame, grid: Grid, keys: Sequence[str] = ("variable",), value: str = "value",
             lon: str = "lon", lat: str = "lat") -> DataFrame:
    """Arithmetic mean of the non-null points per cell (+ their count
    and sum so coarser levels stay exact).  Partial aggregation map-side."""
    cells = assign_cells(points, grid, lon, lat)
    return cells.groupBy(*keys, "iy", "ix").agg(
        F.avg(value).alias("mean"), F.count(value).cast("bigint").alias("n"), F.sum(value).alias("total"))


def regrid_curvilinear(points: DataFrame, grid: Grid, keys: Sequence[str] = ("variable",),
                       value: str = "value", lon: str = "lon", lat: str = "lat") -> DataFrame:
    """A curvilinear grid carries 2-d lat/lon per point; regridding to a
    regular WGS84 grid is the same bin mean over those coordinates."""
    return bin_mean(points, grid, keys, value, lon, lat)


def cell_centers(df: DataFrame, grid: Grid) -> DataFrame:
    return (df.withColumn("lon", F.lit(grid.min_lon) + (F.col("ix") + F.lit(0.5)) * F.lit(grid.res_x))
            .withColumn("lat", F.lit(grid.min_lat) + (F.col("iy") + F.lit(0.5)) * F.lit(grid.ry)))


# ---------------------------------------------------------------- C9
def dense_scaffold(grid: Grid, key_rows: DataFrame, keys: Sequence[str] = ("variable",),
                   tile: int = 256) -> DataFrame:
    """Every cell of the grid for every key of ``key_rows``, as
    ``(keys..., iy, ix)``; ``tile`` only sizes the work, never the result.

    The distinct keys are exploded to tile numbers (39,551 tiles of 256x256 for
    a global 0.005 degree grid), dealt by (key, tile), and each tile is one
    bounded explode - no cross join, no task with more than its share."""
    across = -(-grid.nx // tile)
    tiles = across * -(-grid.ny // tile)
    dealt = (key_rows.select(*keys).distinct()
             .select(*keys, F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))).alias("tile"))
             .repartition(*keys, "tile"))
    top, left = F.floor(F.col("tile") / across) * tile, F.col("tile") % across * tile
    cells = dealt.select(*keys, top.alias("top"), left.alias("left"),
                         F.explode(F.sequence(F.lit(0), F.lit(tile * tile - 1))).alias("o"))
    out = cells.select(*keys, (F.col("top") + F.floor(F.col("o") / tile)).cast("bigint").alias("iy"),
                       (F.col("left") + F.col("o") % tile).cast("bigint").alias("ix"))
    return out.filter((F.col("iy") < grid.ny) & (F.col("ix") < grid.nx))


def densify(stats: DataFrame, scaffold: DataFrame, keys: Sequence[str] = ("variable",)) -> DataFrame:
    """Left join of the bin statistics onto the scaffold (empty = NULL, n 0)."""
    out = scaffold.join(stats, [*keys, "iy", "ix"], "left")
    return out.withColumn("n", F.coalesce(F.col("n"), F.lit(0)).cast("bigint")) if "n" in stats.columns else out


# ---------------------------------------------------------------- C12 / A7
COMBINE_METHODS = ("sum", "mean", "median", "min", "max")


def combine_grids(grids: Sequence[DataFrame] | DataFrame, value: str = "mean",
                  keys: Sequence[str] = ("iy", "ix"), methods: Sequence[str] = COMBINE_METHODS) -> DataFrame:
    """C12 + A7: align several gridded outputs on the same cell (a union then
    one ``groupBy`` - cheaper than an n-way join) and combine per cell.
    NULLs are skipped; an all-NULL cell stays NULL; ``median`` is exact (the
    mean of the two middle values).  sum/mean/min/max aggregate partially;
    a cell has one value per input grid, so the median's group is bounded by
    the number of grids."""
    df = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), grids) \
        if isinstance(grids, (list, tuple)) else grids
    fn = {"sum": lambda c: F.sum(c), "mean": lambda c: F.avg(c), "median": lambda c: F.median(c),
          "min": lambda c: F.min(c), "max": lambda c: F.max(c)}
    aggs = [fn[m](value).alias(m) for m in methods]
    return df.groupBy(*keys).agg(*aggs, F.count(value).cast("bigint").alias("n_grids"))


# ---------------------------------------------------------------- exact means
def exact_mean(total_units, n, in_digits: int = 2, out_digits: int = 6) -> Column:
    """Mean of fixed-point values, rounded half-up to ``out_digits``, exactly.

    ``total_units`` is the integer sum of the values scaled by
    ``10**in_digits`` (e.g. cents); the rounding is done in integer
    arithmetic and the result divided once, so the double is the same on any
    engine and in any summation order (a float ``avg`` is not)."""
    t = F.col(total_units) if isinstance(total_units, str) else total_units
    c = F.col(n) if isinstance(n, str) else n
    num = t.cast("bigint") * F.lit(2 * 10 ** (out_digits - in_digits)) + c
    den = c * F.lit(2)
    q = ((num - F.pmod(num, den)) / den).cast("bigint")
    return F.when(c > 0, q.cast("double") / F.lit(float(10 ** out_digits)))


def to_units(value, digits: int = 2) -> Column:
    """A decimal value with at most ``digits`` decimals as an exact integer."""
    v = F.col(value) if isinstance(value, str) else value
    return F.round(v * F.lit(10 ** digits)).cast("bigint")
