"""Raster tiles, overview pyramids and item derivation.

IDs: S18, A10, A11.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcat.functions.arrays import dense_values
from gridcat.session import stored


def cells_to_tiles(cells: DataFrame, keys: Sequence[str], size: int = 256) -> DataFrame:
    """Fixed-size raster tiles per ``keys`` (e.g. variable, time): each
    tile is a dense row-major array of ``size*size`` values (NULL = nodata; the
    greatest value where a cell repeats).  A tile never holds more than
    ``size*size`` cells."""
    loc = ((F.col("y") % size) * size + (F.col("x") % size)).cast("int")
    tile = [*keys, "ty", "tx"]
    placed = cells.select(*keys, (F.col("y") / size).cast("int").alias("ty"),
                          (F.col("x") / size).cast("int").alias("tx"), loc.alias("loc"), "value")
    g = (placed.repartition(*tile).groupBy(*tile, "loc").agg(F.max("value").alias("value"))
         .groupBy(*tile).agg(F.collect_list(F.struct("loc", "value")).alias("_e"),
                             F.count("value").cast("bigint").alias("n"), F.sum("value").alias("total"),
                             F.min("value").alias("vmin"), F.max("value").alias("vmax")))
    return g.select(*keys, F.lit(0).alias("zoom"), "ty", "tx", F.array(F.lit(size), F.lit(size)).alias("shape"),
                    dense_values("_e", size * size).alias("values"), "n", "total", "vmin", "vmax")


def tiles_to_cells(tiles: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The inverse of ``cells_to_tiles``; nodata cells stay absent."""
    rows, cols = F.col("shape")[0], F.col("shape")[1]
    ex = tiles.select(*keys, "ty", "tx", "shape", F.posexplode("values").alias("_p", "value"))
    return ex.filter(F.col("value").isNotNull()).select(
        *keys, (F.col("ty") * rows + (F.col("_p") / cols).cast("int")).alias("y"),
        (F.col("tx") * cols + F.col("_p") % cols).alias("x"), "value")


def write_tiles(tiles: DataFrame, path: str, partition_by: Sequence[str] = ("zoom",)) -> str:
    """S18 sink: tiles as Parquet partitioned by ``partition_by``."""
    tiles.hint("rebalance", *partition_by).write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return path


def overview_levels(cells: DataFrame, keys: Sequence[str], levels: Sequence[int],
                    value: str = "value") -> DataFrame:
    """A10: the overview pyramid - level ``z`` halves the raster ``z`` times.
    The first level is summed from the cells and each further one from the
    (sum, count) of the level before, a quarter of its rows, so means stay
    exact averages of the base cells and the base is read once.  Each level is
    written to the shared folder, since the next level and the result both read it."""
    below = cells.filter(F.col(value).isNotNull()).select(
        *keys, "y", "x", F.col(value).alias("total"), F.lit(1).cast("bigint").alias("n"))
    out, at = None, 0
    for z in sorted(set(levels)):
        below = stored(below.groupBy(*keys, F.shiftright("y", z - at).alias("y"), F.shiftright("x", z - at).alias("x"))
                       .agg(F.sum("total").alias("total"), F.sum("n").alias("n")), f"overview-{z}")
        at = z
        lvl = below.withColumn("level", F.lit(z))
        out = lvl if out is None else out.unionByName(lvl)
    return out.withColumn("mean", F.col("total") / F.col("n"))


def derive_items(cells: DataFrame, keys: Sequence[str], lat: str = "lat", lon: str = "lon",
                 value: str = "value") -> DataFrame:
    """One catalog item per product (``keys``): bounding box and the
    number of valid values."""
    return cells.groupBy(*keys).agg(
        F.min(lon).alias("west"), F.min(lat).alias("south"), F.max(lon).alias("east"), F.max(lat).alias("north"),
        F.count(value).cast("bigint").alias("n"))
