"""Time slicing, vertical-level picking and suffix routing.

IDs: W5, W6, C10, L1.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Routing of sliced model files to collections - surface (s0)
# and bottom (s19) level, nowcast (_1) and forecast (_2).
ROUTES = [("s0_1", "surface_nowcast"), ("s0_2", "surface_forecast"),
          ("s19_1", "bottom_nowcast"), ("s19_2", "bottom_forecast")]


def time_slices(cells: DataFrame, by: Sequence[str], step: str) -> DataFrame:
    """Slice number (1-based, in time order) of every step within ``by``.
    Ranks the distinct steps only, then joins back (no window over all cells)."""
    steps = cells.select(*by, step).distinct()
    ranked = steps.withColumn("slice", F.dense_rank().over(Window.partitionBy(*by).orderBy(step)).cast("int"))
    return cells.join(ranked, [*by, step])


def pick_levels(df: DataFrame, by: Sequence[str], level: str = "level") -> DataFrame:
    """Mark the surface (lowest index) and bottom (highest index) level
    within ``by`` - a partial min/max aggregate joined back.  With no ``by``
    the two bounds are uncorrelated scalar subqueries (no join at all)."""
    if not by:
        lo = df.select(F.min(level)).scalar()
        hi = df.select(F.max(level)).scalar()
        return df.withColumn("level_role", F.when(F.col(level) == lo, F.lit("surface"))
                             .when(F.col(level) == hi, F.lit("bottom")))
    ext = df.groupBy(*by).agg(F.min(level).alias("_lo"), F.max(level).alias("_hi"))
    return (df.join(ext, list(by))
            .withColumn("level_role", F.when(F.col(level) == F.col("_lo"), F.lit("surface"))
                        .when(F.col(level) == F.col("_hi"), F.lit("bottom")))
            .drop("_lo", "_hi"))


def routes_table(spark: SparkSession, routes=ROUTES) -> DataFrame:
    return spark.createDataFrame(routes, "suffix string, collection_suffix string")


def route_files(files: DataFrame, routes: DataFrame, name: str = "name") -> DataFrame:
    """Route each file to the collection whose ``<suffix>.nc`` its name
    ends with, whatever the suffix looks like; the longest suffix wins.  A name
    is cut to each suffix length that occurs in ``routes`` (a handful) and
    equi-joined, so the routing table can be of any size; files without a
    route stay (NULL)."""
    lengths = sorted(r[0] for r in routes.select(F.length("suffix")).distinct().collect() if r[0] is not None)
    stem = F.when(F.col(name).endswith(".nc"), F.expr(f"left(`{name}`, length(`{name}`) - 3)"))
    cuts = [F.when(F.length(stem) >= n, F.right(stem, F.lit(n))) for n in lengths]
    asked = files.select(name).distinct().select(F.col(name).alias("_name"), F.explode(
        F.array_compact(F.array(*cuts)) if cuts else F.array().cast("array<string>")).alias("suffix"))
    best = (asked.join(routes, "suffix").groupBy("_name")
            .agg(F.max(F.struct(F.length("suffix").alias("n"), "suffix", "collection_suffix")).alias("_r")))
    return (files.join(best, files[name].eqNullSafe(best["_name"]), "left")
            .select(files["*"], F.col("_r.suffix").alias("suffix"), F.col("_r.collection_suffix").alias("collection_suffix")))


def first_per_route(routed: DataFrame, name: str = "name") -> DataFrame:
    """L1: the first file of each route in sorted order, plus the count."""
    return (routed.filter(F.col("collection_suffix").isNotNull()).groupBy("suffix", "collection_suffix")
            .agg(F.min(name).alias("first_file"), F.count("*").cast("bigint").alias("n_files")))
