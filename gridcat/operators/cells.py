"""Dense arrays <-> cells <-> chunks, store concatenation.

IDs: S8, S9, S10, S11, X17, X18, C13, W7, U4.

* cells  : one row per grid point (long form), the unit every other operator uses;
* chunks : fixed-size blocks of cells (the chunked-store layout), bounded size.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcat.functions.arrays import dense_values

CRS = "EPSG:4326"  # fixed value: the only CRS the original tags rasters with


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def clean_value(v) -> Column:
    """Raster values as DOUBLE with NaN turned into NULL (NaN sorts above
    every number in Spark and would win every ``max``)."""
    d = _c(v).cast("double")
    return F.when(F.isnan(d), F.lit(None)).otherwise(d)


# ---------------------------------------------------------------- S8 / X18
def array_to_cells(arrays: DataFrame, values: str = "values", nx=None,
                   keep: Sequence[str] = ()) -> DataFrame:
    """Flatten a row-major 2-d array (y = dim 0, x = dim 1) to cells
    ``(keep..., y, x, value)``.  ``nx`` is the x size (column or int); by
    default the second entry of a ``shape`` column."""
    nxc = F.col("shape")[1] if nx is None else (F.lit(nx) if isinstance(nx, int) else _c(nx))
    out = arrays.select(*keep, nxc.alias("_nx"), F.posexplode(values).alias("_pos", "_v"))
    return out.select(*keep, (F.col("_pos") / F.col("_nx")).cast("int").alias("y"),
                      (F.col("_pos") % F.col("_nx")).cast("int").alias("x"),
                      clean_value("_v").alias("value"))


def tag_spatial_dims(df: DataFrame, dims: str | None = None) -> DataFrame:
    """Y is dim 0, x is dim 1, CRS label ``EPSG:4326``."""
    if dims:
        df = df.withColumn("y_dim", F.col(dims)[0]).withColumn("x_dim", F.col(dims)[1])
    else:
        df = df.withColumn("y_dim", F.lit("lat")).withColumn("x_dim", F.lit("lon"))
    return df.withColumn("crs", F.lit(CRS))


# ---------------------------------------------------------------- X17 / C13
def rename_coords(df: DataFrame, time: str | None = None, lat: str | None = None,
                  lon: str | None = None) -> DataFrame:
    """Rename the file's coordinate names to ``time``/``lat``/``lon``.
    A name that is not there fails analysis, as the original fails."""
    mapping = {k: v for k, v in ((time, "time"), (lat, "lat"), (lon, "lon")) if k and k != v}
    for k in mapping:
        if k not in df.columns:
            raise ValueError(f"coordinate {k!r} not in {df.columns}")
    return df.withColumnsRenamed(mapping) if mapping else df


def attach_coords(cells: DataFrame, lat_axis: DataFrame, lon_axis: DataFrame,
                  on: Sequence[str] = ()) -> DataFrame:
    """Look up the coordinate of each array index.  Axes are
    ``(on..., idx, lat)`` and ``(on..., idx, lon)``; they hold one row per grid
    line, so the planner broadcasts them once measured small (AQE) and shuffles
    otherwise - no unconditional broadcast hint."""
    la = lat_axis.withColumnRenamed("idx", "y")
    lo = lon_axis.withColumnRenamed("idx", "x")
    return cells.join(la, [*on, "y"], "left").join(lo, [*on, "x"], "left")


# ---------------------------------------------------------------- S9 / S10
def cells_to_chunks(cells: DataFrame, keys: Sequence[str], cy: int = 256, cx: int = 256,
                    ct: int = 1, t: str | None = None) -> DataFrame:
    """Group cells into chunks of ``ct x cy x cx`` and store each as a dense
    row-major ``values`` array (NULL where a cell is absent; the greatest value
    where a cell repeats).  Rows are dealt by chunk once; repeated cells are
    settled before they are collected, so a chunk holds at most
    ``ct*cy*cx`` entries whatever the data size."""
    tc = F.col(t) if t else F.lit(0)
    loc = ((tc % ct) * (cy * cx) + (F.col("y") % cy) * cx + (F.col("x") % cx)).cast("int")
    chunk = [*keys, "t0", "cy0", "cx0"]
    placed = cells.filter(F.col("value").isNotNull()).select(
        *keys, (tc / ct).cast("int").alias("t0"), (F.col("y") / cy).cast("int").alias("cy0"),
        (F.col("x") / cx).cast("int").alias("cx0"), loc.alias("loc"), "value")
    grouped = (placed.repartition(*chunk).groupBy(*chunk, "loc").agg(F.max("value").alias("value"))
               .groupBy(*chunk).agg(F.collect_list(F.struct("loc", "value")).alias("_e")))
    return grouped.select(
        *keys, (F.col("t0") * ct).alias("t0"), (F.col("cy0") * cy).alias("y0"), (F.col("cx0") * cx).alias("x0"),
        F.array(F.lit(ct), F.lit(cy), F.lit(cx)).alias("shape"), dense_values("_e", ct * cy * cx).alias("values"))


def write_chunks(chunks: DataFrame, path: str, partition_by: Sequence[str] = ("variable",)) -> str:
    """S9 sink: a chunk store as Parquet partitioned by ``partition_by``."""
    chunks.hint("rebalance", *partition_by).write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return path


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """S10 source: a chunk store; a filter on its partition columns prunes folders."""
    return spark.read.parquet(path)


def chunks_to_cells(chunks: DataFrame, keys: Sequence[str], with_t: bool = False) -> DataFrame:
    """The inverse of ``cells_to_chunks`` (absent cells stay absent)."""
    ex = chunks.select(*keys, "t0", "y0", "x0", "shape", F.posexplode("values").alias("_p", "value"))
    cy, cx = F.col("shape")[1], F.col("shape")[2]
    plane = cy * cx
    out = ex.filter(F.col("value").isNotNull()).select(
        *keys, (F.col("t0") + (F.col("_p") / plane).cast("int")).alias("t"),
        (F.col("y0") + ((F.col("_p") % plane) / cx).cast("int")).alias("y"),
        (F.col("x0") + (F.col("_p") % cx)).alias("x"), "value")
    return out if with_t else out.drop("t")


# ---------------------------------------------------------------- S11 / U4 / W7
def concat_stores(stores: Sequence[DataFrame] | DataFrame, manifest: DataFrame | None = None,
                  keys: Sequence[str] = ("variable", "time", "y", "x"), store_col: str = "store",
                  tie: Sequence[str] = (), on_overlap: str = "last") -> DataFrame:
    """S11 + U4: union the stores of a manifest.  Where two stores hold the same
    cell (``keys``) the store later in the manifest wins, or, with
    ``on_overlap="error"``, the job fails naming the cell.

    ``stores``: a list of DataFrames (union by name, missing columns NULL) or
    one DataFrame with a ``store`` column; ``manifest``: (seq, store) order.  A
    store that the manifest lacks fails the job as well, so no cells are lost unseen."""
    if on_overlap not in ("last", "error"):
        raise ValueError(f"on_overlap is 'last' or 'error', not {on_overlap!r}")
    df = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), stores) \
        if isinstance(stores, (list, tuple)) else stores
    if manifest is not None:
        df = df.join(manifest.select("seq", store_col), store_col, "left").withColumn(
            "seq", F.when(F.col("seq").isNull(), F.raise_error(F.concat(
                F.lit("store not in the manifest: "), F.coalesce(F.col(store_col), F.lit("NULL")))).cast("bigint"))
            .otherwise(F.col("seq")))
    rest = [c for c in df.columns if c not in keys and c not in ("seq", *tie)]
    aggs = [F.max(F.struct("seq", *tie, *rest)).alias("_w")]
    if on_overlap == "error":
        aggs.append(F.count("*").alias("_n"))
    merged = df.groupBy(*keys).agg(*aggs)
    if on_overlap == "error":
        cell = F.concat_ws(", ", *(F.col(k).cast("string") for k in keys))
        merged = merged.filter(F.when(F.col("_n") > 1, F.raise_error(F.concat(
            F.lit("stores overlap at "), cell)).cast("boolean")).otherwise(F.lit(True)))
    return merged.select(*keys, *[F.col(f"_w.{c}").alias(c) for c in ("seq", *tie, *rest)])


def reindex_time(cells: DataFrame, by: Sequence[str] = ("variable",), time: str = "time",
                 out: str = "t") -> DataFrame:
    """0-based index of each time step within ``by`` after concatenation.

    The ranking runs over the *distinct* time steps (one row per step), then
    joins back - so no window ever holds all cells of a variable."""
    steps = cells.select(*by, time).distinct()
    from pyspark.sql import Window
    ranked = steps.withColumn(out, (F.dense_rank().over(Window.partitionBy(*by).orderBy(time)) - 1).cast("int"))
    return cells.join(ranked, [*by, time])

