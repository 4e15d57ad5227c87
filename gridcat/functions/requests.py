"""Ingest-request columns: type detection, step plans, rule checks, grid specs.

IDs: X8, X9, X10, X13, X14, X19, X23, X24.  A bad request is kept as a row
with a ``violations`` list instead of stopping the job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Step names and the default plan of each input type.
VALID_STEPS = ["stage", "netcdf2zarr", "concat", "zarr2cog", "catalog"]
DEFAULT_STEPS = {
    "daac": ["stage", "netcdf2zarr", "zarr2cog", "catalog"],
    "s3_netcdf": ["netcdf2zarr", "zarr2cog", "catalog"],
    "netcdf": ["netcdf2zarr", "zarr2cog", "catalog"],
    "s3_zarr": ["zarr2cog", "catalog"],
    "s3_gpkg": ["catalog"],
}


# part of a cell that a grid's size may exceed a whole number of cells by
SIZE_TOLERANCE = 1e-9


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def detect_input_type(granule_id, input_uri) -> Column:
    """``daac`` for a granule (not ``none``), else by the URI's ending;
    NULL when unsupported (``input_type_error`` says why)."""
    g, u = _c(granule_id), _c(input_uri)
    has_granule = g.isNotNull() & (F.length(g) > 0) & (g != "none")
    return (F.when(has_granule, F.lit("daac"))
            .when(u.isNull(), F.lit(None))
            .when(u.endswith(".nc") | u.endswith(".nc4"), F.lit("s3_netcdf"))
            .when(u.endswith(".zarr") | u.endswith(".zarr/"), F.lit("s3_zarr"))
            .when(u.endswith(".gpkg"), F.lit("s3_gpkg"))
            .when(u.endswith("/"), F.lit("s3_folder")))


def input_type_error(granule_id, input_uri) -> Column:
    t = detect_input_type(granule_id, input_uri)
    return F.when(t.isNull() & _c(input_uri).isNotNull(),
                  F.concat(F.lit("unsupported file type: "), _c(input_uri)))


def step_plan(steps, input_type) -> Column:
    """``all`` -> the default plan of the input type; otherwise the
    comma-separated list, trimmed (check it with ``invalid_steps``).  A folder
    (``s3_folder``) has no plan of its own: ``listing.expand_folders`` turns it
    into one request per file, each with the plan of its type."""
    s, t = _c(steps), _c(input_type)
    plans = F.create_map(*[x for k, v in DEFAULT_STEPS.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    explicit = F.transform(F.split(s, ","), lambda x: F.trim(x))
    return F.when(s == "all", F.try_element_at(plans, t)).otherwise(explicit)


def invalid_steps(plan) -> Column:
    return F.array_except(_c(plan), F.array(*map(F.lit, VALID_STEPS)))


def request_violations(granule_id, collection_id, input_uri) -> Column:
    """Rule checks as a list of messages (empty = valid)."""
    g, c, u = _c(granule_id), _c(collection_id), _c(input_uri)
    rules = [
        F.when(g.isNotNull() & (g != "") & (c.isNull() | (c == "")),
               F.lit("collection id is required with a granule id")),
        F.when(u.isNotNull() & ~u.startswith("s3://"), F.concat(F.lit("invalid object URL: "), u)),
    ]
    return F.filter(F.array(*rules), lambda x: x.isNotNull())


def missing_fields(fields: Sequence[str]) -> Column:
    """Names of the required columns that are NULL in this row."""
    return F.filter(F.array(*[F.when(F.col(f).isNull(), F.lit(f)) for f in fields]), lambda x: x.isNotNull())


def concept_id_or_collection(concept_id, collection_id) -> Column:
    """Concept id, falling back to the collection id when empty."""
    return F.coalesce(F.nullif(_c(concept_id), F.lit("")), _c(collection_id))


def selects_variable(variables, variable) -> Column:
    """``*`` (or no list) selects everything; otherwise the variable must
    be in the list (split on spaces and commas)."""
    v = _c(variables)
    names = F.filter(F.split(F.trim(v), "[ ,]+"), lambda x: x != "")
    return v.isNull() | (F.trim(v) == "*") | F.array_contains(names, _c(variable))


def parse_extent(extent) -> Column:
    """``min_lon min_lat max_lon max_lat`` (spaces or commas) -> struct
    with the four doubles and ``error`` (NULL when valid)."""
    parts = F.split(F.trim(_c(extent)), "[ ,]+")
    nums = [F.try_element_at(parts, F.lit(i)).try_cast("double") for i in range(1, 5)]
    x0, y0, x1, y1 = nums
    error = (F.when(F.size(parts) != 4, F.concat(F.lit("expected 4 fields, got "), F.size(parts).cast("string")))
             .when(x0.isNull() | y0.isNull() | x1.isNull() | y1.isNull(), F.lit("non-number field"))
             .when((x0 < -180) | (x0 > 180) | (x1 < -180) | (x1 > 180), F.lit("longitude outside [-180, 180]"))
             .when((y0 < -90) | (y0 > 90) | (y1 < -90) | (y1 > 90), F.lit("latitude outside [-90, 90]"))
             .when(x0 >= x1, F.lit("min longitude >= max longitude"))
             .when(y0 >= y1, F.lit("min latitude >= max latitude")))
    ok = error.isNull()
    return F.struct(F.when(ok, x0).alias("min_lon"), F.when(ok, y0).alias("min_lat"),
                    F.when(ok, x1).alias("max_lon"), F.when(ok, y1).alias("max_lat"), error.alias("error"))


def grid_spec(extent: Column, resolution=None, nx=None, ny=None) -> Column:
    """Grid from an extent struct and *either* a resolution (> 0) *or* a
    size (nx, ny).  A resolution gives as many cells as cover the extent, where a
    remainder within ``SIZE_TOLERANCE`` of a cell is rounding noise.  -> struct(min_lon, min_lat, max_lon, max_lat, res_x,
    res_y, nx, ny, error)."""
    res = _c(resolution) if resolution is not None else F.lit(None).cast("double")
    nxc = _c(nx) if nx is not None else F.lit(None).cast("int")
    nyc = _c(ny) if ny is not None else F.lit(None).cast("int")
    w = extent["max_lon"] - extent["min_lon"]
    h = extent["max_lat"] - extent["min_lat"]
    by_res = res.isNotNull()
    by_size = nxc.isNotNull() & nyc.isNotNull()
    error = (F.when(extent["error"].isNotNull(), extent["error"])
             .when(by_res & by_size, F.lit("resolution and size are exclusive"))
             .when(by_res & (res <= 0), F.lit("resolution must be > 0"))
             .when(by_size & ((nxc <= 0) | (nyc <= 0)), F.lit("size must be > 0"))
             .when(~by_res & ~by_size, F.lit("resolution or size required")))
    ok = error.isNull()
    cells = lambda span: F.greatest(F.lit(1), F.ceil(span / res - F.lit(SIZE_TOLERANCE)))
    out_nx = F.when(by_res, cells(w)).otherwise(nxc).cast("int")
    out_ny = F.when(by_res, cells(h)).otherwise(nyc).cast("int")
    return F.struct(
        *[F.when(ok, extent[k]).alias(k) for k in ("min_lon", "min_lat", "max_lon", "max_lat")],
        F.when(ok, F.when(by_res, res).otherwise(w / nxc)).alias("res_x"),
        F.when(ok, F.when(by_res, res).otherwise(h / nyc)).alias("res_y"),
        F.when(ok, out_nx).alias("nx"), F.when(ok, out_ny).alias("ny"), error.alias("error"))


# ---------------------------------------------------------------- staged forms
def with_extent(df: DataFrame, extent: str, out: str = "extent_parsed") -> DataFrame:
    """X23 as a DataFrame step: the split and the four numbers are columns of
    their own, so the rule checks reuse them instead of re-parsing the text
    in every branch (the Column form inlines the parse a dozen times)."""
    tmp = df.withColumn("_parts", F.split(F.trim(F.col(extent)), "[ ,]+"))
    tmp = tmp.withColumn("_nums", F.transform(F.slice("_parts", 1, 4), lambda p: p.try_cast("double")))
    x0, y0, x1, y1 = (F.try_element_at("_nums", F.lit(i)) for i in range(1, 5))
    tmp = tmp.withColumn("_xy", F.struct(x0.alias("x0"), y0.alias("y0"), x1.alias("x1"), y1.alias("y1")))
    x0, y0, x1, y1 = (F.col(f"_xy.{k}") for k in ("x0", "y0", "x1", "y1"))
    error = (F.when(F.size("_parts") != 4, F.concat(F.lit("expected 4 fields, got "),
                                                    F.size("_parts").cast("string")))
             .when(x0.isNull() | y0.isNull() | x1.isNull() | y1.isNull(), F.lit("non-number field"))
             .when((x0 < -180) | (x0 > 180) | (x1 < -180) | (x1 > 180), F.lit("longitude outside [-180, 180]"))
             .when((y0 < -90) | (y0 > 90) | (y1 < -90) | (y1 > 90), F.lit("latitude outside [-90, 90]"))
             .when(x0 >= x1, F.lit("min longitude >= max longitude"))
             .when(y0 >= y1, F.lit("min latitude >= max latitude")))
    tmp = tmp.withColumn("_err", error)
    ok = F.col("_err").isNull()
    return tmp.withColumn(out, F.struct(
        F.when(ok, x0).alias("min_lon"), F.when(ok, y0).alias("min_lat"), F.when(ok, x1).alias("max_lon"),
        F.when(ok, y1).alias("max_lat"), F.col("_err").alias("error"))).drop("_parts", "_nums", "_xy", "_err")


def with_grid_spec(df: DataFrame, extent: str, resolution=None, nx=None, ny=None,
                   out: str = "grid") -> DataFrame:
    """X24 as a DataFrame step over a parsed extent column (see ``with_extent``)."""
    tmp = df.withColumn("_ext", F.col(extent))
    return tmp.withColumn(out, grid_spec(F.col("_ext"), resolution, nx, ny)).drop("_ext")
