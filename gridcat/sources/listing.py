"""Object listings and discovery: S1-S7, S12, S20, S22, X29, X30, W2, W3, U1.

A listing is the table ``files(bucket, key, size, modified)``.  Prefix
matches are turned into equi joins on the key's ancestor folders, so a
listing of billions of keys joins a job table without a cartesian product.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcat.functions.uris import parse_object_uri
from gridcat.session import scratch_dir
from gridcat.sources.fs import normalize_uri, open_fs


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ---------------------------------------------------------------- S1 / S5 / T2
_ENTRIES = "path string, is_file boolean, size long, modified timestamp"
_ENTRIES_A_BATCH = 10_000


def _list_folders(batches):
    """Entries directly inside each folder, in bounded batches."""
    import pandas as pd
    from pyarrow import fs as pafs

    for pdf in batches:
        for folder in pdf["path"]:
            fs, base = open_fs(folder)
            prefix = folder[: len(folder) - len(base)] if "://" in folder else ""
            found = fs.get_file_info(pafs.FileSelector(base, recursive=False, allow_not_found=True))
            for at in range(0, len(found), _ENTRIES_A_BATCH):
                part = [i for i in found[at:at + _ENTRIES_A_BATCH]
                        if i.type in (pafs.FileType.File, pafs.FileType.Directory)]
                yield pd.DataFrame({
                    "path": [prefix + i.path for i in part], "is_file": [i.type == pafs.FileType.File for i in part],
                    "size": [i.size if i.size is not None else 0 for i in part],
                    "modified": pd.to_datetime([i.mtime for i in part], utc=True).tz_localize(None)})


def list_objects(spark: SparkSession, root: str, glob: str | None = None, with_path: bool = False) -> DataFrame:
    """Every object below ``root`` (all pages; folders skipped) as
    ``files(bucket, key, size, modified)``.  Hidden names such as Zarr's
    ``.zmetadata`` are objects too (Spark's file sources would skip them).

    Folders are listed level by level inside the executors (``pyarrow.fs``),
    each level written to the shared folder and its sub-folders dealt anew, so no list
    of a tree is held by the driver or by one task.  ``glob`` (S5) filters on
    the file name; ``with_path`` keeps the full URI of each object."""
    base = scratch_dir(spark, f"listing-{uuid.uuid4().hex}")
    folders = spark.createDataFrame([(normalize_uri(root),)], "path string")
    level, levels = 0, []
    while True:
        path = f"{base}/level={level}"
        # a name is a few bytes, its folder may be large: a fixed number keeps AQE from merging the tasks
        folders.repartition(4 * spark.sparkContext.defaultParallelism, "path").mapInPandas(_list_folders, _ENTRIES).write.parquet(path)
        levels.append(path)
        folders = spark.read.schema(_ENTRIES).parquet(path).where("not is_file").select("path")
        if folders.isEmpty():
            break
        level += 1
    entries = spark.read.schema(_ENTRIES).parquet(*levels).where("is_file")
    rest = F.when(F.col("path").contains("://"), F.substring_index("path", "://", -1))
    bucket = F.coalesce(F.substring_index(rest, "/", 1), F.lit(""))
    key = F.coalesce(F.expr("substring(_rest, length(substring_index(_rest, '/', 1)) + 2)"), F.ltrim(F.col("path"), F.lit("/")))
    files = (entries.withColumn("_rest", rest).select(bucket.alias("bucket"), key.alias("key"), "size", "modified", "path")
             .filter(~F.col("key").endswith("/")))
    files = files if with_path else files.drop("path")
    return glob_filter(files, glob) if glob else files


def glob_to_regex(pattern: str) -> str:
    """Shell glob (``*``, ``?``, ``[..]``) -> anchored Java regex on a name."""
    out, i = [], 0
    while i < len(pattern):
        ch = pattern[i]
        if ch == "*":
            out.append("[^/]*")
        elif ch == "?":
            out.append("[^/]")
        elif ch == "[":
            j = pattern.find("]", i + 1)
            if j < 0:
                out.append(re.escape(ch))
            else:
                body = pattern[i + 1:j]
                out.append("[" + ("^" + body[1:] if body.startswith("!") else body) + "]")
                i = j
        else:
            out.append(re.escape(ch))
        i += 1
    return "^" + "".join(out) + "$"


def file_name(key) -> Column:
    return F.regexp_extract(_c(key), r"([^/]*)$", 1)


def glob_filter(files: DataFrame, pattern: str, key: str = "key") -> DataFrame:
    """S5 on a listing table: keep keys whose file name matches the glob."""
    return files.filter(file_name(key).rlike(glob_to_regex(pattern)))


def default_pattern(input_ext) -> Column:
    """The pattern chosen from the input extension (NetCDF by default)."""
    e = F.lower(_c(input_ext))
    return (F.when(e.isin(".zarr", "zarr"), F.lit("*.zarr"))
            .when(e.isin(".tif", ".tiff", "tif"), F.lit("*.tif"))
            .otherwise(F.lit("*.nc*")))


def file_format(key) -> Column:
    """Case-insensitive suffix test -> ``gpkg`` / ``zip`` / ``shp`` / NULL."""
    k = F.lower(_c(key))
    return (F.when(k.endswith(".gpkg"), F.lit("gpkg")).when(k.endswith(".zip"), F.lit("zip"))
            .when(k.endswith(".shp"), F.lit("shp")))


# ---------------------------------------------------------------- S2 / S3 / S4 / U1
def job_prefixes(jobs: DataFrame, result_uri: str = "result") -> DataFrame:
    """(job_id, bucket, prefix) of each job's object result, the prefix ending
    in ``/``; jobs without a result are dropped (S4)."""
    p = parse_object_uri(result_uri)
    prefix = p["key"]
    prefix = F.when((prefix == "") | prefix.endswith("/"), prefix).otherwise(F.concat(prefix, F.lit("/")))
    return (jobs.filter(F.col(result_uri).isNotNull() & p["error"].isNull())
            .select("job_id", p["bucket"].alias("bucket"), prefix.alias("prefix")))


def files_under_jobs(files: DataFrame, jobs: DataFrame) -> DataFrame:
    """Keys below each job's prefix - an equi join on (bucket, ancestor folder)
    instead of a ``startswith`` theta join.  Only ancestors at depths that occur
    among the jobs' prefixes are tried (their distinct depths are a handful), so no
    file is sent to a top folder that no job names; AQE splits a hot one."""
    depth = F.size(F.split("prefix", "/")) - 1
    depths = [r[0] for r in jobs.select(depth.alias("d")).distinct().collect()] or [0]
    folders = F.size(F.split("key", "/")) - 1
    cuts = [F.when(folders >= d, F.concat(F.substring_index("key", "/", d), F.lit("/" if d else ""))) for d in sorted(depths)]
    exploded = files.select("*", F.explode(F.array_compact(F.array(*cuts))).alias("prefix"))
    return exploded.join(jobs, ["bucket", "prefix"]).drop("prefix")


def outputs_by_suffix(files: DataFrame, jobs: DataFrame, ext: str) -> DataFrame:
    """S2 + U1: distinct ``s3://bucket/key`` URIs with the extension, over all jobs."""
    hits = files_under_jobs(files.filter(F.col("key").endswith(ext)), jobs)
    return hits.select(F.concat(F.lit("s3://"), "bucket", F.lit("/"), "key").alias("uri")).distinct()


def store_roots(files: DataFrame, jobs: DataFrame, ext: str = ".zarr") -> DataFrame:
    """S3: distinct parent folders whose name ends with ``ext`` (nested chunk
    folders do not match), per job: (job_id, uri)."""
    parent = F.regexp_extract("key", r"^(.*)/[^/]*$", 1)
    hits = files_under_jobs(files.withColumn("parent", parent).filter(F.col("parent").endswith(ext)), jobs)
    return hits.select("job_id", F.concat(F.lit("s3://"), "bucket", F.lit("/"), "parent").alias("uri")).distinct()


def expand_folders(requests: DataFrame, files: DataFrame, pattern: str = "*.nc*", uri: str = "input_s3") -> DataFrame:
    """S1 + S5 for folder inputs (X9 ``s3_folder``): one request per matching
    file below the folder, its ``input_s3`` the file; the folder goes along as
    ``folder``.  A folder without a match gives no row."""
    p = parse_object_uri(uri)
    asked = requests.select("*", p["bucket"].alias("bucket"), p["key"].alias("prefix")).withColumnRenamed(uri, "folder")
    hits = files_under_jobs(glob_filter(files, pattern).select("bucket", "key"), asked)
    return hits.withColumn(uri, F.concat(F.lit("s3://"), "bucket", F.lit("/"), "key")).drop("bucket", "key")


def granule_fields(records: DataFrame) -> DataFrame:
    """Name, first access URL and a violation message of granule search
    records (``schemas.GRANULE``); both fields are required."""
    g = F.col("Granule")
    first = F.get(g["OnlineAccessURLs"]["OnlineAccessURL"], F.lit(0))["URL"]
    missing = F.array_compact(F.array(F.when(g["GranuleUR"].isNull(), F.lit("GranuleUR")),
                                      F.when(first.isNull(), F.lit("OnlineAccessURL"))))
    return records.select("*", g["GranuleUR"].alias("granule_ur"), first.alias("url"), F.when(
        F.size(missing) > 0, F.concat(F.lit("missing: "), F.array_join(missing, ", "))).alias("violation"))


def pick_one(df: DataFrame, group: Sequence[str], by: str) -> DataFrame:
    """One deterministic row per group (smallest ``by``), with the count -
    a partial aggregate, so a hot group is combined map-side."""
    return df.groupBy(*group).agg(F.min(by).alias(f"first_{by}"), F.count("*").cast("bigint").alias("n"))


# ---------------------------------------------------------------- S6 / W2
def granule_lookup(requests: DataFrame, granules: DataFrame, keys: Sequence[str], seq: str = "seq") -> DataFrame:
    """S6 + W2 + L3: for each request the first granule by ``seq``, a flag
    when the search is ambiguous (more than one hit), and the hit count as a
    search limited to two would see it.  Requests without a hit stay (NULLs)."""
    rest = [c for c in granules.columns if c not in keys and c != seq]
    best = granules.groupBy(*keys).agg(
        F.min(F.struct(seq, *rest)).alias("_b"), F.count("*").alias("_n"))
    found = best.select(*keys, *[F.col(f"_b.{c}").alias(c) for c in rest],
                        (F.col("_n") > 1).alias("ambiguous"),
                        F.least(F.col("_n"), F.lit(2)).cast("bigint").alias("n_found"))
    return requests.join(found, list(keys), "left")


# ---------------------------------------------------------------- S7
def ftp_matches(lines: DataFrame, keywords: Sequence[str], line: str = "line") -> DataFrame:
    """A LIST line splits into at most 9 whitespace fields; keep the last
    field (the name, which may contain spaces) when it contains every keyword."""
    parts = F.split(F.ltrim(_c(line)), r"\s+", 9)
    name = F.element_at(parts, -1)
    cond = (F.size(parts) > 1)
    for k in keywords:
        cond = cond & name.contains(k)
    return lines.withColumn("name", name).filter(cond)


# ---------------------------------------------------------------- S20 / S22 / X29
# The three files a shapefile bundle must have.
SHAPEFILE_PARTS = [".shp", ".shx", ".dbf"]


def bundle_check(files: DataFrame, stem: str = "stem", ext: str = "ext", extra_aggs=()) -> DataFrame:
    """Per stem, the required shapefile parts that are missing.
    ``extra_aggs`` are computed in the same grouping (one shuffle)."""
    there = [F.max(F.lower(ext) == part).alias(f"_{i}") for i, part in enumerate(SHAPEFILE_PARTS)]
    absent = [F.when(~F.coalesce(F.col(f"_{i}"), F.lit(False)), F.lit(part)) for i, part in enumerate(SHAPEFILE_PARTS)]
    return (files.groupBy(stem).agg(*there, *extra_aggs)
            .withColumn("missing", F.array_sort(F.array_compact(F.array(*absent))))
            .drop(*(f"_{i}" for i in range(len(SHAPEFILE_PARTS)))))


def staged_key(prefix, collection_id, name) -> Column:
    """``prefix/collection/filename`` with outer slashes trimmed and empty
    parts dropped."""
    parts = F.array(F.regexp_replace(_c(prefix), "^/+|/+$", ""),
                    F.regexp_replace(_c(collection_id), "^/+|/+$", ""), _c(name))
    return F.array_join(F.filter(parts, lambda x: x.isNotNull() & (x != "")), "/")


def existence(keys: DataFrame, files: DataFrame, on: Sequence[str] = ("bucket", "key")) -> DataFrame:
    """Every candidate with an ``exists`` flag (left join on the listing)."""
    present = files.select(*on).distinct().withColumn("_hit", F.lit(True))
    return keys.join(present, list(on), "left").withColumn("exists", F.coalesce("_hit", F.lit(False))).drop("_hit")


# ---------------------------------------------------------------- S12
def write_manifest(stores: DataFrame, path: str, uri: str = "uri", order: str = "seq") -> None:
    """Store URIs as a manifest - one JSON line per store with its
    position, so the manifest is a table, not one driver-side list."""
    stores.select(F.col(order).alias("seq"), F.col(uri).alias("store_uri")).write.mode("overwrite").json(path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Read a manifest written by ``write_manifest``, or a JSON array of
    URIs (the original format) - both give (seq, store_uri)."""
    text = spark.read.text(path, wholetext=False)
    arr = F.from_json(F.col("value"), "array<string>")
    lines = F.from_json(F.col("value"), "seq int, store_uri string")
    as_array = text.filter(F.trim("value").startswith("[")).select(F.posexplode(arr).alias("seq", "store_uri"))
    as_lines = text.filter(F.trim("value").startswith("{")).select(lines.alias("m")).select("m.*")
    return as_array.select(F.col("seq").cast("int"), "store_uri").unionByName(as_lines)
