"""Object copy jobs: S16 (prefix copy), S17 (prefix download), S22 (staging).

The plan (which object goes where) is a DataFrame built with Column
functions; the byte transfer runs in the executors with ``mapInPandas``,
one object at a time through ``pyarrow.fs`` (local, HDFS or object stores,
whatever the URI names).  A failed object is recorded, never fatal.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcat.functions.uris import prefix_rewrite, relative_key

COPY_RESULT = "src string, dst string, ok boolean, error string, bytes long"


def plan_prefix_copy(files: DataFrame, src_bucket: str, src_prefix: str, dst_bucket: str, dst_prefix: str,
                     scheme: str = "s3") -> DataFrame:
    """S16 plan: every object below ``src_prefix`` goes to the same relative
    place below ``dst_prefix`` (X11, anchored at the start)."""
    sel = files.filter((F.col("bucket") == src_bucket) & F.col("key").startswith(src_prefix)
                       & ~F.col("key").endswith("/"))
    return sel.select(
        F.concat(F.lit(f"{scheme}://"), F.col("bucket"), F.lit("/"), F.col("key")).alias("src"),
        F.concat(F.lit(f"{scheme}://{dst_bucket}/"), prefix_rewrite("key", src_prefix, dst_prefix)).alias("dst"))


def plan_download(files: DataFrame, prefix: str, target_root: str, scheme: str = "s3") -> DataFrame:
    """S17 plan: mirror the objects below ``prefix`` under ``target_root`` at
    their path relative to the prefix (X12).  A missing prefix is an empty plan."""
    sel = files.filter(F.col("key").startswith(prefix) & ~F.col("key").endswith("/"))
    return sel.select(
        F.concat(F.lit(f"{scheme}://"), F.col("bucket"), F.lit("/"), F.col("key")).alias("src"),
        F.concat(F.lit(target_root.rstrip("/") + "/"), relative_key("key", prefix)).alias("dst"))


def _copy_partition(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    from gridcat.sources.fs import open_fs

    cache: dict = {}

    def resolve(uri: str):
        return open_fs(uri, cache)

    for pdf in batches:
        ok, err, size = [], [], []
        for src, dst in zip(pdf["src"], pdf["dst"]):
            try:
                sfs, spath = resolve(src)
                dfs, dpath = resolve(dst)
                parent = dpath.rsplit("/", 1)[0]
                if parent:
                    dfs.create_dir(parent, recursive=True)
                n = 0
                with sfs.open_input_stream(spath) as r, dfs.open_output_stream(dpath) as w:
                    while True:
                        buf = r.read(8 << 20)
                        if not buf:
                            break
                        w.write(buf)
                        n += len(buf)
                ok.append(True), err.append(None), size.append(n)
            except Exception as e:  # recorded per object; the job goes on
                ok.append(False), err.append(f"{type(e).__name__}: {e}"), size.append(0)
        yield pd.DataFrame({"src": pdf["src"], "dst": pdf["dst"], "ok": ok, "error": err, "bytes": size})


def copy_objects(plan: DataFrame, parallelism: int | None = None) -> DataFrame:
    """Copy every ``(src, dst)`` of a plan; returns one row per object
    with ``ok``, ``error`` and the bytes copied.  The plan rows are tiny but
    the work per row is not, so they are spread over an explicit number of
    tasks (AQE does not coalesce a repartition by number); each task streams
    its objects in 8 MiB pieces.  Re-running a task rewrites the same
    targets, so a lost executor only repeats its own copies."""
    n = parallelism or plan.sparkSession.sparkContext.defaultParallelism * 4
    return plan.select("src", "dst").repartition(n).mapInPandas(_copy_partition, COPY_RESULT)
