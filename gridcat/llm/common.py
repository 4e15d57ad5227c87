"""Helpers shared by the training-data operators."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TOKENIZER_FILE = "byte_bpe_50k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = TOKENIZER_FILE) -> str:
    """Path of a public vocabulary file installed on every node."""
    import public_tokenizers

    return public_tokenizers.path(name)


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under ``spark.checkpoint.dir``, which driver and
    executors share.  Where that is unset a temporary folder serves a
    ``local`` master; on a cluster it is an error, since machine-local folders
    would split the output between nodes."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="gridcat-llm-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write ``df`` to the shared folder and read it back, so a
    lost executor costs only the tasks it was running."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Texts:
    """The strings of an Arrow column, made one at a time, so that a batch of long texts is
    not held a second time as Python objects."""

    def __init__(self, column):
        self.column = column

    def __len__(self) -> int:
        return len(self.column)

    def __iter__(self) -> Iterator[str | None]:
        for value in self.column:
            yield value.as_py()


@contextlib.contextmanager
def worker_memory():
    """Around a task's work: gives what the allocators keep back to the system at the
    end, since Spark goes on using the Python worker for the tasks of later stages."""
    try:
        yield
    finally:
        import ctypes
        import gc

        import pyarrow as pa

        gc.collect()
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):     # a C library that has no such call
            ctypes.CDLL(None).malloc_trim(0)


def let(value: Column, body) -> Column:
    """Bind ``value`` once for use in ``body``: a lambda variable is evaluated
    a single time, whereas an inlined expression would be evaluated again for
    each element of the lambdas that mention it."""
    return F.transform(F.array(value), body)[0]
