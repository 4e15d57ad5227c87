"""Structured Streaming forms of the waits and merges: T1-T5.

* T1 ``job_gate``          - one outcome per job: its first terminal status,
                             or ``timeout`` when none arrives within ``max_wait``
                             (``transformWithStateInPandas`` + event-time timers);
* T2 ``read_files``        - new files matching a glob, each file once: their rows with the
                             file's name (``with_file``) or running counts (``file_counts``);
* T3 ``upsert_batch_partitioned`` - idempotent continuous upsert of touched partitions;
* T4 ``product_gate``      - stream-stream join of products with job successes,
                             bounded in time on both sides; ``product_outcomes`` also
                             emits the products that no success reached in time;
* T5 ``dedupe_statuses``   - duplicates inside the watermark dropped.

Event time must be ``TIMESTAMP`` (watermarks reject ``TIMESTAMP_NTZ``), so the
inputs are cast on the way in and outputs cast back.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from functools import reduce
from operator import or_
from threading import Lock

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from gridcat.functions.jobs import FAILED_STATES, SUCCESS_STATES
from gridcat.operators.upsert import dedupe_last_wins
from gridcat.session import STATE_CONF


def to_event_time(df: DataFrame, col: str) -> DataFrame:
    return df.withColumn(col, F.col(col).cast("timestamp"))


def read_files(spark: SparkSession, path: str, schema: T.StructType, glob: str = "*.parquet",
               max_files: int | None = None) -> DataFrame:
    """A file stream over a folder, a glob or one file; the checkpoint
    records which files were taken, so every file is processed exactly once
    across restarts."""
    r = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(path)


_STARTING = Lock()


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Streams of ``spark`` started inside keep their state in RocksDB whatever the session's own provider:
    ``job_gate`` cannot run on another, and state stays off the heap.  A stream takes its settings when it starts
    and a checkpoint keeps the provider it began with, so the session's settings are put back afterwards; streams
    started by several threads start one after the other, so none puts them back under another."""
    with _STARTING:
        before = {k: spark.conf.get(k, None) for k in STATE_CONF}
        for k, v in STATE_CONF.items():
            spark.conf.set(k, v)
        try:
            yield
        finally:
            for k, v in before.items():
                if v is None:
                    spark.conf.unset(k)
                else:
                    spark.conf.set(k, v)


def run_available(writer, checkpoint: str, spark: SparkSession | None = None) -> None:
    """Run a stream over everything available now, its state in RocksDB, and wait for it.  ``spark`` is
    the session that the stream was made in, where that is not the active one."""
    with rocksdb_state(spark or SparkSession.active()):
        q = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


# ---------------------------------------------------------------- T5
def dedupe_statuses(statuses: DataFrame, watermark: str = "1 hour",
                    keys: Sequence[str] = ("job_id", "status"), ts: str = "ts") -> DataFrame:
    """T5: statuses older than the watermark are ignored; a repeat of the same
    (job, status) inside the watermark delay is dropped."""
    return statuses.withWatermark(ts, watermark).dropDuplicatesWithinWatermark(list(keys))


# ---------------------------------------------------------------- T1
GATE_SCHEMA = T.StructType([T.StructField("job_id", T.LongType()), T.StructField("outcome", T.StringType()),
                            T.StructField("ts", T.TimestampType())])
_STATE = T.StructType([T.StructField("first_us", T.LongType()), T.StructField("done", T.BooleanType())])


def first_and_terminal(pdfs: Iterator[pd.DataFrame]) -> tuple[int | None, tuple[int, str] | None]:
    """Running minima over the chunks of one job: its first time and its first
    terminal ``(time, status)``, ties by status.  Repeats and order do not matter,
    and no more than one chunk is held."""
    first, terminal = None, None
    ends = list(FAILED_STATES) + list(SUCCESS_STATES)
    for rows in pdfs:
        if not len(rows):
            continue
        us = rows["ts"].astype("datetime64[us]").astype("int64").to_numpy()
        first = int(us.min()) if first is None else min(first, int(us.min()))
        status = rows["status"].astype(str).str.strip().str.lower().to_numpy()
        over = np.isin(status, ends)
        if over.any():
            at = us[over].min()
            best = (int(at), min(status[over & (us == at)]))
            terminal = best if terminal is None else min(terminal, best)
    return first, terminal


class JobGate(StatefulProcessor):
    """T1's state per job: its first time and whether its outcome is out.

    One event-time timer at the deadline closes the gate: a job that is still open times
    out then, and either way its state is cleared, since no status up to the deadline can come
    once the watermark has passed it.  So state holds the jobs of the last ``max_wait`` plus
    the watermark delay, not every job ever seen."""

    def __init__(self, max_wait_us: int):
        self.max_wait_us = max_wait_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.gate = handle.getValueState("gate", _STATE)

    def _out(self, key, outcome: str, t_us: int) -> pd.DataFrame:
        return pd.DataFrame({"job_id": [key[0]], "outcome": [outcome], "ts": [pd.Timestamp(int(t_us), unit="us")]})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        first, terminal = first_and_terminal(rows)
        if first is None:
            return
        held = self.gate.get() if self.gate.exists() else None
        if held and held[1]:
            return  # the gate of this job is decided
        first_us = min(held[0], first) if held else first
        deadline = first_us + self.max_wait_us
        deadline_ms, watermark_ms = -(-deadline // 1000), timerValues.getCurrentWatermarkInMs()
        decided = terminal is not None or deadline_ms <= watermark_ms
        if terminal and terminal[0] <= deadline:
            yield self._out(key, "failed" if terminal[1] in FAILED_STATES else "succeeded", terminal[0])
        elif decided:
            yield self._out(key, "timeout", deadline)
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if deadline_ms <= watermark_ms:
            self.gate.clear()   # nothing of this run can come any more
        else:
            self.gate.update((first_us, decided))
            self.handle.registerTimer(deadline_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.gate.exists():
            first_us, done = self.gate.get()
            self.gate.clear()
            if not done:
                yield self._out(key, "timeout", first_us + self.max_wait_us)

    def close(self) -> None:
        pass


def job_gate(statuses: DataFrame, max_wait_hours: int = 48, watermark: str = "1 hour",
             ts: str = "ts") -> DataFrame:
    """Per job, the first terminal status (``failed``/``succeeded``)
    within ``max_wait`` of its first status, else ``timeout`` at the deadline,
    emitted when a later terminal status or the watermark shows it (see ``JobGate``).
    Repeated statuses change nothing, so no dedupe is needed before it (T5 stands on its own).
    Statuses of a job that come later than its deadline plus the watermark delay open
    a new run of that job."""
    return statuses.withWatermark(ts, watermark).groupBy("job_id").transformWithStateInPandas(
        JobGate(max_wait_hours * 3600 * 1_000_000), GATE_SCHEMA, "Append", "EventTime")


# ---------------------------------------------------------------- T2
def with_file(stream: DataFrame, column: str = "file") -> DataFrame:
    """The rows of a file stream with the name of the file each came in; the checkpoint takes
    every file once, so a row and its file come once however often the stream restarts."""
    return stream.select("*", F.col("_metadata.file_name").alias(column))


def file_counts(stream: DataFrame, key: str) -> DataFrame:
    """Running count per ``key`` over every file ingested so far."""
    return stream.groupBy(key).agg(F.count("*").cast("bigint").alias("n"))


# ---------------------------------------------------------------- T3
def _hadoop(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _has_success(spark: SparkSession, path: str) -> bool:
    fs, p = _hadoop(spark, f"{path}/_SUCCESS")
    return fs.exists(p)


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _hadoop(spark, path)
    return fs.exists(p)


def _drop(spark: SparkSession, path: str) -> None:
    fs, p = _hadoop(spark, path)
    fs.delete(p, True)


def with_bucket(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """Adds ``bucket``, the hash bucket of ``key``: a second partition column that
    splits a large collection, so that a batch rewrites only the buckets it touches."""
    return df.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))


SLICE_ROWS = 1 << 20     # rows that a slice of a partition holds, one file each


def partition_slices(rows: DataFrame, partition_by: Sequence[str], held: DataFrame | None = None) -> DataFrame:
    """How many slices of ``SLICE_ROWS`` each partition of ``rows`` takes together with the rows of
    ``held`` in it: (``partition_by``..., ``_slices``)."""
    n = rows.groupBy(*partition_by).agg(F.count("*").alias("_n"))
    if held is not None:
        n_held = held.groupBy(*partition_by).agg(F.count("*").alias("_n"))
        same = [n_held[c].eqNullSafe(n[c]) for c in partition_by]
        n = n_held.join(n, same, "left_semi").unionByName(n)
    return n.groupBy(*partition_by).agg(F.ceil(F.sum("_n") / SLICE_ROWS).cast("int").alias("_slices"))


def dedupe_by_partition(rows: DataFrame, slices: DataFrame, keys: Sequence[str], order: Sequence[str],
                        partition_by: Sequence[str]) -> DataFrame:
    """``dedupe_last_wins`` with the rows laid out as ``partition_by`` writes them, in one shuffle: by
    partition and, where one is large, by slices of its keys (``slices``, of ``partition_slices``; partitions
    that it does not name are left out).  A partition is written by as many tasks as it has slices, whose rows
    are in its order already."""
    parts, keys = list(partition_by), list(keys)
    s = slices.select(*[F.col(c).alias(f"_p{i}") for i, c in enumerate(parts)], "_slices")
    same = [F.col(c).eqNullSafe(F.col(f"_p{i}")) for i, c in enumerate(parts)]
    sliced = rows.join(s, same).select(*rows.columns, F.pmod(F.xxhash64(*keys), F.col("_slices")).alias("_slice"))
    laid = sliced.repartition(*parts, "_slice")
    by = list(dict.fromkeys([*parts, "_slice", *keys]))
    return dedupe_last_wins(laid, by, order).select(*rows.columns)


def _swap(spark: SparkSession, stage: str, live: str, partition_by: Sequence[str]) -> None:
    """Puts the partition folders of ``stage`` in the place of those of ``live``.  A swap that was cut short
    goes on with the folders still staged."""
    fs, to = _hadoop(spark, live)
    fs.mkdirs(to)
    path = spark._jvm.org.apache.hadoop.fs.Path
    for status in fs.globStatus(path("/".join([stage, *(f"{c}=*" for c in partition_by)]))) or []:
        staged, place = status.getPath(), live
        for name in str(staged.toString()).split("/")[-len(partition_by):]:
            place = f"{place}/{name}"
        target = path(place)
        fs.delete(target, True)
        fs.mkdirs(target.getParent())
        if not fs.rename(staged, target):
            raise OSError(f"cannot move {staged.toString()} to {place}")


def upsert_batch_partitioned(root: str, keys: Sequence[str], order: Sequence[str], partition_by: Sequence[str],
                             schema: T.StructType, fail_after_stage: Callable[[int], bool] | None = None):
    """T3 without rewriting the table: ``foreachBatch`` body for a live table
    at ``root/live`` partitioned by ``partition_by``, columns that follow from
    ``keys`` (e.g. the collection and a hash bucket of the id).

    1. the table's rows are counted by partition (from the files' footers); the partitions the batch
       touches are read, merged with the batch - newest by ``order`` wins per key - and written,
       partitioned as the table is, to a stage of this stream's own,
       ``root/_staging/<query id>/batch=<id>``: one shuffle and one write;
    2. the staged folders are moved into the place of exactly those partitions;
       the rows of untouched partitions are never read or written;
    3. the stage is dropped.

    The query id belongs to the checkpoint, so a second stream with a new
    checkpoint never meets the stages of the first.  A batch replayed after a crash
    in step 2 finds its stage complete and moves the folders that are left; one replayed after
    step 3 merges the same rows again - the same table either way.  Readers
    see each partition replaced whole, not a snapshot across partitions (that
    needs a table format with MERGE); one writer at a time.
    ``fail_after_stage(batch_id)`` lets a test crash between the steps."""
    live, cols = f"{root}/live", [f.name for f in schema.fields]
    partition_by = list(partition_by)

    def fn(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        query_id = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"
        stage = f"{root}/_staging/{query_id}/batch={batch_id:08d}"
        counts = f"{root}/_staging/{query_id}/slices={batch_id:08d}"
        if not _has_success(spark, stage):
            rows = batch.select(*cols)
            live_rows = spark.read.schema(schema).parquet(live).select(*cols) if _exists(spark, live) else None
            # written first: a row a partition, whose size is then known, so that the table is never shuffled to meet it
            slices = partition_slices(rows, partition_by, live_rows)
            slices.coalesce(1).write.mode("overwrite").parquet(counts)
            slices = spark.read.schema(slices.schema).parquet(counts)
            if live_rows is not None:
                # equal names prune the folders that are read; those of null names, which equal nothing, are read besides
                unnamed = live_rows.where(reduce(or_, [F.col(c).isNull() for c in partition_by]))
                rows = (live_rows.join(slices, partition_by, "left_semi").select(*cols)
                        .unionByName(unnamed).unionByName(rows))
            dedupe_by_partition(rows, slices, keys, order, partition_by).write.mode("overwrite") \
                .partitionBy(*partition_by).parquet(stage)
        if fail_after_stage and fail_after_stage(batch_id):
            raise RuntimeError("stopped between the stage and the swap")
        _swap(spark, stage, live, partition_by)
        _drop(spark, counts)
        _drop(spark, stage)
    return fn


# ---------------------------------------------------------------- T4
def product_gate(products: DataFrame, gates: DataFrame, bound_hours: int = 48,
                 watermark: str = "1 hour") -> DataFrame:
    """T4: products joined to their job's success, which must come within
    ``bound_hours`` after the product.  Watermarks on both sides and the time
    bound let Spark drop join state; a job has at most one gate row, so the
    join emits at most one row per product."""
    p = products.withWatermark("p_ts", watermark)
    g = gates.withWatermark("g_ts", watermark)
    cond = ((p["p_job_id"] == g["g_job_id"]) & (g["g_ts"] >= p["p_ts"])
            & (g["g_ts"] <= p["p_ts"] + F.expr(f"interval {bound_hours} hours")))
    return p.join(g, cond, "inner")


def product_outcomes(products: DataFrame, gates: DataFrame, bound_hours: int = 48,
                     watermark: str = "1 hour") -> DataFrame:
    """T4 with expiry: every product once, ``released`` with the time of the success that
    reached it within ``bound_hours``, or ``expired`` once none can.

    A left outer stream-stream join: the bound and both watermarks let Spark drop a
    product from the state, and dropping it unmatched emits it.  ``products``: (product_id,
    p_job_id, p_ts), repeats inside the watermark count once; ``gates``: (g_job_id, g_ts).  A
    product that may still be reached when the input ends stays in the state."""
    p = products.withWatermark("p_ts", watermark).dropDuplicatesWithinWatermark(["product_id"])
    g = gates.withWatermark("g_ts", watermark)
    cond = ((p["p_job_id"] == g["g_job_id"]) & (g["g_ts"] >= p["p_ts"])
            & (g["g_ts"] <= p["p_ts"] + F.expr(f"interval {bound_hours} hours")))
    return p.join(g, cond, "leftOuter").select(
        "product_id", F.col("p_job_id").alias("job_id"), "p_ts", "g_ts",
        F.when(F.col("g_ts").isNull(), "expired").otherwise("released").alias("outcome"))


# ---------------------------------------------------------------- S21 sink
SENT_SCHEMA = T.StructType([T.StructField("message_id", T.StringType()), T.StructField("payload", T.StringType()),
                            T.StructField("attempt", T.IntegerType()), T.StructField("sent", T.BooleanType()),
                            T.StructField("error", T.StringType()), T.StructField("batch", T.LongType())])


def _sent(send: Callable[[str, str], None], batch_id: int):
    """Task body that hands each message to ``send`` and reports what became of it.  A send that
    raises fails its message, never the task."""
    def run(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in pdfs:
            errors = []
            for message_id, payload in zip(pdf["message_id"], pdf["payload"]):
                try:
                    send(message_id, payload)
                    errors.append(None)
                except Exception as failure:  # whatever a transport raises is recorded
                    errors.append(f"{type(failure).__name__}: {failure}"[:500])
            yield pdf.assign(attempt=pdf["attempt"] + 1, sent=[e is None for e in errors],
                             error=pd.Series(errors, dtype=object, index=pdf.index), batch=batch_id)
    return run


def notification_batches(root: str, send: Callable[[str, str], None], max_attempts: int = 5):
    """``foreachBatch`` body that sends messages (``message_id``, ``payload``) and keeps a result
    row for each under ``root/results/query=<id>/batch=<id>``.

    A batch first takes the messages that the batch before left unsent (fewer than ``max_attempts``
    tries) and then its own; of messages with one id one is sent.  The results of a batch are one folder,
    written as a whole: a batch replayed after a crash finds it complete and sends nothing,
    one that crashed before it is complete sends again (at least once, ids tell repeats
    apart).  ``send`` runs in the tasks and must be picklable; a failing send fails no batch."""
    def fn(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        query_id = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"
        base = f"{root}/results/query={query_id}"
        path = f"{base}/batch={batch_id:010d}"
        if _has_success(spark, path):
            return
        todo = batch.select("message_id", "payload", F.lit(0).alias("attempt"))
        before = f"{base}/batch={batch_id - 1:010d}"
        if batch_id and _has_success(spark, before):
            left = spark.read.schema(SENT_SCHEMA).parquet(before).where(~F.col("sent") & (F.col("attempt") < max_attempts))
            todo = left.select("message_id", "payload", "attempt").unionByName(todo)
        once = todo.groupBy("message_id").agg(F.max(F.struct("attempt", "payload")).alias("m")).select(
            "message_id", "m.payload", "m.attempt")
        once.mapInPandas(_sent(send, batch_id), SENT_SCHEMA).write.mode("overwrite").parquet(path)
    return fn


def notification_results(spark: SparkSession, root: str) -> DataFrame:
    """What became of each message over all batches: the latest try, ``sent`` or not."""
    tries = spark.read.schema(SENT_SCHEMA).parquet(f"{root}/results/query=*/batch=*")
    last = tries.groupBy("message_id").agg(F.max(F.struct("sent", "attempt", "batch", "error")).alias("m"))
    return last.select("message_id", "m.sent", "m.attempt", "m.batch", "m.error")
