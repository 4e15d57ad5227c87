"""Driver queries for the streaming operators.

Each query streams the given tables' own files (or, where rows have to be
reshaped first, a table written by all tasks at once) with ``availableNow``
into a file sink (never the driver-memory sink) and returns the sink as a
batch DataFrame.  Oracles are the equivalent batch SQL.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridcat.plans.q_catalog import DUCK_LI, ITEM_KEYS, ITEM_ORDER, _li_items
from gridcat.plans.registry import query
from gridcat.plans.views import table
from gridcat.session import scratch_dir
from gridcat.streaming import streams as ST

# batch form of T1 (first terminal status within 48 h of the first status, else timeout)
DUCK_GATE = """
, s as (select job_id, status, ts, lower(trim(status)) as ls from v_job_status),
f as (select job_id, min(ts) as first_ts, max(ts) as last_ts from s group by 1),
tt as (select job_id, min(ts) as term_ts from s where ls in ('failed', 'deleted', 'revoked', 'succeeded') group by 1),
tr as (select s.job_id, s.ts, case when s.ls = 'succeeded' then 'succeeded' else 'failed' end as outcome
       from s join tt on s.job_id = tt.job_id and s.ts = tt.term_ts),
w as (select max(ts) - interval 1 hour as wm from s),
gate as (
  select f.job_id,
         case when tr.ts is not null and tr.ts <= f.first_ts + interval 48 hours then tr.outcome else 'timeout' end
           as outcome,
         case when tr.ts is not null and tr.ts <= f.first_ts + interval 48 hours then tr.ts
              else f.first_ts + interval 48 hours end as ts
  from f left join tr on f.job_id = tr.job_id cross join w
  where (tr.ts is not null and tr.ts <= f.first_ts + interval 48 hours)
     or f.last_ts > f.first_ts + interval 48 hours or w.wm > f.first_ts + interval 48 hours)"""


EVENTS_SCHEMA = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
                              T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
                              T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType())])
_STATUS = """case event_type when 'click' then 'accepted' when 'signup' then 'queued' when 'view' then 'running'
                 when 'error' then 'Failed' else 'Succeeded' end"""


def _events(spark, sf):
    """The events table, a file or a folder of files, as a stream of its files."""
    return ST.to_event_time(ST.read_files(spark, f"{sf}/events.parquet*", EVENTS_SCHEMA), "ts")


def _statuses(spark, sf):
    return _events(spark, sf).select(F.col("user_id").alias("job_id"), F.expr(_STATUS).alias("status"), "ts")


def _run_gate(spark, sf, base: str) -> str:
    out = f"{base}/gate"
    gate = ST.job_gate(_statuses(spark, sf))
    ST.run_available(gate.writeStream.format("parquet").option("path", out).outputMode("append"), f"{base}/ckpt-gate", spark)
    return out


@query("stream_job_gate", "T1", views=["v_job_status"], oracle=DUCK_GATE + """
select job_id, outcome, ts from gate
""")
def stream_job_gate(spark, sf):
    base = scratch_dir(spark, f"stream-gate-{uuid.uuid4().hex}")
    out = _run_gate(spark, sf, base)
    return (spark.read.schema(ST.GATE_SCHEMA).parquet(out)
            .select("job_id", "outcome", F.col("ts").cast("timestamp_ntz").alias("ts")))


@query("stream_new_files", "T2 S5", oracle="""
select event_type, cast(count(*) as bigint) as n from events group by 1
""")
def stream_new_files(spark, sf):
    """The events' files are each taken once and the running counts per type are kept."""
    base = scratch_dir(spark, f"stream-files-{uuid.uuid4().hex}")
    stream = _events(spark, sf)
    out = f"{base}/counts"

    def sink(df, _batch_id):
        df.write.mode("overwrite").parquet(out)
    ST.run_available(ST.file_counts(stream, "event_type").writeStream.outputMode("complete").foreachBatch(sink),
                     f"{base}/ckpt", spark)
    return spark.read.parquet(out).select("event_type", "n")


@query("stream_file_rows", "T2 S5", oracle="""
select event_id, event_type, 'events.parquet' as file from events
""")
def stream_file_rows(spark, sf):
    """Every event once, with the name of the file that it came in, appended to a file sink; the stream
    runs twice over one checkpoint, and the second run finds nothing new."""
    base = scratch_dir(spark, f"stream-rows-{uuid.uuid4().hex}")
    for _ in range(2):
        rows = ST.with_file(_events(spark, sf)).select("event_id", "event_type", "file")
        ST.run_available(rows.writeStream.format("parquet").option("path", f"{base}/rows").outputMode("append"), f"{base}/ckpt", spark)
    return spark.read.parquet(f"{base}/rows")


LI_SCHEMA = T.StructType([T.StructField("collection_id", T.StringType()), T.StructField("item_id", T.StringType()),
                          T.StructField("side", T.StringType()), T.StructField("item_ts", T.TimestampNTZType()),
                          T.StructField("part", T.LongType()), T.StructField("supp", T.LongType()),
                          T.StructField("price", T.DoubleType()), T.StructField("qty", T.DoubleType()),
                          T.StructField("bucket", T.IntegerType())])
UPSERT_BUCKETS = 8


@query("stream_upsert", "T3", oracle=DUCK_LI.lstrip("\n, ").replace("li as", "with li as", 1) + """
select * from ex where not exists (select 1 from nw where nw.collection_id = ex.collection_id and nw.item_id = ex.item_id)
union all select * from nw
""")
def stream_upsert(spark, sf):
    """The catalog starts as the existing items, partitioned by collection and
    item bucket; new items arrive as files, two per micro-batch, and each batch
    rewrites only the partitions it touches.  The newest row per id wins, a
    new item over an existing one - the same table as ``item_upsert``,
    however the items are batched."""
    base = scratch_dir(spark, f"stream-upsert-{uuid.uuid4().hex}")
    li = ST.with_bucket(_li_items(spark, sf), "item_id", UPSERT_BUCKETS)
    order, parts = ["side", *ITEM_ORDER], ["collection_id", "bucket"]  # 'new' sorts after 'existing'
    merge = ST.upsert_batch_partitioned(f"{base}/table", ITEM_KEYS, order, parts, LI_SCHEMA)
    merge(li.filter(F.col("side") == "existing"), 0)  # into an empty table
    li.filter(F.col("side") == "new").repartition(4, "item_id").write.parquet(f"{base}/in")
    stream = ST.read_files(spark, f"{base}/in", LI_SCHEMA, max_files=2)
    ST.run_available(stream.writeStream.foreachBatch(merge), f"{base}/ckpt", spark)
    return spark.read.schema(LI_SCHEMA).parquet(f"{base}/table/live").select(*[f.name for f in LI_SCHEMA.fields[:-1]])


def _products_and_successes(spark, sf, gate_path):
    p = (_events(spark, sf).filter(F.col("event_type").isin("view", "click"))
         .select(F.col("event_id").alias("product_id"), F.col("user_id").alias("p_job_id"), F.col("ts").alias("p_ts")))
    g = (ST.read_files(spark, gate_path, ST.GATE_SCHEMA).filter(F.col("outcome") == "succeeded")
         .select(F.col("job_id").alias("g_job_id"), F.col("ts").alias("g_ts")))
    return p, g


@query("stream_product_gate", "T4 C11", views=["v_job_status"], oracle=DUCK_GATE + """
select e.event_id as product_id, e.user_id as job_id, e.ts as p_ts, g.ts as g_ts
from events e join gate g on e.user_id = g.job_id and g.outcome = 'succeeded'
     and g.ts >= e.ts and g.ts <= e.ts + interval 48 hours
where e.event_type in ('view', 'click')
""")
def stream_product_gate(spark, sf):
    """Products (view/click events of a job) are released when the job's gate
    (T1) reports success within 48 hours after the product: a stream-stream
    join with watermarks on both sides."""
    base = scratch_dir(spark, f"stream-pgate-{uuid.uuid4().hex}")
    p, g = _products_and_successes(spark, sf, _run_gate(spark, sf, base))
    joined = ST.product_gate(p, g).select("product_id", F.col("p_job_id").alias("job_id"), "p_ts", "g_ts")
    out = f"{base}/released"
    ST.run_available(joined.writeStream.format("parquet").option("path", out).outputMode("append"),
                     f"{base}/ckpt-join", spark)
    return (spark.read.parquet(out)
            .select("product_id", "job_id", F.col("p_ts").cast("timestamp_ntz").alias("p_ts"),
                    F.col("g_ts").cast("timestamp_ntz").alias("g_ts")))


@query("stream_product_outcomes", "T4 C11", views=["v_job_status"], oracle=DUCK_GATE + """
, p as (select event_id, user_id, ts from events where event_type in ('view', 'click')),
ok as (select job_id, ts from gate where outcome = 'succeeded'),
joined as (select p.event_id, p.user_id, p.ts as p_ts, g.ts as g_ts
           from p left join ok g on p.user_id = g.job_id and g.ts >= p.ts and g.ts <= p.ts + interval 48 hours),
passed as (select least((select max(ts) from p), (select max(ts) from ok)) - interval 1 hour as wm)
select event_id as product_id, user_id as job_id, p_ts, g_ts,
       case when g_ts is null then 'expired' else 'released' end as outcome
from joined, passed where g_ts is not null or p_ts + interval 48 hours < wm
""")
def stream_product_outcomes(spark, sf):
    """Every product (view/click event of a job): released by its job's success within 48
    hours, or expired once the watermark shows that none can come.  Products of the last
    48 hours of the stream are still open."""
    base = scratch_dir(spark, f"stream-outcomes-{uuid.uuid4().hex}")
    p, g = _products_and_successes(spark, sf, _run_gate(spark, sf, base))
    out = f"{base}/outcomes"
    ST.run_available(ST.product_outcomes(p, g).writeStream.format("parquet").option("path", out).outputMode("append"),
                     f"{base}/ckpt-outcomes", spark)
    return (spark.read.parquet(out).select("product_id", "job_id", F.col("p_ts").cast("timestamp_ntz").alias("p_ts"),
                                           F.col("g_ts").cast("timestamp_ntz").alias("g_ts"), "outcome"))


@query("stream_status_dedupe", "T5", views=["v_job_status"], oracle="""
select job_id, status, cast(1 as bigint) as n from v_job_status group by 1, 2
""")
def stream_status_dedupe(spark, sf):
    """Statuses with repeats dropped inside the watermark: each (job, status) pair comes
    through once (one micro-batch, so no repeat is older than the watermark)."""
    base = scratch_dir(spark, f"stream-dedupe-{uuid.uuid4().hex}")
    out = f"{base}/out"
    ST.run_available(ST.dedupe_statuses(_statuses(spark, sf)).writeStream.format("parquet").option("path", out)
                     .outputMode("append"), f"{base}/ckpt", spark)
    return spark.read.parquet(out).groupBy("job_id", "status").agg(F.count("*").cast("bigint").alias("n"))


def _refusing(message_id, payload):
    """A transport that refuses messages about errors."""
    if payload.startswith("error"):
        raise ValueError("refused")


@query("notification_sink", "S21", oracle="""
select 'event-' || cast(event_id as string) as message_id, event_type <> 'error' as sent,
       case when event_type = 'error' then 'ValueError: refused' end as error
from events
""")
def notification_sink(spark, sf):
    """One message per event, streamed in four files, one per micro-batch; every message has one
    result, and those that the transport refuses are recorded and tried again by later batches."""
    base = scratch_dir(spark, f"stream-notices-{uuid.uuid4().hex}")
    messages = table(spark, sf, "events").select(
        F.concat(F.lit("event-"), F.col("event_id").cast("string")).alias("message_id"),
        F.concat("event_type", F.lit(" of job "), F.col("user_id").cast("string")).alias("payload"))
    messages.repartition(4, "message_id").write.parquet(f"{base}/in")
    stream = ST.read_files(spark, f"{base}/in", messages.schema, max_files=1)
    ST.run_available(stream.writeStream.foreachBatch(ST.notification_batches(f"{base}/out", _refusing)), f"{base}/ckpt", spark)
    return ST.notification_results(spark, f"{base}/out").select("message_id", "sent", "error")
