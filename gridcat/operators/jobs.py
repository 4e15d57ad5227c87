"""Job status: latest status per job and gating of products on their job.

IDs: W4, C11 (batch).  The streaming forms are in ``gridcat.streaming``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcat.functions.jobs import status_class


def latest_status(statuses: DataFrame, job: str = "job_id", status: str = "status", ts: str = "ts") -> DataFrame:
    """The newest status of every job (ties broken by the status text).
    ``max(struct(ts, status))`` aggregates map-side, so a job with millions
    of polls never lands whole in one task."""
    best = statuses.groupBy(job).agg(F.max(F.struct(ts, status)).alias("_l"), F.count("*").alias("n_polls"))
    return best.select(job, F.col(f"_l.{status}").alias(status), F.col(f"_l.{ts}").alias(ts),
                       status_class(F.col(f"_l.{status}")).alias("status_class"),
                       F.col("n_polls").cast("bigint").alias("n_polls"))


def gate_products(products: DataFrame, latest: DataFrame, job: str = "job_id") -> DataFrame:
    """C11: what to do with each product given its job's latest status:
    ``catalog`` when it succeeded, ``wait`` while pending, ``drop`` when the
    job failed (terminal, no retry), ``hold`` for an unknown or absent status."""
    j = products.join(latest.select(job, "status", "status_class"), job, "left")
    action = (F.when(F.col("status_class") == "succeeded", F.lit("catalog"))
              .when(F.col("status_class") == "pending", F.lit("wait"))
              .when(F.col("status_class") == "failed", F.lit("drop")).otherwise(F.lit("hold")))
    return j.withColumn("action", action)
