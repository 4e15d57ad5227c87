"""Job-record columns: error message, nested ids, status classes, payloads.

IDs: X20, X21, X22, X27.  Raw JSON strings are read with
``get_json_object`` / ``from_json`` and fixed schemas, never inferred.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Status classes of the catalog-job waiter (case-insensitive).
FAILED_STATES = ["failed", "deleted", "revoked"]
PENDING_STATES = ["accepted", "running", "queued"]
SUCCESS_STATES = ["succeeded"]


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def job_error_message(error_details, response_code) -> Column:
    """JSON ``message`` of the error details, else the raw text, else the
    response code, else ``Unknown error``."""
    d = _c(error_details)
    return F.coalesce(F.get_json_object(d, "$.message"), d, F.nullif(_c(response_code), F.lit("")),
                      F.lit("Unknown error"))


def job_task_id(record) -> Column:
    """``job_info.job_payload.payload_task_id`` with '' at any missing level."""
    return F.coalesce(F.get_json_object(_c(record), "$.job_info.job_payload.payload_task_id"), F.lit(""))


def status_class(status) -> Column:
    """``failed`` / ``pending`` / ``succeeded`` / ``unknown``."""
    s = F.lower(F.trim(_c(status)))
    return (F.when(s.isin(*FAILED_STATES), F.lit("failed"))
            .when(s.isin(*PENDING_STATES), F.lit("pending"))
            .when(s.isin(*SUCCESS_STATES), F.lit("succeeded"))
            .otherwise(F.lit("unknown")))


def unwrap_names(payload, outer: str = "layers", inner: str = "layer") -> Column:
    """The list inside ``{outer:{inner:[..]}}``, ``{outer:[..]}`` or a bare
    list, as array<struct<name>>; an empty array for anything else."""
    p = _c(payload)
    schema = "array<struct<name:string>>"
    return F.coalesce(
        F.from_json(F.get_json_object(p, f"$.{outer}.{inner}"), schema),
        F.from_json(F.get_json_object(p, f"$.{outer}"), schema),
        F.when(F.trim(p).startswith("["), F.from_json(p, schema)),
        F.array().cast(schema))
