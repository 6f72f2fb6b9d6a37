"""Retry logs, the backoff schedule and the recovery audit."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from tidegate.functions import as_now, backoff_seconds
from tidegate.operators.incidents import newest


def backoff_schedule(
    attempts: DataFrame, *, base_seconds: float = 2.0, max_seconds: float = 30.0
) -> DataFrame:
    """Adds ``delay_seconds`` and ``next_attempt_at`` to rows with ``attempt`` and ``timestamp``."""
    delayed = attempts.withColumn("delay_seconds", backoff_seconds("attempt", base_seconds, max_seconds))
    wait = F.make_interval(secs=F.col("delay_seconds"))
    return delayed.withColumn("next_attempt_at", F.col("timestamp") + wait)


def retry_history(log: DataFrame) -> DataFrame:
    """Per operation: retries, highest attempt, and the last exception seen."""
    return log.groupBy("operation").agg(
        F.count("*").alias("retries"),
        F.max("attempt").alias("max_attempt"),
        F.max_by("exception", F.struct("timestamp", "attempt", "exception")).alias("last_exception"),
        F.max("timestamp").alias("last_at"),
    )


def audit_rows(
    actions: DataFrame, *, now: Column | datetime | str | None = None
) -> DataFrame:
    """Rows for the audit table from ``action``, ``success`` and a ``details`` map."""
    return actions.select("action", "success", as_now(now).alias("timestamp"), "details")


def latest_audit(audit: DataFrame, limit: int) -> DataFrame:
    return newest(audit, limit, "timestamp", "action")
