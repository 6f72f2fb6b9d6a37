"""Counters per batch, quarantine rates and rate alerts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidegate.functions import percent
from tidegate.model import METRIC_COUNTERS, QUARANTINE_RATE_THRESHOLD
from tidegate.operators.running import CHUNK, running_over_batches

# The failure a breached quarantine rate raises, and the status before any run.
RATE_FAILURE_TYPE = "excessive_quarantine_rate"
RATE_FAILURE_COMPONENT = "validation"
RATE_MESSAGE = "Quarantine rate %s exceeds %s"
NOT_STARTED = "not_started"
# End of fixed values.

BATCH_KEYS = ("query_id", "batch_id")
SECONDS_PER_DAY = 86_400


def quarantine_rate(invalid: Column, valid: Column) -> Column:
    """Invalid over all, 0 when there is nothing yet."""
    return F.coalesce(F.try_divide(invalid.cast("double"), (invalid + valid).cast("double")), F.lit(0.0))


def batch_metrics(checked: DataFrame, keys: Sequence[str] = BATCH_KEYS) -> DataFrame:
    """Valid, quarantined and duplicate rows of each batch of checked events.

    An id counts as valid in the first batch that brings it; further copies are duplicates.
    Rows shrink to one per id and batch before any window sees them, so neither a hot id nor
    the invalid rows pile up in one task.
    """
    per_id = checked.groupBy(
        *keys, "is_valid", F.when(F.col("is_valid"), F.col("event_id")).alias("_id")
    ).agg(F.count("*").alias("_rows"))
    apart = F.when(~F.col("is_valid"), F.struct(*keys))  # invalid rows have no id to be ranked by
    brought_first = Window.partitionBy("is_valid", "_id", apart).orderBy(*keys)
    ranked = per_id.withColumn("_first", F.row_number().over(brought_first) == 1)
    valid = F.when(F.col("is_valid") & F.col("_first"), 1).otherwise(0)
    return ranked.groupBy(*keys).agg(
        F.sum(valid).cast("long").alias("valid"),
        F.sum(F.when(~F.col("is_valid"), F.col("_rows")).otherwise(0)).cast("long").alias("quarantined"),
        F.sum(F.when(F.col("is_valid"), F.col("_rows") - valid).otherwise(0))
        .cast("long")
        .alias("duplicates"),
    )


def metric_totals(metrics: DataFrame, threshold: float = QUARANTINE_RATE_THRESHOLD) -> DataFrame:
    """One row: every counter summed, the last batch, the rate so far and whether it is too high."""
    counters = [name for name in METRIC_COUNTERS if name in metrics.columns]
    updated = [F.max("recorded_at").alias("last_updated")] if "recorded_at" in metrics.columns else []
    totals = metrics.agg(
        *[F.coalesce(F.sum(name), F.lit(0)).cast("long").alias(name) for name in counters],
        F.max("batch_id").alias("last_batch_id"),
        *updated,
    )
    rate = quarantine_rate(F.col("quarantined"), F.col("valid"))
    return totals.withColumn("quarantine_rate", rate).withColumn(
        "quarantine_rate_alerted", F.col("quarantine_rate") > threshold
    )


def timeline(metrics: DataFrame) -> DataFrame:
    """The stored counters of all queries in order of time, one step per second.

    Valid and quarantined rows are counted by different queries, whose batch numbers have
    nothing to do with each other; their common clock does. The result has the columns of
    batch metrics and fits ``rate_history`` with ``chunk=SECONDS_PER_DAY``.
    """
    counters = [F.sum(name).cast("long").alias(name) for name in METRIC_COUNTERS]
    return metrics.groupBy(
        F.lit("all").alias("query_id"), F.unix_seconds("recorded_at").alias("batch_id")
    ).agg(*counters)


def rate_history(
    metrics: DataFrame, threshold: float = QUARANTINE_RATE_THRESHOLD, *, chunk: int = CHUNK
) -> DataFrame:
    """Per batch the rate up to and with it, and whether an alert fires there.

    An alert fires when the rate first exceeds the threshold and is armed again once the rate
    is at or below it. The state before a batch follows from its totals minus its own counts.
    """
    running = running_over_batches(
        metrics,
        {"total_valid": (F.sum, "valid"), "total_quarantined": (F.sum, "quarantined")},
        keys=["query_id"],
        chunk=chunk,
    )
    now = quarantine_rate(F.col("total_quarantined"), F.col("total_valid"))
    before = quarantine_rate(
        F.col("total_quarantined") - F.col("quarantined"), F.col("total_valid") - F.col("valid")
    )
    return running.withColumns(
        {
            "quarantine_rate": now,
            "breached": now > threshold,
            "alert": (now > threshold) & ~(before > threshold),
        }
    )


def rate_alerts(
    metrics: DataFrame, threshold: float = QUARANTINE_RATE_THRESHOLD, *, chunk: int = CHUNK
) -> DataFrame:
    """The batches that raise a quarantine-rate failure, in the shape of a failure row."""
    return alert_rows(rate_history(metrics, threshold, chunk=chunk).where("alert"), threshold)


def alert_rows(fired: DataFrame, threshold: float = QUARANTINE_RATE_THRESHOLD) -> DataFrame:
    """Failure rows of batches with their running totals and rate."""
    total = F.col("total_valid") + F.col("total_quarantined")
    return fired.select(
        *BATCH_KEYS,
        F.lit(RATE_FAILURE_TYPE).alias("failure_type"),
        F.format_string(RATE_MESSAGE, percent(F.col("quarantine_rate")), F.lit(f"{threshold:.2%}")).alias("message"),
        F.lit(RATE_FAILURE_COMPONENT).alias("component"),
        F.lit(True).alias("recoverable"),
        F.create_map(
            F.lit("invalid_records"), F.col("total_quarantined").cast("string"),
            F.lit("total_records"), total.cast("string"),
            F.lit("quarantine_rate"), F.col("quarantine_rate").cast("string"),
        ).alias("metadata"),
    )


def run_status(log: DataFrame) -> DataFrame:
    """The latest row of a status log ``(status, at)``; one default row if it is empty."""
    latest = log.agg(F.max_by("status", "at").alias("status"), F.max("at").alias("at"))
    return latest.select(F.coalesce("status", F.lit(NOT_STARTED)).alias("status"), "at")
