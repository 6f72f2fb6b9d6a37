"""Quarantine envelopes and views of the quarantine table."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from tidegate.functions import as_now
from tidegate.operators.parsing import PARSED
from tidegate.operators.rules import MALFORMED_JSON

NEWEST_FIRST = ("processing_timestamp", "event_id", "original_payload")


def quarantine_envelope(
    invalid: DataFrame,
    *,
    now: Column | datetime | str | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """What was wrong, the untouched payload, and whether a replay makes sense.

    A replayed event that fails again carries its attempts inside the payload; they go on
    counting instead of starting at 0. ``keep`` names further columns to carry along.
    """
    attempts = F.col(PARSED)["event"]["_replay"]["retry_count"] if PARSED in invalid.columns else F.lit(None)
    return invalid.select(
        "event_id",
        F.col("raw_payload").alias("original_payload"),
        "error_type",
        "error_message",
        "failed_field",
        as_now(now).cast("string").alias("processing_timestamp"),
        (F.col("error_type") != MALFORMED_JSON).alias("replay_eligible"),
        F.coalesce(attempts.cast("int"), F.lit(0)).alias("retry_count"),
        *keep,
    )


def newest_records(quarantine: DataFrame, limit: int) -> DataFrame:
    """The newest records, as many as the caller asks for."""
    if limit < 1:
        raise ValueError("limit must be positive")
    return quarantine.orderBy(*[F.col(name).desc_nulls_last() for name in NEWEST_FIRST]).limit(limit)


def quarantine_stats(quarantine: DataFrame) -> DataFrame:
    """Records and replay-eligible records by error type, and a total row (null type)."""
    return quarantine.rollup("error_type").agg(
        F.grouping("error_type").cast("int").alias("is_total"),
        F.count("*").alias("records"),
        F.count_if(F.col("replay_eligible")).alias("replay_eligible"),
    )


def quarantine_summary(quarantine: DataFrame, totals: DataFrame) -> DataFrame:
    """The whole picture in one row: counts, a map by error type, and the rate of all batches.

    ``totals`` is the one-row frame of summed metrics holding ``quarantine_rate``.
    """
    per_type = quarantine.groupBy(F.coalesce("error_type", F.lit("unknown")).alias("error_type")).agg(
        F.count("*").alias("records"), F.count_if(F.col("replay_eligible")).alias("eligible")
    )
    counted = per_type.agg(
        F.coalesce(F.sum("records"), F.lit(0)).cast("long").alias("indexed_records"),
        F.coalesce(F.sum("eligible"), F.lit(0)).cast("long").alias("replay_eligible"),
        F.map_from_entries(F.collect_list(F.struct("error_type", "records"))).alias("by_error_type"),
    )
    both = counted.unionByName(
        totals.select(F.col("quarantine_rate").alias("pipeline_quarantine_rate")), allowMissingColumns=True
    )
    return both.agg(*[F.any_value(name, True).alias(name) for name in both.columns])
