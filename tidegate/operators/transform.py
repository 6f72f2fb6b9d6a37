"""Valid events to analysis-ready rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from tidegate.functions import as_now, event_time, processing_key
from tidegate.operators.parsing import TIMES


def transform_events(valid: DataFrame, *, now: Column | datetime | str | None = None) -> DataFrame:
    """Typed timestamps, lower-case dimensions, ``event_date``, ``processed_at`` and the key."""
    if TIMES in valid.columns:
        event_ts, ingestion_ts = F.col(TIMES)["event"], F.col(TIMES)["ingestion"]
    else:
        event_ts, ingestion_ts = event_time("event_timestamp"), event_time("ingestion_timestamp")
    typed = valid.withColumns(
        {
            "event_timestamp": event_ts,
            "ingestion_timestamp": ingestion_ts,
            "event_type": F.lower("event_type"),
            "region": F.lower("region"),
            "event_value": F.col("event_value").try_cast("double"),
        }
    ).drop(TIMES)
    return typed.withColumns(
        {
            "event_date": F.to_date("event_timestamp"),
            "processed_at": as_now(now),
            "processing_key": processing_key("event_id", "payload_version"),
        }
    )
