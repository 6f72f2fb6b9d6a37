from tidegate.functions.scalars import (
    as_column,
    as_now,
    backoff_seconds,
    contains_any,
    event_time,
    incident_id,
    is_blank,
    percent,
    processing_key,
)

__all__ = [
    "as_column",
    "as_now",
    "backoff_seconds",
    "contains_any",
    "event_time",
    "incident_id",
    "is_blank",
    "percent",
    "processing_key",
]
