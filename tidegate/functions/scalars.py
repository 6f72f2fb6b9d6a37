"""Column helpers, all built from Spark's own functions."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, functions as F

DATE_PREFIX = r"^\d{4}-\d{2}-\d{2}"


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def as_now(now: Column | datetime | str | None) -> Column:
    """The clock as a Column: the batch's own time unless a fixed one is given."""
    if now is None:
        return F.current_timestamp()
    if isinstance(now, Column):
        return now
    if isinstance(now, datetime):
        aware = now if now.tzinfo else now.replace(tzinfo=timezone.utc)
        now = aware.isoformat()
    return F.lit(now).cast("timestamp")


def event_time(text: Column | str) -> Column:
    """Wire text to timestamp, null if unreadable.

    The prefix test keeps out a bare clock time, which a cast would place on today's date.
    """
    text = as_column(text)
    return F.when(text.rlike(DATE_PREFIX), F.try_to_timestamp(text))


def is_blank(text: Column | str) -> Column:
    text = as_column(text)
    return text.isNull() | (F.trim(text) == "")


def contains_any(text: Column, words: Iterable[str]) -> Column:
    """True if any word is a substring of an already lower-cased text."""
    return reduce(Column.__or__, [text.contains(word) for word in words])


def percent(rate: Column) -> Column:
    """Two decimals, halves to even."""
    return F.format_string("%.2f%%", F.bround(rate * 100, 2))


def processing_key(event_id: Column | str, version: Column | str) -> Column:
    return F.sha2(F.concat_ws("|", as_column(event_id), as_column(version)), 256)


def incident_id(*parts: Column) -> Column:
    """``inc-`` and the whole hash of the incident's evidence, so a rerun gives the same id."""
    return F.concat(F.lit("inc-"), F.sha2(F.concat_ws("|", *parts), 256))


def backoff_seconds(
    failed_attempt: Column | str, base_seconds: float = 2.0, max_seconds: float = 30.0
) -> Column:
    """Capped doubling: the base after the first failure, twice that after the second, ..."""
    exponent = F.greatest(F.lit(0), as_column(failed_attempt) - 1)
    return F.least(F.lit(float(max_seconds)), F.lit(float(base_seconds)) * F.pow(F.lit(2.0), exponent))
