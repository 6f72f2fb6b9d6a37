"""From a failure log to classified failures and incident contexts."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from tidegate.functions import as_now, contains_any


@dataclass(frozen=True)
class FailureKind:
    failure_type: str
    component: str
    keywords: tuple[str, ...]
    recoverable: bool = True


# Failure kinds and their keywords, tried from top to bottom.
FAILURE_KINDS = (
    FailureKind("kafka_failure", "kafka", ("kafka", "broker", "topic", "timeout")),
    FailureKind("redis_failure", "redis", ("redis", "connection refused")),
    FailureKind("checkpoint_failure", "checkpoint", ("checkpoint", "offset log")),
    FailureKind(
        "output_write_failure",
        "parquet_sink",
        ("parquet", "filesystem", "permission denied", "write"),
    ),
    FailureKind("spark_query_failure", "spark", ("streamingquery", "spark", "py4j")),
)
UNKNOWN_FAILURE = FailureKind("unknown_failure", "pipeline", (), recoverable=False)
DEFAULT_MESSAGE = "Pipeline health threshold exceeded"
UNKNOWN_STATUS = "unknown"
# End of fixed values.

CONTEXT_FIELDS = (
    "exception_message",
    "failure_type",
    "failed_topic",
    "failed_batch_id",
    "failed_records",
    "quarantine_rate",
    "retry_attempts",
    "latest_checkpoint",
    "redis_status",
    "kafka_status",
    "collected_at",
)


def _kind(kind: FailureKind) -> Column:
    return F.struct(
        F.lit(kind.failure_type).alias("failure_type"),
        F.lit(kind.component).alias("component"),
        F.lit(kind.recoverable).alias("recoverable"),
    )


def classify_failures(
    log: DataFrame, kinds: tuple[FailureKind, ...] = FAILURE_KINDS
) -> DataFrame:
    """Adds ``failure_type``, ``component`` and ``recoverable`` to a log of exceptions.

    The log has ``exception_class`` and ``message``; the first kind with a keyword in either wins.
    """
    text = F.lower(F.concat(F.col("exception_class"), F.lit(": "), F.coalesce("message", F.lit(""))))
    chain = _kind(UNKNOWN_FAILURE)
    for kind in reversed(kinds):
        chain = F.when(contains_any(text, kind.keywords), _kind(kind)).otherwise(chain)
    return log.withColumn("_kind", chain).select(*log.columns, "_kind.*")


def incident_contexts(
    failures: DataFrame, *, now: Column | datetime | str | None = None
) -> DataFrame:
    """One flat row of evidence per failure, with defaults where the metadata is silent."""

    def entry(name: str) -> Column:
        return F.try_element_at(F.col("metadata"), F.lit(name))

    def number(name: str, kind: str) -> Column:
        return F.coalesce(entry(name).try_cast(kind), F.lit(0).cast(kind))

    collected = F.col("detected_at") if now is None else as_now(now)
    return failures.select(
        F.col("message").alias("exception_message"),
        "failure_type",
        entry("topic").alias("failed_topic"),
        entry("batch_id").try_cast("bigint").alias("failed_batch_id"),
        number("failed_records", "bigint").alias("failed_records"),
        number("quarantine_rate", "double").alias("quarantine_rate"),
        number("retry_attempts", "bigint").alias("retry_attempts"),
        entry("checkpoint").alias("latest_checkpoint"),
        F.coalesce(entry("redis_status"), F.lit(UNKNOWN_STATUS)).alias("redis_status"),
        F.coalesce(entry("kafka_status"), F.lit(UNKNOWN_STATUS)).alias("kafka_status"),
        collected.alias("collected_at"),
    )


def _input_bounds() -> list[tuple[str, Column]]:
    rate = F.col("quarantine_rate")
    return [
        ("failed_records", F.col("failed_records") < 0),
        ("quarantine_rate", (rate < 0) | (rate > 1)),
        ("retry_attempts", F.col("retry_attempts") < 0),
    ]


def with_bound_errors(inputs: DataFrame) -> DataFrame:
    """Adds ``out_of_bounds``: the names of the given values that lie outside their range."""
    broken = [
        F.when(F.coalesce(outside, F.lit(False)), F.lit(name)) for name, outside in _input_bounds()
    ]
    return inputs.withColumn("out_of_bounds", F.array_compact(F.array(*broken)))


def accepted_inputs(inputs: DataFrame) -> DataFrame:
    """Incident inputs within bounds, gaps filled with their defaults."""
    good = with_bound_errors(inputs).where(F.size("out_of_bounds") == 0).drop("out_of_bounds")
    return good.fillna(
        {
            "exception_message": DEFAULT_MESSAGE,
            "failed_records": 0,
            "quarantine_rate": 0.0,
            "retry_attempts": 0,
            "redis_status": UNKNOWN_STATUS,
            "kafka_status": UNKNOWN_STATUS,
        }
    )


def rejected_inputs(inputs: DataFrame) -> DataFrame:
    return with_bound_errors(inputs).where(F.size("out_of_bounds") > 0)
