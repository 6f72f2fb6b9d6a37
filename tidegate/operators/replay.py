"""Replay of quarantined records: decide, publish, re-enter, or give up."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from tidegate.functions import as_now, backoff_seconds
from tidegate.model import (
    COORDINATES,
    DEAD_LETTER_TOPIC,
    EVENT_FIELDS,
    MAX_REPLAY_ATTEMPTS,
    QUARANTINE_SCHEMA,
    RAW_TOPIC,
    REPLAY_TOPIC,
    RuleConfig,
)
from tidegate.operators.dedup import dedup_first
from tidegate.operators.ledger import idempotent_gate
from tidegate.operators.parsing import TIMES
from tidegate.operators.rules import MALFORMED_JSON, check_events
from tidegate.operators.transform import transform_events

# Reasons and outcomes of a replay, and the source named in a replayed payload.
NOT_ELIGIBLE = "record is not replay eligible"
EXHAUSTED = "maximum replay attempts exceeded"
BROKEN_PAYLOAD = "original payload is malformed"
STILL_INVALID = "payload still fails validation"
REPLAYABLE = "eligible and valid"
REPLAYED = "replayed"
DEAD_LETTERED = "dead_lettered"
DEFERRED = "deferred"
REPLAY_SOURCE = "quarantine"
# End of fixed values.

RECORD_FIELDS = tuple(QUARANTINE_SCHEMA.fieldNames())
# White space behind the object, and the audit an earlier replay left as its last member.
EARLIER_AUDIT = r'\s+$|,"_replay":\{[^{}]*\}(?=\}\s*$)'
AUDIT_START = ',"_replay":{'


def decide_replay(
    records: DataFrame,
    *,
    config: RuleConfig = RuleConfig(),
    now: Column | datetime | str | None = None,
    max_attempts: int = MAX_REPLAY_ATTEMPTS,
) -> DataFrame:
    """Judge quarantined records again and say where each one goes.

    Keeps the record's own columns (with the new attempt count and error where it failed),
    adds ``outcome``, ``reason``, ``destination`` and the message ``payload``, and carries the
    event parsed from the original payload in ``_event``.
    """
    clock = as_now(now)
    others = [name for name in records.columns if name not in RECORD_FIELDS]
    packed = records.select(
        F.col("original_payload").alias("raw_payload"),
        F.struct(*RECORD_FIELDS).alias("_record"),
        *others,
    )
    checked = check_events(packed, config=config, now=clock)

    attempts = F.coalesce(F.col("_record")["retry_count"], F.lit(0))
    eligible = F.coalesce(F.col("_record")["replay_eligible"], F.lit(False))
    reason = (
        F.when(~eligible, F.lit(NOT_ELIGIBLE))
        .when(attempts >= max_attempts, F.lit(EXHAUSTED))
        .when(F.col("error_type") == MALFORMED_JSON, F.lit(BROKEN_PAYLOAD))
        .when(~F.col("is_valid"), F.lit(STILL_INVALID))
        .otherwise(F.lit(REPLAYABLE))
    )
    retried = F.col("reason").isin(STILL_INVALID, REPLAYABLE)
    failed = F.col("reason") == STILL_INVALID
    outcome = (
        F.when(F.col("reason") == REPLAYABLE, F.lit(REPLAYED))
        .when(failed & (F.col("retry_count") < max_attempts), F.lit(DEFERRED))
        .otherwise(F.lit(DEAD_LETTERED))
    )
    event = F.struct(*[F.col(name) for name in EVENT_FIELDS], F.col(TIMES))
    judged = checked.select(
        F.col("_record"),
        event.alias("_event"),
        reason.alias("reason"),
        F.col("error_message").alias("_error"),
        attempts.alias("_attempts"),
        *others,
    )
    counted = judged.select(
        *[F.col("_record")[name].alias(name) for name in RECORD_FIELDS if name != "retry_count"],
        F.when(retried, F.col("_attempts") + 1).otherwise(F.col("_attempts")).alias("retry_count"),
        F.when(failed, F.col("_error")).alias("last_replay_error"),
        F.when(failed, clock).alias("last_replay_at"),
        "reason",
        "_event",
        *others,
    )
    placed = counted.withColumn("outcome", outcome).withColumn(
        "destination",
        F.when(F.col("outcome") == DEAD_LETTERED, F.lit(DEAD_LETTER_TOPIC)).otherwise(F.lit(REPLAY_TOPIC)),
    )
    return placed.withColumn("payload", _payload(clock))


def _payload(clock: Column) -> Column:
    """The original payload with an audit member if it is replayed, else the record as it now stands."""
    audit = F.struct(
        clock.alias("replayed_at"), F.col("retry_count"), F.lit(REPLAY_SOURCE).alias("source")
    )
    # A replayed payload is known to be one JSON object: everything in it stays as it was, and the
    # audit becomes its last member, in place of that of an earlier replay.
    # Most have none, and end in their brace: there the pattern cannot match, and is not tried at every place.
    text = F.col("original_payload")
    bare = text.endswith("}") & ~text.contains(AUDIT_START)
    whole = F.when(bare, text).otherwise(F.regexp_replace(text, EARLIER_AUDIT, ""))
    body = F.substring(whole, F.lit(1), F.length(whole) - 1)
    replayed = F.concat(body, F.lit(',"_replay":'), F.to_json(audit), F.lit("}"))
    record = F.struct(*RECORD_FIELDS, "last_replay_error", "last_replay_at")
    return F.when(F.col("outcome") == REPLAYED, replayed).otherwise(F.to_json(record))


def replay_messages(decisions: DataFrame) -> DataFrame:
    """One row per message: a replayed event goes to the replay topic and to the raw topic.

    Every decision has a topic; the outer explode spares Spark a filter that would prove it by
    judging each row twice.
    """
    topics = F.when(
        F.col("outcome") == REPLAYED, F.array(F.col("destination"), F.lit(RAW_TOPIC))
    ).otherwise(F.array(F.col("destination")))
    return decisions.select(
        F.explode_outer(topics).alias("topic"),
        F.lit(None).cast("string").alias("key"),
        F.col("payload").alias("value"),
    )


def replay_counts(decisions: DataFrame) -> DataFrame:
    """One row with the number of replayed, dead-lettered and deferred records."""
    return decisions.agg(
        *[F.count_if(F.col("outcome") == name).alias(name) for name in (REPLAYED, DEAD_LETTERED, DEFERRED)]
    )


def replay_run(decisions: DataFrame, now: Column | datetime | str | None = None) -> DataFrame:
    """The run record: when it finished and its counts."""
    return replay_counts(decisions).withColumn("completed_at", as_now(now))


def dry_run(decisions: DataFrame) -> DataFrame:
    """Where the records would go, without sending any."""
    return decisions.groupBy("destination").agg(F.count("*").alias("records"))


def dead_letters(decisions: DataFrame) -> DataFrame:
    return decisions.where(F.col("outcome") == DEAD_LETTERED).drop("_event")


def deferred_records(
    decisions: DataFrame, *, base_seconds: float = 2.0, max_seconds: float = 30.0
) -> DataFrame:
    """Records that stay in quarantine, with their new count and the time of the next attempt."""
    deferred = decisions.where(F.col("outcome") == DEFERRED)
    due = next_attempt("retry_count", "last_replay_at", base_seconds, max_seconds)
    return deferred.select(*RECORD_FIELDS, "last_replay_error", "last_replay_at", due.alias("next_attempt_at"))


def next_attempt(count: str, at: str, base_seconds: float = 2.0, max_seconds: float = 30.0) -> Column:
    """When a record that failed for the ``count``-th time ``at`` some time may be tried again."""
    return F.col(at) + F.make_interval(secs=backoff_seconds(count, base_seconds, max_seconds))


def due_minute(at: Column) -> Column:
    """The bucket of the index of waiting records."""
    return F.floor(F.unix_seconds(at) / 60).cast("long")


def due_records(waiting: DataFrame, now: Column | datetime | str | None = None) -> DataFrame:
    """Waiting records whose time has come. On an index partitioned by ``due_minute`` later buckets are not read."""
    clock = as_now(now)
    return waiting.where((F.col("due_minute") <= due_minute(clock)) & (F.col("next_attempt_at") <= clock))


def replayed_clean(
    decisions: DataFrame,
    ledger: DataFrame,
    *,
    now: Column | datetime | str | None = None,
    ttl_seconds: int | None = None,
) -> DataFrame:
    """Replayed events as clean rows. Where ledger entries live ``ttl_seconds``, older ones are not read.

    The decision already holds the parsed event and the verdict of every rule at the same
    clock, so nothing is parsed twice. A replay is a batch: the stream's watermark would drop
    these rows as late.
    """
    names = [name for name in COORDINATES if name in decisions.columns]
    events = decisions.where(F.col("outcome") == REPLAYED).select(
        F.col("original_payload").alias("raw_payload"), "_event.*", *names
    )
    clean = transform_events(events, now=now)
    order = [name for name in ("ingestion_timestamp", "source_partition", "source_offset") if name in clean.columns]
    return idempotent_gate(dedup_first(clean, [*order, "raw_payload"]), ledger, now, ttl_seconds=ttl_seconds)
