"""The registered queries: each operator over the whole of the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidegate.model import COORDINATES, EVENT_TYPES, LEDGER_TTL_SECONDS, RuleConfig
from tidegate.operators import (
    aggregate,
    dedup,
    incidents,
    ledger,
    metrics,
    quarantine,
    replay,
    retries,
    rules,
    transform,
    triage,
)
from tidegate.operators.parsing import drop_helpers, parse_events
from tidegate.plans import fixture, streams
from tidegate.plans.incident_job import IncidentJob
from tidegate.plans.fixture import EARLIER_NOW, NOW
from tidegate.plans.replay_job import ReplayJob
from tidegate.session import pin_utc, scratch_dir
from tidegate.sinks import messages
from tidegate.sinks.tables import write_batch
from tidegate.sources import wire
from tidegate.streaming.batches import BatchTables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
# How many rows the top-n reports ask for.
INDEX_PAGE, INCIDENT_PAGE, AUDIT_PAGE = 2_000, 1_000, 500


def query(build: Query) -> Query:
    """Register a query under its function name, with the session zone pinned."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(pin_utc(spark), sf_dir)

    QUERIES[build.__name__] = run
    return build


# -- shared inputs -------------------------------------------------------------------------


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wire.raw_envelope(fixture.wire_records(spark, sf_dir))


def checked(spark: SparkSession, sf_dir: str, now: str = NOW, config: RuleConfig = RuleConfig()) -> DataFrame:
    return rules.check_events(raw(spark, sf_dir), config=config, now=now)


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transform.transform_events(rules.valid_events(checked(spark, sf_dir)), now=NOW)


def deduped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.dedup_first(clean(spark, sf_dir))


def envelopes(spark: SparkSession, sf_dir: str, now: str = NOW) -> DataFrame:
    """Quarantined rows; each was set aside when it arrived."""
    invalid = rules.invalid_events(checked(spark, sf_dir, now))
    return quarantine.quarantine_envelope(invalid, now=F.col("kafka_timestamp"), keep=COORDINATES)


def retried_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows quarantined under an earlier clock, after 0 to 3 replays."""
    tries = (F.floor(F.col("source_offset") / 2) % 4).cast("int")
    return envelopes(spark, sf_dir, EARLIER_NOW).withColumn("retry_count", tries)


def decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay.decide_replay(retried_envelopes(spark, sf_dir), now=NOW)


def live_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.accepted_entries(fixture.ledger_log(spark, sf_dir))


def hour_number(ts: Column) -> Column:
    return F.floor(F.unix_timestamp(ts) / 3600)


def hourly_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters per source partition and hour of arrival."""
    batched = checked(spark, sf_dir).withColumns(
        {
            "query_id": F.concat(F.lit("stream-"), "source_partition"),
            "batch_id": hour_number(F.col("kafka_timestamp")),
        }
    )
    return metrics.batch_metrics(batched)


def contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return triage.incident_contexts(triage.classify_failures(fixture.failure_log(spark, sf_dir)))


def reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incidents.incident_reports(contexts(spark, sf_dir))


def external_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports from elsewhere for two thirds of the batches, half of them incomplete."""
    batch = F.col("evidence")["failed_batch_id"]
    given = reports(spark, sf_dir).where(batch % 3 != 2)
    whole = batch % 3 == 0
    return given.select(
        "incident_id",
        F.concat(F.lit("External: "), "incident_title").alias("incident_title"),
        F.when(whole, F.col("severity")).alias("severity"),
        F.when(whole, F.lit("external summary")).alias("summary"),
        "likely_root_cause",
        "affected_components",
        "recommended_recovery_steps",
        "prevention_notes",
        F.lit("external").alias("provider"),
    )


def rounded(windows: DataFrame, *more: str) -> DataFrame:
    """Windows with the mean taken from the sum in whole cents.

    Values have two decimals, so the sum has no rounding ties and every engine gives the same.
    """
    cents = F.round(F.col("average_event_value") * F.col("event_count"), 2)
    return windows.select(
        "window_start", "window_end", "event_type", "region", "source_system", "event_count",
        (cents / F.col("event_count")).alias("average_event_value"),
        "error_event_count", "window_date", *more,
    )


# -- sources, parsing, rules ---------------------------------------------------------------


@query
def raw_envelope(spark, sf_dir):
    return raw(spark, sf_dir)


@query
def parsed_events(spark, sf_dir):
    parsed = drop_helpers(parse_events(raw(spark, sf_dir)))
    return parsed.drop("raw_payload").withColumn("metadata", F.try_element_at("metadata", F.lit("k")))


@query
def validated_events(spark, sf_dir):
    return checked(spark, sf_dir).select(
        "source_partition", "source_offset", "event_id", *rules.ERROR_COLUMNS
    )


@query
def valid_split(spark, sf_dir):
    return checked(spark, sf_dir).groupBy("is_valid").agg(F.count("*").alias("records"))


@query
def error_breakdown(spark, sf_dir):
    counted = checked(spark, sf_dir).where(~F.col("is_valid"))
    return counted.groupBy("error_type", "failed_field", "error_message").agg(F.count("*").alias("records"))


RELAXED = RuleConfig.from_mapping(
    {
        "required_fields": ["event_id", "event_timestamp", "event_type", "region"],
        "allowed_event_types": [*EVENT_TYPES, "signup", "banner_hover"],
        "allowed_regions": ["us-east", "us-west", "eu-west"],
        "supported_payload_versions": ["1.0", "7.3"],
        "identity": {"require_user_or_device": False},
        "metadata": {"required": False},
        "event_value": {
            "numeric_when_present": True,
            "non_negative_event_types": ["page_view", "click", "sensor_reading", "heartbeat"],
        },
        "event_timestamp": {"future_tolerance_minutes": 60},
    }
)


@query
def rules_from_config(spark, sf_dir):
    judged = checked(spark, sf_dir, EARLIER_NOW, RELAXED)
    return judged.groupBy("error_type", "failed_field").agg(F.count("*").alias("records"))


@query
def rules_from_table(spark, sf_dir):
    """The allowed event types are a table: the mapped types of events worth more than 400."""
    names = fixture.events_table(spark, sf_dir).where("value > 400").select(
        F.when(F.col("event_type") == "view", F.lit("page_view"))
        .when(F.col("event_type") == "error", F.lit("error_event"))
        .otherwise(F.col("event_type"))
        .alias("event_type")
    )
    judged = rules.check_against_table(raw(spark, sf_dir), names, now=NOW)
    return judged.groupBy("error_type", "failed_field", "error_message").agg(F.count("*").alias("records"))


# -- clean rows, duplicates, windows -------------------------------------------------------


@query
def clean_events(spark, sf_dir):
    rows = clean(spark, sf_dir)
    return rows.drop("processed_at").withColumn("metadata", F.try_element_at("metadata", F.lit("k")))


@query
def processing_keys(spark, sf_dir):
    return clean(spark, sf_dir).select("event_id", "payload_version", "processing_key").distinct()


@query
def dedup_first(spark, sf_dir):
    return deduped(spark, sf_dir).select(
        "event_id", "source_partition", "source_offset", "event_timestamp", "ingestion_timestamp",
        "event_type", "region", "event_value",
    )


@query
def window_agg_5m(spark, sf_dir):
    return rounded(aggregate.aggregate_events(deduped(spark, sf_dir)))


@query
def window_agg_1h(spark, sf_dir):
    return rounded(aggregate.aggregate_events(deduped(spark, sf_dir), "1 hour"))


@query
def window_agg_1d(spark, sf_dir):
    return rounded(aggregate.aggregate_events(deduped(spark, sf_dir), "1 day"))


@query
def exact_unique_devices(spark, sf_dir):
    windows = aggregate.aggregate_events(deduped(spark, sf_dir), "1 day", exact_devices=True)
    return rounded(windows, "unique_device_count")


@query
def approx_unique_devices(spark, sf_dir):
    """Estimates beside exact counts: how many windows there are, and how many are within a fifth."""
    keys = ["window_start", "event_type", "region", "source_system"]
    rows = deduped(spark, sf_dir)
    near = aggregate.aggregate_events(rows, "1 day").select(*keys, F.col("unique_device_count").alias("near"))
    exact = aggregate.aggregate_events(rows, "1 day", exact_devices=True)
    both = near.join(exact, keys)
    close = F.abs(F.col("near") - F.col("unique_device_count")) <= F.greatest(F.col("unique_device_count") * 0.2, F.lit(1))
    return both.select(*keys, F.col("unique_device_count").alias("exact_count"), close.alias("estimate_is_near"))


@query
def replay_window_refresh(spark, sf_dir):
    """The hourly windows that replayed events fall into, over all clean rows."""
    before = dedup.dedup_first(
        transform.transform_events(rules.valid_events(checked(spark, sf_dir, EARLIER_NOW)), now=NOW)
    )
    added = replay.replayed_clean(
        decisions(spark, sf_dir), live_ledger(spark, sf_dir), now=NOW, ttl_seconds=LEDGER_TTL_SECONDS
    )
    states = aggregate.window_states(before, "1 hour")
    return rounded(aggregate.finished(aggregate.states_with(states, added, "1 hour")))


@query
def rollup_1h_from_5m(spark, sf_dir):
    """Hours merged from the states of five-minute windows."""
    states = aggregate.window_states(deduped(spark, sf_dir))
    return rounded(aggregate.finished(aggregate.merged_states(states, "1 hour")))


@query
def rollup_1d_from_5m(spark, sf_dir):
    """Days merged from five-minute windows, with exact device counts beside the merged sketches."""
    rows = deduped(spark, sf_dir)
    days = rounded(aggregate.finished(aggregate.merged_states(aggregate.window_states(rows), "1 day")), "unique_device_count")
    keys = ["window_start", *aggregate.GROUP_KEYS]
    exact = aggregate.aggregate_events(rows, "1 day", exact_devices=True).select(*keys, F.col("unique_device_count").alias("exact_count"))
    off = F.abs(F.col("unique_device_count") - F.col("exact_count"))
    near = off <= F.greatest(F.col("exact_count") * 0.05, F.lit(1))
    return days.join(exact, keys).withColumn("estimate_is_near", near).drop("unique_device_count")


@query
def late_rows(spark, sf_dir):
    """Every eleventh offset arrives two hours late; batches are hours of arrival."""
    delay = F.when(F.col("source_offset") % 11 == 0, 7200).otherwise(3)
    rows = clean(spark, sf_dir).select("event_id", "source_offset", "event_timestamp")
    arrived = rows.withColumn(
        "batch_id", hour_number(F.col("event_timestamp") + F.make_interval(secs=delay))
    )
    return dedup.late_rows(arrived).select(
        "event_id", "source_offset", "event_timestamp", "batch_id", "watermark"
    )


@query
def processed_at(spark, sf_dir):
    return clean(spark, sf_dir).select("event_id", "source_offset", "processed_at")


# -- messages ------------------------------------------------------------------------------


def _read_back(encoded: DataFrame, *fields: str) -> DataFrame:
    """Message keys next to fields read again from the JSON value."""
    names = [f.split(":")[0] for f in fields]
    schema = ", ".join(f"{name} {kind}" for name, kind in (f.split(":") for f in fields))
    value = F.from_json("value", schema).alias("v")
    return encoded.select("key", F.explode(F.array(value)).alias("v")).select(
        "key", *[F.col("v")[name].alias(name) for name in names]
    )


@query
def encode_clean(spark, sf_dir):
    encoded = messages.encode_clean(deduped(spark, sf_dir))
    return _read_back(
        encoded, "event_id:string", "user_id:string", "event_type:string", "event_value:double",
        "event_timestamp:timestamp", "event_date:date", "processing_key:string", "source_offset:bigint",
    )


@query
def encode_quarantine(spark, sf_dir):
    encoded = messages.encode_quarantine(envelopes(spark, sf_dir))
    return _read_back(
        encoded, "event_id:string", "original_payload:string", "error_type:string",
        "error_message:string", "failed_field:string", "replay_eligible:boolean", "retry_count:int",
    )


@query
def encode_aggregates(spark, sf_dir):
    encoded = messages.encode_aggregates(aggregate.aggregate_events(deduped(spark, sf_dir), "1 hour"))
    return _read_back(
        encoded, "window_start:timestamp", "window_end:timestamp", "event_type:string",
        "region:string", "source_system:string", "event_count:bigint", "window_date:date",
    )


# -- quarantine ----------------------------------------------------------------------------


@query
def quarantine_envelope(spark, sf_dir):
    return envelopes(spark, sf_dir).drop("processing_timestamp", "source_topic", "kafka_timestamp")


@query
def quarantine_latest(spark, sf_dir):
    newest = quarantine.newest_records(envelopes(spark, sf_dir), 100)
    return newest.select("event_id", "original_payload", "error_type", "failed_field")


@query
def quarantine_index(spark, sf_dir):
    """A page of the newest records."""
    newest = quarantine.newest_records(envelopes(spark, sf_dir), INDEX_PAGE)
    return newest.select("event_id", "original_payload", "error_type", "failed_field")


@query
def quarantine_ids(spark, sf_dir):
    return ledger.distinct_ids(envelopes(spark, sf_dir))


@query
def quarantine_stats(spark, sf_dir):
    return quarantine.quarantine_stats(envelopes(spark, sf_dir))


@query
def quarantine_index_stats(spark, sf_dir):
    """The same over a page of the newest records."""
    newest = quarantine.newest_records(envelopes(spark, sf_dir), INDEX_PAGE)
    return quarantine.quarantine_stats(newest)


@query
def quarantine_summary(spark, sf_dir):
    """Totals in one row, with the rate of all batches joined on."""
    totals = metrics.metric_totals(hourly_metrics(spark, sf_dir))
    whole = quarantine.quarantine_summary(envelopes(spark, sf_dir), totals)
    names = (rules.MALFORMED_JSON, rules.MALFORMED_TIMESTAMP, rules.QUALITY_RULE, rules.SCHEMA_VALIDATION)
    return whole.select(
        "indexed_records", "replay_eligible",
        *[F.coalesce(F.try_element_at("by_error_type", F.lit(name)), F.lit(0)).alias(name) for name in names],
        F.col("pipeline_quarantine_rate").alias("quarantine_rate"),
    )


# -- metrics -------------------------------------------------------------------------------


@query
def batch_metrics(spark, sf_dir):
    return hourly_metrics(spark, sf_dir)


@query
def quarantine_rate(spark, sf_dir):
    return metrics.metric_totals(hourly_metrics(spark, sf_dir))


@query
def rate_history(spark, sf_dir):
    history = metrics.rate_history(hourly_metrics(spark, sf_dir), chunk=100)
    return history.select(
        "query_id", "batch_id", "total_valid", "total_quarantined",
        "quarantine_rate", "breached", "alert",
    )


def _alerts(spark: SparkSession, sf_dir: str, threshold: float) -> DataFrame:
    return _alert_columns(metrics.rate_alerts(hourly_metrics(spark, sf_dir), threshold, chunk=100))


def _alert_columns(fired: DataFrame) -> DataFrame:
    return fired.select(
        "query_id", "batch_id", "failure_type", "message", "component", "recoverable",
        F.col("metadata")["invalid_records"].alias("invalid_records"),
        F.col("metadata")["total_records"].alias("total_records"),
    )


@query
def rate_alerts(spark, sf_dir):
    return _alerts(spark, sf_dir, 0.10)


@query
def rate_alerts_rearmed(spark, sf_dir):
    """A threshold the running rate crosses again and again."""
    return _alerts(spark, sf_dir, 0.45)


@query
def rate_incidents(spark, sf_dir):
    """Each alert as a triaged incident."""
    fired = metrics.rate_alerts(hourly_metrics(spark, sf_dir), 0.45, chunk=100)
    evidence = triage.incident_contexts(fired, now=F.timestamp_seconds(F.col("batch_id") * 3600))
    return incidents.triage_incidents(evidence).select(
        "exception_message", "failure_type", "component", "severity", "summary", "collected_at"
    )


@query
def run_status(spark, sf_dir):
    return metrics.run_status(fixture.status_log(spark, sf_dir))


# -- ledger --------------------------------------------------------------------------------


@query
def ledger_current(spark, sf_dir):
    return ledger.current_status(live_ledger(spark, sf_dir), NOW, ttl_seconds=LEDGER_TTL_SECONDS)


@query
def ledger_live(spark, sf_dir):
    return ledger.live_entries(live_ledger(spark, sf_dir), NOW)


@query
def ledger_reject_bad_status(spark, sf_dir):
    rejected = ledger.rejected_entries(fixture.ledger_log(spark, sf_dir))
    return rejected.select("event_id", "status", "reason", "updated_at")


@query
def ledger_claim(spark, sf_dir):
    return ledger.claim_outcomes(clean(spark, sf_dir), live_ledger(spark, sf_dir), NOW)


@query
def ledger_claimed_entries(spark, sf_dir):
    return ledger.claim(clean(spark, sf_dir), live_ledger(spark, sf_dir), now=NOW)


@query
def idempotent_gate(spark, sf_dir):
    admitted = ledger.idempotent_gate(
        deduped(spark, sf_dir), live_ledger(spark, sf_dir), NOW, ttl_seconds=LEDGER_TTL_SECONDS
    )
    return admitted.select("event_id", "event_timestamp", "source_offset")


@query
def ledger_purged(spark, sf_dir):
    return streams.purged_ledger(spark, live_ledger(spark, sf_dir))


@query
def compacted_clean(spark, sf_dir):
    return streams.compacted_clean(spark, sf_dir, deduped(spark, sf_dir))


@query
def gate_bucketed(spark, sf_dir):
    """The gate on a ledger stored by id."""
    name = f"ledger_{uuid.uuid4().hex[:12]}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    stored = ledger.store_bucketed(live_ledger(spark, sf_dir), name, scratch_dir(spark, "bucketed"), buckets)
    admitted = ledger.idempotent_gate(deduped(spark, sf_dir), stored, NOW, ttl_seconds=LEDGER_TTL_SECONDS)
    return admitted.select("event_id", "event_timestamp", "source_offset")


@query
def gate_duplicates(spark, sf_dir):
    return ledger.gate_duplicates(
        clean(spark, sf_dir), live_ledger(spark, sf_dir), NOW, ttl_seconds=LEDGER_TTL_SECONDS
    )


@query
def mark_quarantined(spark, sf_dir):
    return ledger.mark_quarantined(envelopes(spark, sf_dir), live_ledger(spark, sf_dir), now=NOW)


# -- replay --------------------------------------------------------------------------------


@query
def replay_decisions(spark, sf_dir):
    return decisions(spark, sf_dir).select(
        "source_partition", "source_offset", "event_id", "retry_count", "outcome", "reason", "destination"
    )


@query
def replay_failed_fields(spark, sf_dir):
    failed = decisions(spark, sf_dir).where("last_replay_at IS NOT NULL")
    return failed.select(
        "source_partition", "source_offset", "retry_count", "last_replay_error", "last_replay_at"
    )


@query
def replay_deferred(spark, sf_dir):
    deferred = replay.deferred_records(decisions(spark, sf_dir))
    return deferred.select("event_id", "original_payload", "retry_count", "last_replay_error", "next_attempt_at")


@query
def replay_due(spark, sf_dir):
    """Runs at once, one, two and six seconds later: a failed record is tried again when its time has come."""
    tables = BatchTables(spark, scratch_dir(spark, "replay-due"))
    records = envelopes(spark, sf_dir, EARLIER_NOW)
    start = datetime(2024, 2, 1, tzinfo=timezone.utc)
    write_batch(records, tables.path("quarantine"), start.date(), "arrived", 0)
    for seconds in (0, 1, 2, 6):
        job = ReplayJob(tables, f"{seconds}s", start + timedelta(seconds=seconds))
        job.record_decisions()
    decided = job.decisions_so_far()
    return decided.groupBy(F.col("query_id").alias("run"), "outcome", "retry_count").agg(F.count("*").alias("records"))


@query
def replay_publish(spark, sf_dir):
    sent = replay.replay_messages(decisions(spark, sf_dir))
    value = "event_id string, error_type string, retry_count int, _replay struct<retry_count:int, source:string>"
    parsed = F.from_json("value", value)
    note = F.get_json_object("value", "$.note.at.id").alias("note_id")
    return sent.select("topic", note, F.explode(F.array(parsed)).alias("v")).select(
        "topic",
        "note_id",
        F.col("v")["event_id"].alias("event_id"),
        F.col("v")["error_type"].alias("error_type"),
        F.col("v")["retry_count"].alias("record_retry_count"),
        F.col("v")["_replay"]["retry_count"].alias("audit_retry_count"),
        F.col("v")["_replay"]["source"].alias("audit_source"),
    )


@query
def replay_counts(spark, sf_dir):
    return replay.replay_counts(decisions(spark, sf_dir))


@query
def replay_run(spark, sf_dir):
    return replay.replay_run(decisions(spark, sf_dir), NOW)


@query
def replay_dry_run(spark, sf_dir):
    return replay.dry_run(decisions(spark, sf_dir))


@query
def dead_letters(spark, sf_dir):
    return replay.dead_letters(decisions(spark, sf_dir)).select(
        "source_partition", "source_offset", "event_id", "error_type", "retry_count", "reason"
    )


@query
def replayed_clean(spark, sf_dir):
    rows = replay.replayed_clean(
        decisions(spark, sf_dir), live_ledger(spark, sf_dir), now=NOW, ttl_seconds=LEDGER_TTL_SECONDS
    )
    return rows.select(
        "event_id", "source_offset", "event_timestamp", "ingestion_timestamp", "event_type", "region",
        "event_value", "event_date", "processing_key",
    )


# -- failures and incidents ----------------------------------------------------------------


@query
def failure_class(spark, sf_dir):
    failures = triage.classify_failures(fixture.failure_log(spark, sf_dir))
    return failures.drop("metadata")


@query
def incident_context(spark, sf_dir):
    return contexts(spark, sf_dir)


@query
def incident_triage(spark, sf_dir):
    return incidents.triage_incidents(contexts(spark, sf_dir)).select(
        "collected_at", "component", "likely_root_cause", "severity", "incident_title", "summary"
    )


@query
def incident_steps(spark, sf_dir):
    return incidents.report_steps(reports(spark, sf_dir))


@query
def incident_reports(spark, sf_dir):
    return incidents.incident_table(reports(spark, sf_dir)).drop("evidence")


@query
def incident_evidence(spark, sf_dir):
    flat = incidents.incident_table(reports(spark, sf_dir)).select(F.col("incident_id").alias("key"), F.col("evidence").alias("value"))
    return _read_back(
        flat, "exception_message:string", "failure_type:string", "failed_topic:string",
        "failed_batch_id:bigint", "failed_records:bigint", "quarantine_rate:double",
        "retry_attempts:bigint", "latest_checkpoint:string", "redis_status:string", "kafka_status:string",
    )


@query
def incident_contract(spark, sf_dir):
    checked_reports = incidents.with_missing_fields(external_reports(spark, sf_dir))
    return checked_reports.select("incident_id", F.array_join("missing_fields", ",").alias("missing_fields"))


@query
def incident_fallback(spark, sf_dir):
    chosen = incidents.reports_with_fallback(reports(spark, sf_dir), external_reports(spark, sf_dir))
    return chosen.select(
        "incident_id", "incident_title", "severity", "summary", "provider", "provider_fallback_reason"
    )


@query
def incident_latest(spark, sf_dir):
    latest = incidents.latest_incident(reports(spark, sf_dir))
    return latest.select("incident_id", "incident_title", "severity", "created_at")


@query
def incidents_recent(spark, sf_dir):
    """A page of the newest incidents."""
    return incidents.recent_incidents(reports(spark, sf_dir), INCIDENT_PAGE).select("incident_id", "severity", "created_at")


@query
def incidents_recent_per_type(spark, sf_dir):
    """The newest three per failure type."""
    rows = reports(spark, sf_dir).withColumn("failure_type", F.col("evidence")["failure_type"])
    newest = incidents.newest_per_key(rows, ["failure_type"], 3, "created_at", "incident_id")
    return newest.select("failure_type", "incident_id", "created_at")


@query
def incident_input_checked(spark, sf_dir):
    return triage.accepted_inputs(fixture.incident_inputs(spark, sf_dir))


@query
def incident_input_rejected(spark, sf_dir):
    rejected = triage.rejected_inputs(fixture.incident_inputs(spark, sf_dir))
    return rejected.select("input_id", F.array_join("out_of_bounds", ",").alias("out_of_bounds"))


@query
def backoff_schedule(spark, sf_dir):
    return retries.backoff_schedule(fixture.retry_log(spark, sf_dir))


@query
def retry_history(spark, sf_dir):
    return retries.retry_history(fixture.retry_log(spark, sf_dir))


@query
def audit_latest(spark, sf_dir):
    latest = retries.latest_audit(fixture.audit_log(spark, sf_dir), AUDIT_PAGE)
    return latest.withColumn("details", F.col("details")["event"])


@query
def incident_job(spark, sf_dir):
    """The job over the given logs, run three times: once, again, and under another run id."""
    measured = hourly_metrics(spark, sf_dir)
    measured = measured.withColumn("detected_at", F.timestamp_seconds(F.col("batch_id") * 3600))
    root, now = scratch_dir(spark, "incidents"), datetime(2024, 2, 1, tzinfo=timezone.utc)
    # Each run reads the counters twice; all events would be parsed for each time.
    measured.write.parquet(f"{root}/measured")
    measured = spark.read.schema(measured.schema).parquet(f"{root}/measured")
    for run_id in ("one", "one", "two"):
        job = IncidentJob(spark, root, run_id, now, threshold=0.45, chunk=100)
        job.run(measured, fixture.failure_log(spark, sf_dir))
    noted = job.audit().select(F.col("details")["incident_id"].alias("incident_id"), "success")
    stored = job.incidents().join(noted, "incident_id")
    return stored.select(
        F.get_json_object("evidence", "$.exception_message").alias("exception_message"),
        F.get_json_object("evidence", "$.failure_type").alias("failure_type"),
        "severity", "summary", "created_at", "success",
    )


# -- streams -------------------------------------------------------------------------------


@query
def stream_clean_equals_batch(spark, sf_dir):
    return streams.stream_clean(spark, sf_dir)


@query
def stream_agg_equals_batch(spark, sf_dir):
    return rounded(streams.stream_aggregates(spark, sf_dir))


@query
def stream_restart(spark, sf_dir):
    return streams.stream_quarantine(spark, sf_dir)


@query
def stream_lost_checkpoint_aggregates(spark, sf_dir):
    return rounded(streams.lost_checkpoint_aggregates(spark, sf_dir))


@query
def stream_lost_checkpoint_quarantine(spark, sf_dir):
    return streams.lost_checkpoint_quarantine(spark, sf_dir)


@query
def stream_gate_ttl(spark, sf_dir):
    return streams.gate_ttl(spark, sf_dir, deduped(spark, sf_dir))


@query
def stream_side_outputs(spark, sf_dir):
    return streams.side_outputs(spark, sf_dir)


@query
def stream_three_queries(spark, sf_dir):
    return streams.three_queries(spark, sf_dir)


@query
def stream_resumed_batch(spark, sf_dir):
    return streams.resumed_batch(spark, sf_dir)


@query
def stream_rate_alerts(spark, sf_dir):
    return _alert_columns(streams.rate_alert_stream(spark, hourly_metrics(spark, sf_dir), 0.45))


@query
def replay_published_once(spark, sf_dir):
    return streams.published_once(spark, envelopes(spark, sf_dir, EARLIER_NOW))


@query
def stream_generic_sinks(spark, sf_dir):
    return streams.generic_sinks(spark, sf_dir)


@query
def stream_checkpoint_reads(spark, sf_dir):
    return streams.checkpoint_reads(spark, sf_dir)
