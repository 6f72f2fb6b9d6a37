"""Incident reports: component, cause, severity, steps and the report contract."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidegate.functions import contains_any, incident_id, percent
from tidegate.operators.triage import CONTEXT_FIELDS, DEFAULT_MESSAGE

# Report texts, thresholds and field names.
REDIS = ("Redis", "Redis is unavailable or timing out")
KAFKA = ("Kafka", "Kafka broker or topic connectivity is degraded")
CHECKPOINT = ("Spark checkpoint", "Checkpoint state is missing or inconsistent")
VALIDATION = ("Validation", "Incoming payload quality or schema compatibility regressed")
PARQUET_SINK = ("Parquet sink", "Output storage rejected or interrupted a write")
STREAMING = ("Streaming pipeline", "The available evidence is insufficient for a precise cause")

REDIS_DOWN = ("down", "fallback")
KAFKA_DOWN = ("down",)
REDIS_WORDS = ("redis",)
KAFKA_WORDS = ("kafka", "broker", "topic")
CHECKPOINT_WORDS = ("checkpoint",)
PARQUET_SINK_WORDS = ("parquet", "write", "filesystem")
KAFKA_ADVICE_WORDS = ("kafka",)
WRITE_ADVICE_WORDS = ("parquet", "write")
TITLE_END = " pipeline incident"
SUMMARY = "The streaming pipeline reported: %s. Retry attempts: %d; quarantine rate: %s."
RATE_LIMIT = 0.10
CRITICAL_RATE = 0.5
CRITICAL_ATTEMPTS = 5
HIGH_ATTEMPTS = 3

REDIS_STEPS = (
    "Keep the SQLite degraded-mode idempotency store enabled while Redis is restored.",
    "Verify Redis connectivity and memory pressure, then reconcile fallback event IDs.",
)
KAFKA_STEPS = (
    "Verify broker health, topic leaders, authentication, and network reachability.",
    "Restart the query from its last committed Kafka offsets after the broker stabilizes.",
)
CHECKPOINT_STEPS = (
    "Validate checkpoint commit/offset logs; archive only the affected query checkpoint if corrupt.",
)
RATE_STEPS = (
    "Compare quarantined payload versions with the active schema and pause incompatible producers.",
)
WRITE_STEPS = ("Check output permissions, capacity, and partial files before retrying the write.",)
DEFAULT_STEPS = (
    "Inspect the failing batch logs and retry the recoverable operation from checkpoint.",
)
ENGINE = "PySpark Structured Streaming"
PREVENTION_NOTES = (
    "Alert on dependency health and quarantine-rate changes before the failure threshold.",
    "Test checkpoint recovery and replay paths regularly with controlled fault injection.",
)
PROVIDER = "mock"
REQUIRED_REPORT_FIELDS = (
    "affected_components",
    "incident_title",
    "likely_root_cause",
    "prevention_notes",
    "recommended_recovery_steps",
    "severity",
    "summary",
)
OMITTED_FIELDS = "Incident provider omitted fields: "
# End of fixed values.


EVIDENCE = ("_exception", "_message", "_everything", "_rate", "_attempts", "_redis_down", "_kafka_down")


def with_evidence(contexts: DataFrame) -> DataFrame:
    """Adds the context as the rules read it, nulls and blanks replaced.

    As columns of their own the texts are put together once per row, not once per rule.
    """
    exception = F.coalesce(F.nullif(F.col("exception_message"), F.lit("")), F.lit(DEFAULT_MESSAGE))
    everything = F.concat_ws(" ", *[F.col(name).cast("string") for name in CONTEXT_FIELDS])
    read = contexts.withColumns(
        {
            "_exception": exception,
            "_everything": F.lower(everything),
            "_rate": F.coalesce(F.col("quarantine_rate"), F.lit(0.0)),
            "_attempts": F.coalesce(F.col("retry_attempts"), F.lit(0)),
            "_redis_down": F.coalesce(F.col("redis_status").isin(*REDIS_DOWN), F.lit(False)),
            "_kafka_down": F.coalesce(F.col("kafka_status").isin(*KAFKA_DOWN), F.lit(False)),
        }
    )
    return read.withColumn("_message", F.lower("_exception"))


def _finding(finding: tuple[str, str]) -> Column:
    return F.struct(F.lit(finding[0]).alias("component"), F.lit(finding[1]).alias("cause"))


def probable_cause() -> Column:
    """Component and cause: the first finding the evidence supports."""
    message = F.col("_message")
    findings = [
        (F.col("_redis_down") | contains_any(message, REDIS_WORDS), REDIS),
        (F.col("_kafka_down") | contains_any(message, KAFKA_WORDS), KAFKA),
        (contains_any(message, CHECKPOINT_WORDS), CHECKPOINT),
        (F.col("_rate") > RATE_LIMIT, VALIDATION),
        (contains_any(message, PARQUET_SINK_WORDS), PARQUET_SINK),
    ]
    chain = _finding(STREAMING)
    for holds, finding in reversed(findings):
        chain = F.when(holds, _finding(finding)).otherwise(chain)
    return chain


def severity() -> Column:
    critical = (F.col("_attempts") >= CRITICAL_ATTEMPTS) | (F.col("_rate") >= CRITICAL_RATE)
    high = (F.col("_attempts") >= HIGH_ATTEMPTS) | (F.col("_rate") > RATE_LIMIT)
    return F.when(critical, F.lit("critical")).when(high, F.lit("high")).otherwise(F.lit("medium"))


def found_steps() -> Column:
    """All advice that applies, looked for in every value of the context; empty if none does."""
    everything = F.col("_everything")
    advice = [
        (F.col("_redis_down") | contains_any(everything, REDIS_WORDS), REDIS_STEPS),
        (F.col("_kafka_down") | contains_any(everything, KAFKA_ADVICE_WORDS), KAFKA_STEPS),
        (contains_any(everything, CHECKPOINT_WORDS), CHECKPOINT_STEPS),
        (F.col("_rate") > RATE_LIMIT, RATE_STEPS),
        (contains_any(everything, WRITE_ADVICE_WORDS), WRITE_STEPS),
    ]
    return F.array_compact(
        F.array(*[F.when(holds, F.lit(step)) for holds, steps in advice for step in steps])
    )


def _texts(texts: tuple[str, ...]) -> Column:
    return F.array(*[F.lit(text) for text in texts])


def _triaged(contexts: DataFrame) -> DataFrame:
    found = with_evidence(contexts).withColumn("_finding", probable_cause())
    summary = F.format_string(SUMMARY, F.col("_exception"), F.col("_attempts"), percent(F.col("_rate")))
    return found.withColumns(
        {
            "component": F.col("_finding")["component"],
            "likely_root_cause": F.col("_finding")["cause"],
            "severity": severity(),
            "incident_title": F.concat(F.col("_finding")["component"], F.lit(TITLE_END)),
            "summary": summary,
        }
    )


def triage_incidents(contexts: DataFrame) -> DataFrame:
    """Adds component, cause, severity, title and summary to incident contexts."""
    return _triaged(contexts).drop("_finding", *EVIDENCE)


def incident_reports(contexts: DataFrame) -> DataFrame:
    """Full rule-based reports with their evidence; the id is a function of all of it."""
    key = incident_id(*[F.coalesce(F.col(name).cast("string"), F.lit("")) for name in CONTEXT_FIELDS])
    advised = _triaged(contexts).withColumn("_steps", found_steps())
    steps = F.when(F.size("_steps") > 0, F.col("_steps")).otherwise(_texts(DEFAULT_STEPS))
    return advised.select(
        key.alias("incident_id"),
        "incident_title",
        "severity",
        "summary",
        "likely_root_cause",
        F.array(F.col("component"), F.lit(ENGINE)).alias("affected_components"),
        steps.alias("recommended_recovery_steps"),
        _texts(PREVENTION_NOTES).alias("prevention_notes"),
        F.lit(PROVIDER).alias("provider"),
        F.col("collected_at").alias("created_at"),
        F.struct(*CONTEXT_FIELDS).alias("evidence"),
    )


def report_steps(reports: DataFrame) -> DataFrame:
    """One row per recommended step.

    No report is without a step. The outer form says so: the inner one would make Spark filter
    on the number of steps first, and work them out twice.
    """
    return reports.select(
        "incident_id", F.posexplode_outer("recommended_recovery_steps").alias("position", "step")
    )


def with_missing_fields(reports: DataFrame) -> DataFrame:
    """Adds ``missing_fields``: the required fields a report lacks, sorted; empty if complete."""
    missing = [
        F.when(F.col(name).isNull(), F.lit(name)) if name in reports.columns else F.lit(name)
        for name in REQUIRED_REPORT_FIELDS
    ]
    return reports.withColumn("missing_fields", F.array_compact(F.array(*missing)))


def omission_reason(missing: Column) -> Column:
    return F.concat(F.lit(OMITTED_FIELDS + "['"), F.array_join(missing, "', '"), F.lit("']"))


def reports_with_fallback(rule_based: DataFrame, external: DataFrame) -> DataFrame:
    """Prefer an external report of the same ``incident_id`` if it is complete.

    An incomplete one is replaced by the rule-based report, and the reason is kept. Of several
    external reports on one incident the most complete counts.
    """
    checked = with_missing_fields(external)
    order = Window.partitionBy("incident_id").orderBy(F.size("missing_fields"), "provider")
    best = checked.withColumn("_nth", F.row_number().over(order)).where("_nth = 1")
    offered = best.select(
        "incident_id",
        F.struct(*REQUIRED_REPORT_FIELDS, "provider").alias("_offer"),
        F.col("missing_fields").alias("_missing"),
    )
    joined = rule_based.join(offered, "incident_id", "left")
    usable = F.coalesce(F.size("_missing") == 0, F.lit(False))
    chosen = {
        name: F.when(usable, F.col("_offer")[name]).otherwise(F.col(name))
        for name in (*REQUIRED_REPORT_FIELDS, "provider")
    }
    reason = F.when(F.size("_missing") > 0, omission_reason(F.col("_missing")))
    return (
        joined.withColumns({**chosen, "provider_fallback_reason": reason})
        .drop("_offer", "_missing")
    )


def incident_table(reports: DataFrame) -> DataFrame:
    """Reports as flat rows: arrays and structs become JSON text."""
    nested = {
        field.name: F.to_json(field.name)
        for field in reports.schema.fields
        if field.dataType.typeName() in ("array", "struct", "map")
    }
    return reports.withColumns(nested)


def new_incidents(reports: DataFrame, stored: DataFrame) -> DataFrame:
    """Reports the incident table does not hold yet; ids follow from the evidence."""
    known = stored.select("incident_id").distinct()
    return reports.dropDuplicates(["incident_id"]).join(known, "incident_id", "left_anti")


def newest(rows: DataFrame, limit: int, *order: str) -> DataFrame:
    """The newest rows by the given columns; Spark keeps ``limit`` rows per task, not a sort."""
    return rows.orderBy(*[F.col(name).desc_nulls_last() for name in order]).limit(limit)


def newest_per_key(rows: DataFrame, keys: list[str], limit: int, *order: str) -> DataFrame:
    """The newest rows per key, cut to ``limit`` per key before the shuffle as well."""
    latest = Window.partitionBy(*keys).orderBy(*[F.col(name).desc_nulls_last() for name in order])
    return rows.withColumn("_nth", F.row_number().over(latest)).where(F.col("_nth") <= limit).drop("_nth")


def latest_incident(reports: DataFrame) -> DataFrame:
    return newest(reports, 1, "created_at", "incident_id")


def recent_incidents(reports: DataFrame, limit: int) -> DataFrame:
    return newest(reports, limit, "created_at", "incident_id")
