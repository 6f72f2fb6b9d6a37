import json

import pytest
from pyspark.sql import functions as F

from tidegate.operators import incidents, retries, triage

CLASSIFIED = [
    ("KafkaTimeoutError", "x", "kafka_failure", "kafka", True),
    ("E", "the Broker is gone", "kafka_failure", "kafka", True),
    ("E", "unknown topic", "kafka_failure", "kafka", True),
    ("TimeoutError", "x", "kafka_failure", "kafka", True),
    ("E", "Redis ping", "redis_failure", "redis", True),
    ("E", "Connection refused", "redis_failure", "redis", True),
    ("E", "bad checkpoint", "checkpoint_failure", "checkpoint", True),
    ("E", "offset log gap", "checkpoint_failure", "checkpoint", True),
    ("E", "Parquet footer", "output_write_failure", "parquet_sink", True),
    ("E", "FileSystem closed", "output_write_failure", "parquet_sink", True),
    ("E", "permission denied", "output_write_failure", "parquet_sink", True),
    ("E", "rewrite", "output_write_failure", "parquet_sink", True),
    ("StreamingQueryException", "x", "spark_query_failure", "spark", True),
    ("SparkException", "x", "spark_query_failure", "spark", True),
    ("Py4JError", "x", "spark_query_failure", "spark", True),
    ("ValueError", "bad literal", "unknown_failure", "pipeline", False),
    ("ValueError", None, "unknown_failure", "pipeline", False),
    ("E", "redis write to topic", "kafka_failure", "kafka", True),
    ("E", "redis checkpoint", "redis_failure", "redis", True),
    ("E", "checkpoint write in spark", "checkpoint_failure", "checkpoint", True),
]


def test_classification(spark):
    log = spark.createDataFrame([(n, c[0], c[1]) for n, c in enumerate(CLASSIFIED)], "n int, exception_class string, message string")
    for row in triage.classify_failures(log).collect():
        assert (row.failure_type, row.component, row.recoverable) == CLASSIFIED[row.n][2:]


def contexts(spark, *changes):
    base = {
        "exception_message": "something", "failure_type": "x", "failed_topic": None, "failed_batch_id": None,
        "failed_records": 0, "quarantine_rate": 0.0, "retry_attempts": 0, "latest_checkpoint": None,
        "redis_status": "unknown", "kafka_status": "unknown", "collected_at": "2026-01-01 00:00:00",
    }
    schema = ("exception_message string, failure_type string, failed_topic string, failed_batch_id long, "
              "failed_records long, quarantine_rate double, retry_attempts long, latest_checkpoint string, "
              "redis_status string, kafka_status string, collected_at string")
    rows = [tuple({**base, **change}.values()) for change in changes]
    return spark.createDataFrame(rows, schema).withColumn("collected_at", F.col("collected_at").cast("timestamp"))


COMPONENTS = [
    ({"redis_status": "down"}, "Redis"),
    ({"redis_status": "fallback", "kafka_status": "down"}, "Redis"),
    ({"exception_message": "REDIS gone"}, "Redis"),
    ({"kafka_status": "down"}, "Kafka"),
    ({"exception_message": "no broker, checkpoint"}, "Kafka"),
    ({"exception_message": "Checkpoint lost", "quarantine_rate": 0.9}, "Spark checkpoint"),
    ({"quarantine_rate": 0.11, "exception_message": "write"}, "Validation"),
    ({"quarantine_rate": 0.10, "exception_message": "write"}, "Parquet sink"),
    ({"exception_message": "filesystem"}, "Parquet sink"),
    ({}, "Streaming pipeline"),
    ({"redis_status": "healthy", "kafka_status": "healthy"}, "Streaming pipeline"),
    ({"redis_status": None, "kafka_status": None, "quarantine_rate": None, "retry_attempts": None}, "Streaming pipeline"),
]
SEVERITIES = [
    ({"retry_attempts": 5}, "critical"),
    ({"quarantine_rate": 0.5}, "critical"),
    ({"retry_attempts": 4}, "high"),
    ({"retry_attempts": 3}, "high"),
    ({"quarantine_rate": 0.2}, "high"),
    ({"retry_attempts": 2, "quarantine_rate": 0.1}, "medium"),
    ({"exception_message": None}, "medium"),
]


@pytest.mark.parametrize("cases, column", [(COMPONENTS, "component"), (SEVERITIES, "severity")])
def test_triage(spark, cases, column):
    changes = [{**change, "failed_batch_id": n} for n, (change, _) in enumerate(cases)]
    for row in incidents.triage_incidents(contexts(spark, *changes)).collect():
        assert row[column] == cases[row.failed_batch_id][1], cases[row.failed_batch_id][0]


def test_report(spark):
    frame = contexts(
        spark,
        {"exception_message": "redis timed out at night", "redis_status": "fallback", "retry_attempts": 4, "quarantine_rate": 0.0475},
        {"exception_message": ""},
    )
    redis, blank = incidents.incident_reports(frame).orderBy("severity").collect()
    assert redis.severity == "high" and redis.affected_components[0] == "Redis"
    assert len(redis.recommended_recovery_steps) == 2 and redis.incident_id.startswith("inc-")
    assert len(redis.incident_id) == 68
    assert redis.summary == (
        "The streaming pipeline reported: redis timed out at night. Retry attempts: 4; quarantine rate: 4.75%."
    )
    assert "Pipeline health threshold exceeded" in blank.summary
    assert incidents.with_missing_fields(incidents.incident_reports(frame)).where("size(missing_fields) > 0").count() == 0
    again = incidents.incident_reports(frame).orderBy("severity").first()
    assert again.incident_id == redis.incident_id


def test_all_advice_that_applies(spark):
    frame = contexts(
        spark,
        {"failed_batch_id": 0, "failure_type": "redis_failure", "kafka_status": "down", "latest_checkpoint": "/checkpoints/clean",
         "quarantine_rate": 0.3, "exception_message": "write"},
        {"failed_batch_id": 1},
        {"failed_batch_id": 2, "redis_status": "healthy", "kafka_status": "healthy"},
    )
    steps = {row.evidence.failed_batch_id: row.recommended_recovery_steps for row in incidents.incident_reports(frame).collect()}
    assert [len(steps[n]) for n in range(3)] == [7, 1, 1]
    assert steps[1] == list(incidents.DEFAULT_STEPS)


def test_context_defaults_and_metadata(spark):
    log = spark.createDataFrame(
        [("m", "t", {"topic": "events.raw", "batch_id": "7", "quarantine_rate": "0.25", "failed_records": "x"}), ("n", "t", {})],
        "message string, failure_type string, metadata map<string,string>",
    ).withColumn("detected_at", F.lit("2026-01-01").cast("timestamp"))
    given, empty = triage.incident_contexts(log).orderBy("exception_message").collect()
    assert (given.failed_topic, given.failed_batch_id, given.quarantine_rate, given.failed_records) == ("events.raw", 7, 0.25, 0)
    assert (empty.failed_topic, empty.retry_attempts, empty.redis_status, empty.kafka_status) == (None, 0, "unknown", "unknown")


def test_incomplete_external_reports_are_replaced(spark):
    own = incidents.incident_reports(contexts(spark, *[{"failed_batch_id": n} for n in range(3)]))
    batch = F.col("evidence")["failed_batch_id"]
    whole = own.where(batch < 2).withColumn("provider", F.lit("external"))
    external = whole.withColumn("severity", F.when(batch == 0, F.col("severity"))).select(
        "incident_id", *incidents.REQUIRED_REPORT_FIELDS, "provider"
    )
    external = external.unionByName(external.where("severity IS NULL").withColumn("summary", F.lit(None).cast("string")))
    rows = {row.evidence.failed_batch_id: row for row in incidents.reports_with_fallback(own, external).collect()}
    assert len(rows) == 3
    assert [rows[n].provider for n in range(3)] == ["external", "mock", "mock"]
    assert rows[1].provider_fallback_reason == "Incident provider omitted fields: ['severity']"
    assert rows[1].severity == "medium"
    assert rows[0].provider_fallback_reason is None and rows[2].provider_fallback_reason is None


def test_incident_job_adds_nothing_twice(spark, tmp_path):
    import datetime as dt

    from tidegate.plans.incident_job import IncidentJob

    at = dt.datetime(2026, 1, 1, tzinfo=dt.timezone.utc)
    counts = [("q", 1, 90, 1, 0, at), ("q", 2, 0, 60, 0, at)]
    metrics = spark.createDataFrame(counts, "query_id string, batch_id long, valid long, quarantined long, duplicates long, detected_at timestamp")
    log = [("OSError", "Parquet footer lost", {"batch_id": "7"}, at), ("OSError", "Parquet footer lost", {"batch_id": "8"}, at)]
    failures = spark.createDataFrame(log, "exception_class string, message string, metadata map<string,string>, detected_at timestamp")
    for run_id in ("a", "a", "b"):
        job = IncidentJob(spark, str(tmp_path), run_id, at)
        job.run(metrics, failures)
    assert job.incidents().count() == 3 and job.audit().count() == 3
    assert {row.query_id for row in job.incidents().collect()} == {"incidents-a"}


def test_incident_table_is_flat(spark, tmp_path):
    own = incidents.incident_reports(contexts(spark, {"failed_topic": "events.raw"}))
    flat = incidents.incident_table(own)
    flat.write.parquet(str(tmp_path / "incidents"))
    back = spark.read.parquet(str(tmp_path / "incidents"))
    row = back.first()
    assert json.loads(row.affected_components)[1] == "PySpark Structured Streaming"
    assert json.loads(row.evidence)["failed_topic"] == "events.raw"


def test_latest_and_per_key(spark):
    frame = spark.createDataFrame([(n, n % 3) for n in range(50)], "created_at int, k int").withColumn("incident_id", F.lit("i"))
    assert incidents.latest_incident(frame).first().created_at == 49
    kept = incidents.newest_per_key(frame, ["k"], 2, "created_at").collect()
    assert sorted(row.created_at for row in kept) == [44, 45, 46, 47, 48, 49]


def test_input_bounds(spark):
    rows = [("ok", None, None, None), ("neg", -1, 0.5, 0), ("rate", 0, 1.5, 0), ("nan", 0, float("nan"), 0), ("edge", 0, 1.0, 0), ("two", -1, -0.1, 0)]
    frame = spark.createDataFrame(rows, "exception_message string, failed_records long, quarantine_rate double, retry_attempts long")
    frame = frame.withColumns({"redis_status": F.lit(None).cast("string"), "kafka_status": F.lit("down")})
    good = {row.exception_message: row for row in triage.accepted_inputs(frame).collect()}
    assert set(good) == {"ok", "edge"}
    assert (good["ok"].failed_records, good["ok"].quarantine_rate, good["ok"].redis_status) == (0, 0.0, "unknown")
    bad = {row.exception_message: row.out_of_bounds for row in triage.rejected_inputs(frame).collect()}
    assert bad == {"neg": ["failed_records"], "rate": ["quarantine_rate"], "nan": ["quarantine_rate"], "two": ["failed_records", "quarantine_rate"]}


def test_backoff_doubles_up_to_the_cap(spark):
    frame = spark.createDataFrame([(n,) for n in (0, 1, 2, 3, 10)], "attempt int").withColumn("timestamp", F.lit("2026-01-01").cast("timestamp"))
    delays = [row.delay_seconds for row in retries.backoff_schedule(frame, base_seconds=2, max_seconds=5).orderBy("attempt").collect()]
    assert delays == [2, 2, 4, 5, 5]
    first, second = [row.delay_seconds for row in retries.backoff_schedule(frame, base_seconds=1, max_seconds=10).where("attempt in (1, 2)").orderBy("attempt").collect()]
    assert (first, second) == (1.0, 2.0)


def test_retry_history(spark):
    frame = spark.createDataFrame([("start", 1, "a", 1), ("start", 2, "b", 2), ("stop", 1, "c", 3)], "operation string, attempt int, exception string, timestamp int")
    rows = {row.operation: (row.retries, row.max_attempt, row.last_exception) for row in retries.retry_history(frame).collect()}
    assert rows == {"start": (2, 2, "b"), "stop": (1, 1, "c")}


def test_audit_keeps_the_newest(spark):
    frame = spark.createDataFrame([(f"a{n}", n % 2 == 0, {"n": str(n)}) for n in range(600)], "action string, success boolean, details map<string,string>")
    audit = retries.audit_rows(frame, now=F.timestamp_seconds(F.col("details")["n"].cast("int")))
    kept = retries.latest_audit(audit, 500).collect()
    assert len(kept) == 500 and kept[0].action == "a599"


def test_only_new_incidents_are_added(spark):
    reports = incidents.incident_reports(contexts(spark, {"failed_batch_id": 1}, {"failed_batch_id": 1}, {"failed_batch_id": 2}))
    assert reports.count() == 3
    stored = reports.where(F.col("evidence")["failed_batch_id"] == 2)
    assert incidents.new_incidents(reports, stored).count() == 1


def test_percent_rounds_halves_to_even(spark):
    from tidegate.functions import percent

    frame = spark.createDataFrame([(0.40625,), (0.46875,), (0.0,), (1.0,), (0.02,)], "r double")
    assert [row.p for row in frame.select(percent(F.col("r")).alias("p")).collect()] == [
        f"{rate:.2%}" for rate in (0.40625, 0.46875, 0.0, 1.0, 0.02)
    ]


def test_incident_job_reads_counters_that_were_made_once(spark, sf_dir, monkeypatch):
    from tidegate.plans import queries

    plans = []

    class Noted(queries.IncidentJob):
        def run(self, metrics, failures, external=None):
            plans.append(metrics._jdf.queryExecution().optimizedPlan().toString())
            return super().run(metrics, failures, external)

    monkeypatch.setattr(queries, "IncidentJob", Noted)
    assert queries.QUERIES["incident_job"](spark, sf_dir).count() > 0
    assert len(plans) == 3 and not any("raw_payload" in plan or "get_json" in plan or "Aggregate" in plan for plan in plans)
