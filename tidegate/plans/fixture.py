"""Wire records derived from the ``events`` table: sound payloads and every kind of defect.

Each field is a function of the row, so the same records can be restated in plain SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidegate.model import RAW_TOPIC

NOW = "2024-02-01T00:00:00Z"
EVENTS_SCHEMA = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
)
EARLIER_NOW = "2024-01-15T00:00:00Z"


#: Rows dealt to a task. A record costs some hundred microseconds, and a split of the narrow table holds millions.
TASK_ROWS = 50_000


def spread(table: DataFrame) -> DataFrame:
    """Deal the rows of an under-split scan to all cores, several rounds of them for a large table.

    A task's share then stays the same however large the table is, and however few row groups it has.
    """
    cores = table.sparkSession.sparkContext.defaultParallelism
    tasks = cores * max(-(-table.count() // (cores * TASK_ROWS)), 1)
    return table if table.rdd.getNumPartitions() >= tasks else table.repartition(tasks)


def events_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table with its zone-free time read as UTC."""
    table = spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir}/events.parquet")
    return table.withColumn("ts", F.col("ts").cast("timestamp"))


def _one_of(choices: tuple[str, ...], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(choice) for choice in choices]), index.cast("int") + 1)


# The JSON text of a row of ``events`` with a ``copy`` number. One SQL text is one call into the
# JVM; as a tree of Columns it would be some hundred.
PAYLOAD = """
concat('{', concat_ws(',',
  CASE WHEN event_id % 50 <> 2 THEN concat('"event_id":"evt-', event_id, '"') END,
  CASE WHEN event_id % 50 <> 5 AND event_id % 7 <> 0 THEN concat('"user_id":"usr-', user_id, '"') END,
  CASE WHEN event_id % 50 <> 5 THEN concat('"device_id":"dev-', user_id % 40, '"') END,
  concat('"event_type":"', CASE
    WHEN event_id % 50 = 4 THEN 'banner_hover'
    WHEN event_id % 50 = 13 THEN 'purchase'
    WHEN event_id % 50 = 17 THEN 'error_event'
    WHEN event_type = 'view' THEN 'page_view'
    WHEN event_type = 'error' THEN 'error_event'
    ELSE event_type END, '"'),
  concat('"event_timestamp":"', CASE
    WHEN event_id % 50 = 3 THEN 'sometime soon'
    WHEN event_id % 50 = 14 THEN '2071-05-06T00:00:00Z'
    WHEN event_id % 50 <> 16 THEN date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'") END, '"'),
  concat('"ingestion_timestamp":"', CASE
    WHEN event_id % 50 = 15 THEN 'half past nine'
    ELSE date_format(timestampadd(SECOND, 2 + 60 * copy, ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'") END, '"'),
  concat('"source_system":"', CASE WHEN event_id % 50 = 6 THEN '  '
    ELSE elt(CAST(user_id % 4 AS INT) + 1, 'web', 'mobile', 'iot-gateway', 'partner-api') END, '"'),
  concat('"region":"', CASE
    WHEN event_id % 50 = 8 THEN 'north-pole'
    WHEN event_id % 50 <> 7 THEN elt(CAST(event_id % 4 AS INT) + 1, 'us-east', 'us-west', 'eu-west', 'ap-south')
    END, '"'),
  concat('"session_id":"ses-', user_id, '"'),
  concat('"event_value":', CASE
    WHEN event_id % 50 = 12 THEN '"abc"'
    WHEN event_id % 50 IN (13, 17) THEN '-12.5'
    ELSE CAST(value AS STRING) END),
  concat('"event_status":"', IF(event_id % 50 = 25, '_end_of_payload', 'accepted'), '"'),
  concat('"payload_version":"', CASE
    WHEN event_id % 50 = 10 THEN '7.3'
    WHEN event_id % 50 <> 9 THEN IF(event_id % 2 = 0, '1.0', '1.1') END, '"'),
  CASE WHEN event_id % 50 = 11 THEN '"metadata":{}'
    ELSE concat('"metadata":{"k":"', get_json_object(props, '$.k'), '"}') END,
  CASE WHEN event_id % 3 = 0 THEN concat('"note":{"at":{"id":', event_id, '}}') END
), '}')
"""
# Payloads that are not one JSON object: cut off, two objects with and without a comma, text behind, and
# tails that go on where an object or a list around the payload would.
BROKEN = """CASE event_id % 50 WHEN 1 THEN substring(whole, 1, 20) WHEN 18 THEN concat(whole, whole)
  WHEN 19 THEN concat(whole, ',', whole) WHEN 20 THEN concat(whole, ' and more') WHEN 21 THEN concat(whole, ',"x":1')
  WHEN 22 THEN concat(whole, ',"event":', whole) WHEN 23 THEN concat(whole, ',"_end_of_payload":1')
  WHEN 24 THEN concat(whole, '],[', whole) ELSE whole END"""


def wire_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with the columns of a Kafka source; ids divisible by 40 arrive twice."""
    copies = "explode(CASE WHEN event_id % 40 = 0 THEN array(0, 1) ELSE array(0) END) AS copy"
    rows = spread(events_table(spark, sf_dir)).selectExpr("*", copies)
    whole = rows.selectExpr("*", f"{PAYLOAD} AS whole")
    return whole.selectExpr(
        "CAST(NULL AS BINARY) AS key",
        f"CAST({BROKEN} AS BINARY) AS value",
        f"'{RAW_TOPIC}' AS topic",
        "CAST(event_id % 3 AS INT) AS partition",
        "event_id DIV 3 * 2 + copy AS offset",
        "timestampadd(SECOND, 3 + 60 * copy, ts) AS timestamp",
    )


def _present(entries: dict[str, Column]) -> Column:
    """A string map without the entries whose value is null."""
    pairs = [part for name, value in entries.items() for part in (F.lit(name), value.cast("string"))]
    return F.map_filter(F.create_map(*pairs), lambda _, value: value.isNotNull())


def ledger_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger writes, up to two per event: unseen, expired, live, overtaken and illegal ones."""

    def write(status: str, hours_ago: int) -> Column:
        return F.struct(F.lit(status).alias("status"), F.lit(hours_ago).alias("hours_ago"))

    kind = F.col("event_id") % 10
    writes = (
        F.when(kind == 1, F.array(write("written", 48)))
        .when(kind == 2, F.array(write("received", 1)))
        .when(kind == 3, F.array(write("written", 1)))
        .when(kind == 4, F.array(write("received", 3), write("written", 1)))
        .when(kind == 5, F.array(write("written", 5), write("quarantined", 1)))
        .when(kind == 6, F.array(write("received", 1), write("written", 1)))
        .when(kind == 7, F.array(write("archived", 1)))
        .when(kind == 8, F.array(write("written", 1)))
        .when(kind == 9, F.array(write("written", 30), write("received", 1)))
    )
    rows = events_table(spark, sf_dir).select("event_id", F.explode(writes).alias("w"))
    updated = F.lit(NOW).cast("timestamp") - F.make_interval(hours=F.col("w")["hours_ago"])
    return rows.select(
        F.when(F.col("event_id") % 10 == 8, F.lit(""))
        .otherwise(F.concat(F.lit("evt-"), "event_id"))
        .alias("event_id"),
        F.col("w")["status"].alias("status"),
        updated.alias("updated_at"),
        (updated + F.make_interval(days=F.lit(1))).alias("expires_at"),
    )


# Exception class and message of the failure log, by event_id mod 16.
FAILURES = (
    ("KafkaTimeoutError", "no leader for partition"),
    ("ConnectionError", "Broker transport failure"),
    ("ValueError", "unknown topic events.raw"),
    ("TimeoutError", "operation took too long"),
    ("ConnectionError", "Redis ping failed"),
    ("OSError", "[Errno 111] Connection refused"),
    ("RuntimeError", "Checkpoint directory is unreadable"),
    ("RuntimeError", "Offset log gap at batch 7"),
    ("OSError", "Parquet footer truncated"),
    ("PermissionError", "Permission denied: /data/out"),
    ("StreamingQueryException", "query terminated"),
    ("Py4JError", "gateway closed"),
    ("ValueError", "bad literal"),
    ("OSError", "Redis write rejected by broker"),
    ("IOException", "FileSystem closed"),
    ("RuntimeError", "could not write part file"),
)


def failure_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One failure per error event, with metadata that is present or absent by row."""
    event_id = F.col("event_id")
    errors = events_table(spark, sf_dir).where("event_type = 'error'")
    rate = F.floor("value") / 1000 + F.when(event_id % 10 == 4, 0.3).otherwise(0.0)
    metadata = _present(
        {
            "topic": F.when(event_id % 3 != 0, F.lit(RAW_TOPIC)),
            "batch_id": event_id % 100,
            "failed_records": F.when(event_id % 6 != 0, event_id % 17),
            "quarantine_rate": F.when(event_id % 2 == 0, F.round(rate, 3)),
            "retry_attempts": F.when(event_id % 5 != 0, event_id % 7),
            "checkpoint": F.when(event_id % 11 == 0, F.lit("/checkpoints/clean")),
            "redis_status": F.when(event_id % 9 == 0, F.lit("down"))
            .when(event_id % 9 == 1, F.lit("fallback"))
            .when(event_id % 9 == 2, F.lit("healthy")),
            "kafka_status": F.when(event_id % 13 == 0, F.lit("down")),
        }
    )
    return errors.select(
        _one_of(tuple(name for name, _ in FAILURES), event_id % 16).alias("exception_class"),
        _one_of(tuple(message for _, message in FAILURES), event_id % 16).alias("message"),
        metadata.alias("metadata"),
        F.col("ts").alias("detected_at"),
    )


def incident_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hand-fed incident contexts, some with gaps and some out of bounds."""
    event_id = F.col("event_id")
    return events_table(spark, sf_dir).select(
        F.concat(F.lit("input-"), event_id).alias("input_id"),
        F.when(event_id % 6 != 0, F.concat(F.lit("failure of evt-"), event_id)).alias("exception_message"),
        F.when(event_id % 5 != 0, event_id % 7 - 1).alias("failed_records"),
        F.when(event_id % 8 != 0, F.round(F.col("value") / 100, 4)).alias("quarantine_rate"),
        F.when(event_id % 4 != 0, event_id % 9 - 1).alias("retry_attempts"),
        F.when(event_id % 3 == 0, F.lit("down")).alias("redis_status"),
        F.lit(None).cast("string").alias("kafka_status"),
    )


def retry_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One to six failed attempts per error event, over five operations."""
    event_id = F.col("event_id")
    errors = events_table(spark, sf_dir).where("event_type = 'error'")
    tried = errors.withColumn("attempt", F.explode(F.sequence(F.lit(1), (event_id % 6 + 1).cast("int"))))
    return tried.select(
        F.concat(F.lit("operation-"), event_id % 5).alias("operation"),
        "attempt",
        F.concat(F.lit("attempt "), "attempt", F.lit(" failed for evt-"), event_id).alias("exception"),
        (F.col("ts") + F.make_interval(secs=F.col("attempt"))).alias("timestamp"),
    )


def audit_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One recovery action per event."""
    event_id = F.col("event_id")
    actions = ("restart_streaming_query", "archive_corrupt_checkpoint", "pipeline_supervisor_restart")
    return events_table(spark, sf_dir).select(
        _one_of(actions, event_id % 3).alias("action"),
        (event_id % 4 != 0).alias("success"),
        F.col("ts").alias("timestamp"),
        F.create_map(F.lit("event"), F.concat(F.lit("evt-"), event_id)).alias("details"),
    )


def status_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A status change per event."""
    return events_table(spark, sf_dir).select(
        F.when(F.col("event_type") == "error", F.lit("stopped")).otherwise(F.lit("running")).alias("status"),
        F.col("ts").alias("at"),
    )
