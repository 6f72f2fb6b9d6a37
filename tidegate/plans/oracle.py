"""The same results in plain SQL over the given tables, for a check against DuckDB.

Everything is restated from the columns of ``events``; no JSON is parsed here.
"""

from __future__ import annotations

from tidegate.operators import incidents as texts
from tidegate.plans.fixture import FAILURES

NOW = "TIMESTAMP '2024-02-01 00:00:00'"
EARLIER = "TIMESTAMP '2024-01-15 00:00:00'"
# Kinds of payload, by event_id mod 50, that are not one JSON value.
MALFORMED = "(1, 18, 19, 20, 21, 22, 23, 24)"


def _cases(column: str, values: list[str]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values)) + " END"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _verdict(now: str) -> str:
    """First failing rule as 'type/field'; null for a valid row."""
    return f"""CASE
      WHEN d IN {MALFORMED} THEN 'malformed_json/'
      WHEN event_id IS NULL THEN 'schema_validation/event_id'
      WHEN event_time IS NULL THEN 'malformed_timestamp/event_timestamp'
      WHEN event_type NOT IN ('page_view','click','purchase','sensor_reading','error_event','heartbeat')
        THEN 'quality_rule/event_type'
      WHEN user_id IS NULL AND device_id IS NULL THEN 'quality_rule/user_id|device_id'
      WHEN trim(source_system) = '' THEN 'schema_validation/source_system'
      WHEN region IS NULL THEN 'schema_validation/region'
      WHEN region NOT IN ('us-east','us-west','eu-west','ap-south') THEN 'quality_rule/region'
      WHEN payload_version IS NULL THEN 'schema_validation/payload_version'
      WHEN payload_version NOT IN ('1.0','1.1') THEN 'quality_rule/payload_version'
      WHEN k IS NULL THEN 'quality_rule/metadata'
      WHEN event_value IS NULL THEN 'quality_rule/event_value'
      WHEN event_value < 0 AND event_type <> 'error_event' THEN 'quality_rule/event_value'
      WHEN event_time > {now} + INTERVAL 5 MINUTE THEN 'quality_rule/event_timestamp'
      WHEN ingestion_time IS NULL THEN 'malformed_timestamp/ingestion_timestamp'
    END"""


def _judged(name: str, now: str) -> str:
    return f"""{name}0 AS (SELECT *, {_verdict(now)} AS verdict FROM parsed),
{name} AS (
  SELECT * EXCLUDE (verdict),
    split_part(verdict, '/', 1) AS error_type,
    nullif(split_part(verdict, '/', 2), '') AS failed_field,
    CASE WHEN verdict = 'malformed_json/'
           THEN 'payload is not valid JSON or does not match the event schema'
         WHEN verdict IS NOT NULL THEN 'validation failed: ' || split_part(verdict, '/', 2) END AS error_message,
    verdict IS NULL AS is_valid
  FROM {name}0)"""


_EVENTS = f"""
src AS (
  SELECT event_id AS id, ts, user_id AS uid, event_type AS etype, value, props, event_id % 50 AS d,
         unnest(CASE WHEN event_id % 40 = 0 THEN [0, 1] ELSE [0] END) AS copy
  FROM events),
fields AS (
  SELECT id, ts, d, copy,
    'events.raw' AS source_topic,
    CAST(id % 3 AS INTEGER) AS source_partition,
    CAST((id // 3) * 2 + copy AS BIGINT) AS source_offset,
    ts + to_seconds(3 + 60 * copy) AS kafka_timestamp,
    CASE WHEN d <> 2 THEN 'evt-' || id END AS event_id,
    CASE WHEN d <> 5 AND id % 7 <> 0 THEN 'usr-' || uid END AS user_id,
    CASE WHEN d <> 5 THEN 'dev-' || (uid % 40) END AS device_id,
    CASE WHEN d = 4 THEN 'banner_hover' WHEN d = 13 THEN 'purchase' WHEN d = 17 THEN 'error_event'
         WHEN etype = 'view' THEN 'page_view' WHEN etype = 'error' THEN 'error_event' ELSE etype END AS event_type,
    CASE WHEN d = 3 THEN 'sometime soon' WHEN d = 14 THEN '2071-05-06T00:00:00Z'
         WHEN d <> 16 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') END AS event_timestamp,
    CASE WHEN d = 14 THEN TIMESTAMP '2071-05-06 00:00:00' WHEN d NOT IN (3, 16) THEN ts END AS event_time,
    CASE WHEN d = 15 THEN 'half past nine'
         ELSE strftime(ts + to_seconds(2 + 60 * copy), '%Y-%m-%dT%H:%M:%S.%fZ') END AS ingestion_timestamp,
    CASE WHEN d <> 15 THEN ts + to_seconds(2 + 60 * copy) END AS ingestion_time,
    CASE WHEN d = 6 THEN '  ' ELSE {_cases("uid % 4", ["'web'", "'mobile'", "'iot-gateway'", "'partner-api'"])} END AS source_system,
    CASE WHEN d = 8 THEN 'north-pole' WHEN d <> 7
         THEN {_cases("id % 4", ["'us-east'", "'us-west'", "'eu-west'", "'ap-south'"])} END AS region,
    'ses-' || uid AS session_id,
    CASE WHEN d = 12 THEN '"abc"' WHEN d IN (13, 17) THEN '-12.5' ELSE CAST(value AS VARCHAR) END AS value_text,
    CASE WHEN d IN (13, 17) THEN -12.5 WHEN d <> 12 THEN value END AS event_value,
    CASE WHEN d = 25 THEN '_end_of_payload' ELSE 'accepted' END AS event_status,
    CASE WHEN d = 10 THEN '7.3' WHEN d <> 9 THEN CASE WHEN id % 2 = 0 THEN '1.0' ELSE '1.1' END END AS payload_version,
    CASE WHEN d <> 11 THEN json_extract_string(props, '$.k') END AS k
  FROM src),
wire AS (
  SELECT *, CASE d WHEN 1 THEN substr(whole, 1, 20) WHEN 18 THEN whole || whole WHEN 19 THEN whole || ',' || whole
    WHEN 20 THEN whole || ' and more' WHEN 21 THEN whole || ',"x":1' WHEN 22 THEN whole || ',"event":' || whole
    WHEN 23 THEN whole || ',"_end_of_payload":1' WHEN 24 THEN whole || '],[' || whole
    ELSE whole END AS raw_payload
  FROM (SELECT *, '{{' || concat_ws(',',
      '"event_id":"' || event_id || '"',
      '"user_id":"' || user_id || '"',
      '"device_id":"' || device_id || '"',
      '"event_type":"' || event_type || '"',
      '"event_timestamp":"' || event_timestamp || '"',
      '"ingestion_timestamp":"' || ingestion_timestamp || '"',
      '"source_system":"' || source_system || '"',
      '"region":"' || region || '"',
      '"session_id":"' || session_id || '"',
      '"event_value":' || value_text,
      '"event_status":"' || event_status || '"',
      '"payload_version":"' || payload_version || '"',
      CASE WHEN k IS NULL THEN '"metadata":{{}}' ELSE '"metadata":{{"k":"' || k || '"}}' END,
      CASE WHEN id % 3 = 0 THEN '"note":{{"at":{{"id":' || id || '}}}}' END) || '}}' AS whole
    FROM fields)),
parsed AS (
  SELECT id, d, copy, source_topic, source_partition, source_offset, kafka_timestamp, raw_payload,
    {", ".join(f"CASE WHEN d NOT IN {MALFORMED} THEN {c} END AS {c}" for c in (
        "event_id", "user_id", "device_id", "event_type", "event_timestamp", "event_time",
        "ingestion_timestamp", "ingestion_time", "source_system", "region", "session_id",
        "event_value", "event_status", "payload_version", "k"))}
  FROM wire),
{_judged("checked", NOW)},
{_judged("checked_earlier", EARLIER)},
clean AS (
  SELECT raw_payload, source_topic, source_partition, source_offset, kafka_timestamp, event_id, user_id,
    device_id, lower(event_type) AS event_type, event_time AS event_timestamp,
    ingestion_time AS ingestion_timestamp, source_system, lower(region) AS region, session_id,
    event_value, event_status, payload_version, k AS metadata, CAST(event_time AS DATE) AS event_date,
    sha256(event_id || '|' || payload_version) AS processing_key
  FROM checked WHERE is_valid),
deduped AS (
  SELECT * FROM clean
  QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY ingestion_timestamp, source_partition, source_offset) = 1),
envelopes AS (
  SELECT event_id, raw_payload AS original_payload, error_type, error_message, failed_field,
    CAST(kafka_timestamp AS VARCHAR) AS processing_timestamp, error_type <> 'malformed_json' AS replay_eligible,
    CAST(0 AS INTEGER) AS retry_count, source_topic, source_partition, source_offset, kafka_timestamp
  FROM checked WHERE NOT is_valid),
per_row AS (
  SELECT 'stream-' || source_partition AS query_id, CAST(floor(epoch(kafka_timestamp) / 3600) AS BIGINT) AS batch_id, is_valid,
    is_valid AND row_number() OVER (PARTITION BY is_valid, event_id ORDER BY source_partition,
      floor(epoch(kafka_timestamp) / 3600)) = 1 AS is_first
  FROM checked),
metrics AS (
  SELECT query_id, batch_id,
    count(*) FILTER (is_first) AS valid,
    count(*) FILTER (NOT is_valid) AS quarantined,
    count(*) FILTER (is_valid AND NOT is_first) AS duplicates
  FROM per_row GROUP BY ALL),
history AS (
  SELECT *, total_quarantined / CAST(total_valid + total_quarantined AS DOUBLE) AS rate,
    coalesce((total_quarantined - quarantined) /
      nullif(CAST(total_valid + total_quarantined - valid - quarantined AS DOUBLE), 0), 0) AS rate_before
  FROM (SELECT *,
      CAST(sum(valid) OVER w AS BIGINT) AS total_valid,
      CAST(sum(quarantined) OVER w AS BIGINT) AS total_quarantined
    FROM metrics
    WINDOW w AS (PARTITION BY query_id ORDER BY batch_id ROWS UNBOUNDED PRECEDING))),
ledger_log AS (
  SELECT CASE WHEN event_id % 10 = 8 THEN '' ELSE 'evt-' || event_id END AS event_id, w.status AS status,
    {NOW} - to_hours(w.hours) AS updated_at,
    {NOW} - to_hours(w.hours) + INTERVAL 1 DAY AS expires_at
  FROM (SELECT event_id, unnest(CASE event_id % 10
      WHEN 1 THEN [{{'status': 'written', 'hours': 48}}]
      WHEN 2 THEN [{{'status': 'received', 'hours': 1}}]
      WHEN 3 THEN [{{'status': 'written', 'hours': 1}}]
      WHEN 4 THEN [{{'status': 'received', 'hours': 3}}, {{'status': 'written', 'hours': 1}}]
      WHEN 5 THEN [{{'status': 'written', 'hours': 5}}, {{'status': 'quarantined', 'hours': 1}}]
      WHEN 6 THEN [{{'status': 'received', 'hours': 1}}, {{'status': 'written', 'hours': 1}}]
      WHEN 7 THEN [{{'status': 'archived', 'hours': 1}}]
      WHEN 8 THEN [{{'status': 'written', 'hours': 1}}]
      WHEN 9 THEN [{{'status': 'written', 'hours': 30}}, {{'status': 'received', 'hours': 1}}]
      END) AS w FROM events)),
ledger AS (SELECT * FROM ledger_log WHERE event_id <> '' AND status <> 'archived'),
ledger_live AS (SELECT * FROM ledger WHERE expires_at > {NOW}),
ledger_current AS (
  SELECT * FROM (SELECT * FROM ledger
    QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY updated_at DESC, status = 'written' DESC) = 1)
  WHERE expires_at > {NOW}),
ledger_written AS (SELECT event_id FROM ledger_current WHERE status = 'written'),
quarantined_before AS (
  SELECT e.event_id, e.raw_payload AS original_payload, e.source_partition, e.source_offset,
    e.error_type AS first_error, e.error_type <> 'malformed_json' AS replay_eligible,
    CAST((e.source_offset // 2) % 4 AS INTEGER) AS tries,
    n.error_message AS new_error, n.is_valid AS now_valid
  FROM checked_earlier e JOIN checked n USING (source_partition, source_offset)
  WHERE NOT e.is_valid),
decided AS (
  SELECT *, CASE
      WHEN NOT replay_eligible THEN 'record is not replay eligible'
      WHEN tries >= 3 THEN 'maximum replay attempts exceeded'
      WHEN NOT now_valid THEN 'payload still fails validation'
      ELSE 'eligible and valid' END AS reason
  FROM quarantined_before),
replays AS (
  SELECT *, CASE WHEN outcome = 'dead_lettered' THEN 'events.dead_letter' ELSE 'events.replay' END AS destination
  FROM (SELECT *,
      CAST(CASE WHEN reason IN ('payload still fails validation', 'eligible and valid') THEN tries + 1 ELSE tries END AS INTEGER) AS retry_count,
      CASE WHEN reason = 'eligible and valid' THEN 'replayed'
           WHEN reason = 'payload still fails validation' AND tries + 1 < 3 THEN 'deferred'
           ELSE 'dead_lettered' END AS outcome
    FROM decided)),
replayed_rows AS (
  SELECT c.* FROM clean c JOIN replays r USING (source_partition, source_offset)
  WHERE r.outcome = 'replayed' AND c.event_id NOT IN (SELECT event_id FROM ledger_written)
  QUALIFY row_number() OVER (PARTITION BY c.event_id ORDER BY c.ingestion_timestamp, source_partition, source_offset) = 1),
failures AS (
  SELECT event_id AS id, ts AS detected_at,
    {_cases("event_id % 16", [_quoted(name) for name, _ in FAILURES])} AS exception_class,
    {_cases("event_id % 16", [_quoted(message) for _, message in FAILURES])} AS message,
    {_cases("event_id % 16", [_quoted(kind) for kind in (
        "kafka_failure", "kafka_failure", "kafka_failure", "kafka_failure", "redis_failure",
        "redis_failure", "checkpoint_failure", "checkpoint_failure", "output_write_failure",
        "output_write_failure", "spark_query_failure", "spark_query_failure", "unknown_failure",
        "kafka_failure", "output_write_failure", "output_write_failure")])} AS failure_type,
    value
  FROM events WHERE event_type = 'error'),
contexts AS (
  SELECT id, message AS exception_message, failure_type,
    CASE WHEN id % 3 <> 0 THEN 'events.raw' END AS failed_topic,
    id % 100 AS failed_batch_id,
    CASE WHEN id % 6 <> 0 THEN id % 17 ELSE 0 END AS failed_records,
    CASE WHEN id % 2 = 0 THEN round(floor(value) / 1000 + CASE WHEN id % 10 = 4 THEN 0.3 ELSE 0 END, 3) ELSE 0 END AS quarantine_rate,
    CASE WHEN id % 5 <> 0 THEN id % 7 ELSE 0 END AS retry_attempts,
    CASE WHEN id % 11 = 0 THEN '/checkpoints/clean' END AS latest_checkpoint,
    CASE id % 9 WHEN 0 THEN 'down' WHEN 1 THEN 'fallback' WHEN 2 THEN 'healthy' ELSE 'unknown' END AS redis_status,
    CASE WHEN id % 13 = 0 THEN 'down' ELSE 'unknown' END AS kafka_status,
    detected_at AS collected_at
  FROM failures),
triaged AS (
  SELECT *,
    component || ' pipeline incident' AS incident_title,
    {_cases("n", [_quoted(t[1]) for t in (texts.REDIS, texts.KAFKA, texts.CHECKPOINT, texts.VALIDATION, texts.PARQUET_SINK, texts.STREAMING)])} AS likely_root_cause,
    'inc-' || sha256(concat_ws('|', exception_message, failure_type, coalesce(failed_topic, ''),
      CAST(failed_batch_id AS VARCHAR), CAST(failed_records AS VARCHAR), CAST(quarantine_rate AS VARCHAR),
      CAST(retry_attempts AS VARCHAR), coalesce(latest_checkpoint, ''), redis_status, kafka_status,
      CAST(collected_at AS VARCHAR))) AS incident_id,
    'The streaming pipeline reported: ' || exception_message || '. Retry attempts: ' || retry_attempts
      || '; quarantine rate: ' || printf('%.2f', quarantine_rate * 100) || '%.' AS summary
  FROM (SELECT *, {_cases("n", [_quoted(t[0]) for t in (texts.REDIS, texts.KAFKA, texts.CHECKPOINT, texts.VALIDATION, texts.PARQUET_SINK, texts.STREAMING)])} AS component,
      CASE WHEN retry_attempts >= 5 OR quarantine_rate >= 0.5 THEN 'critical'
           WHEN retry_attempts >= 3 OR quarantine_rate > 0.1 THEN 'high' ELSE 'medium' END AS severity
    FROM (SELECT *, CASE
        WHEN redis_status IN ('down', 'fallback') OR exception_message ILIKE '%redis%' THEN 0
        WHEN kafka_status = 'down' OR exception_message ILIKE '%kafka%' OR exception_message ILIKE '%broker%'
          OR exception_message ILIKE '%topic%' THEN 1
        WHEN exception_message ILIKE '%checkpoint%' THEN 2
        WHEN quarantine_rate > 0.1 THEN 3
        WHEN exception_message ILIKE '%parquet%' OR exception_message ILIKE '%write%'
          OR exception_message ILIKE '%filesystem%' THEN 4
        ELSE 5 END AS n FROM contexts))),
steps AS (
  SELECT *, CASE WHEN len(found) = 0 THEN [{_quoted(texts.DEFAULT_STEPS[0])}] ELSE found END AS recommended
  FROM (SELECT *, list_concat(
      CASE WHEN everything LIKE '%redis%' OR redis_status IN ('down', 'fallback')
        THEN [{", ".join(map(_quoted, texts.REDIS_STEPS))}] ELSE [] END,
      CASE WHEN everything LIKE '%kafka%' OR kafka_status = 'down'
        THEN [{", ".join(map(_quoted, texts.KAFKA_STEPS))}] ELSE [] END,
      CASE WHEN everything LIKE '%checkpoint%' THEN [{_quoted(texts.CHECKPOINT_STEPS[0])}] ELSE [] END,
      CASE WHEN quarantine_rate > 0.1 THEN [{_quoted(texts.RATE_STEPS[0])}] ELSE [] END,
      CASE WHEN everything LIKE '%parquet%' OR everything LIKE '%write%'
        THEN [{_quoted(texts.WRITE_STEPS[0])}] ELSE [] END) AS found
    FROM (SELECT *, lower(concat_ws(' ', exception_message, failure_type, failed_topic, latest_checkpoint,
        redis_status, kafka_status)) AS everything FROM triaged)))
"""


def _windows(rows: str, size: str, more: str = "") -> str:
    return f"""SELECT time_bucket(INTERVAL '{size}', event_timestamp) AS window_start,
    time_bucket(INTERVAL '{size}', event_timestamp) + INTERVAL '{size}' AS window_end,
    event_type, region, source_system, count(*) AS event_count,
    round(avg(event_value) * count(*), 2) / count(*) AS average_event_value,
    count(*) FILTER (event_type = 'error_event') AS error_event_count,
    CAST(time_bucket(INTERVAL '{size}', event_timestamp) AS DATE) AS window_date{more}
  FROM {rows} GROUP BY ALL"""


_RELAXED = f"""SELECT error_type, failed_field, count(*) AS records
  FROM (SELECT split_part(verdict, '/', 1) AS error_type, nullif(split_part(verdict, '/', 2), '') AS failed_field
    FROM (SELECT CASE
      WHEN d IN {MALFORMED} THEN 'malformed_json/'
      WHEN event_id IS NULL THEN 'schema_validation/event_id'
      WHEN event_time IS NULL THEN 'malformed_timestamp/event_timestamp'
      WHEN event_type NOT IN ('page_view','click','purchase','sensor_reading','error_event','heartbeat','signup','banner_hover')
        THEN 'quality_rule/event_type'
      WHEN region IS NULL THEN 'schema_validation/region'
      WHEN region NOT IN ('us-east','us-west','eu-west') THEN 'quality_rule/region'
      WHEN payload_version NOT IN ('1.0','7.3') THEN 'quality_rule/payload_version'
      WHEN event_value IS NULL THEN 'quality_rule/event_value'
      WHEN event_value < 0 AND event_type IN ('page_view','click','sensor_reading','heartbeat') THEN 'quality_rule/event_value'
      WHEN event_time > {EARLIER} + INTERVAL 60 MINUTE THEN 'quality_rule/event_timestamp'
      WHEN ingestion_time IS NULL THEN 'malformed_timestamp/ingestion_timestamp'
    END AS verdict FROM parsed)) GROUP BY ALL"""

def _listed_verdict() -> str:
    listed = """event_type NOT IN (SELECT CASE event_type WHEN 'view' THEN 'page_view'
          WHEN 'error' THEN 'error_event' ELSE event_type END FROM events WHERE value > 400)"""
    configured = """event_type NOT IN ('page_view','click','purchase','sensor_reading','error_event','heartbeat')"""
    return _verdict(NOW).replace(configured, listed)


SQL: dict[str, str] = {
    "raw_envelope": "SELECT raw_payload, source_topic, source_partition, source_offset, kafka_timestamp FROM wire",
    "parsed_events": """SELECT source_topic, source_partition, source_offset, kafka_timestamp, event_id, user_id,
      device_id, event_type, event_timestamp, ingestion_timestamp, source_system, region, session_id, event_value,
      event_status, payload_version, k AS metadata FROM parsed""",
    "validated_events": """SELECT source_partition, source_offset, event_id, error_type, failed_field, error_message,
      is_valid FROM checked""",
    "valid_split": "SELECT is_valid, count(*) AS records FROM checked GROUP BY ALL",
    "error_breakdown": """SELECT error_type, failed_field, error_message, count(*) AS records FROM checked
      WHERE NOT is_valid GROUP BY ALL""",
    "rules_from_config": _RELAXED,
    "rules_from_table": f"""SELECT split_part(verdict, '/', 1) AS error_type,
      nullif(split_part(verdict, '/', 2), '') AS failed_field,
      CASE WHEN verdict = 'malformed_json/' THEN 'payload is not valid JSON or does not match the event schema'
           WHEN verdict IS NOT NULL THEN 'validation failed: ' || split_part(verdict, '/', 2) END AS error_message,
      count(*) AS records FROM (SELECT {_listed_verdict()} AS verdict FROM parsed) GROUP BY ALL""",
    "clean_events": "SELECT * FROM clean",
    "processing_keys": "SELECT DISTINCT event_id, payload_version, processing_key FROM clean",
    "dedup_first": """SELECT event_id, source_partition, source_offset, event_timestamp, ingestion_timestamp,
      event_type, region, event_value FROM deduped""",
    "window_agg_5m": _windows("deduped", "5 minutes"),
    "window_agg_1h": _windows("deduped", "1 hour"),
    "window_agg_1d": _windows("deduped", "1 day"),
    "exact_unique_devices": _windows("deduped", "1 day", ", count(DISTINCT device_id) AS unique_device_count"),
    "approx_unique_devices": f"""SELECT window_start, event_type, region, source_system, unique_device_count AS exact_count,
      TRUE AS estimate_is_near FROM ({_windows("deduped", "1 day", ", count(DISTINCT device_id) AS unique_device_count")})""",
    "rollup_1h_from_5m": _windows("deduped", "1 hour"),
    "rollup_1d_from_5m": _windows("deduped", "1 day", ", count(DISTINCT device_id) AS exact_count, TRUE AS estimate_is_near"),
    "replay_window_refresh": """, before AS (
        SELECT event_time AS event_timestamp, event_type, region, source_system, event_value
        FROM checked_earlier WHERE is_valid
        QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY ingestion_time, source_partition, source_offset) = 1),
      everything AS (SELECT * FROM before UNION ALL
        SELECT event_timestamp, event_type, region, source_system, event_value FROM replayed_rows),
      affected AS (SELECT e.* FROM everything e WHERE EXISTS (SELECT 1 FROM replayed_rows r
        WHERE r.event_type = e.event_type AND r.region = e.region AND r.source_system = e.source_system
          AND time_bucket(INTERVAL '1 hour', r.event_timestamp) = time_bucket(INTERVAL '1 hour', e.event_timestamp)))
      """ + _windows("affected", "1 hour"),
    "late_rows": """, arrived AS (SELECT event_id, source_offset, event_timestamp,
        CAST(floor(epoch(event_timestamp + to_seconds(CASE WHEN source_offset % 11 = 0 THEN 7200 ELSE 3 END)) / 3600) AS BIGINT) AS batch_id
        FROM clean),
      newest AS (SELECT batch_id, max(event_timestamp) AS top FROM arrived GROUP BY ALL),
      marks AS (SELECT batch_id, max(top) OVER (ORDER BY batch_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
        - INTERVAL 10 MINUTE AS watermark FROM newest)
      SELECT event_id, source_offset, event_timestamp, batch_id, watermark FROM arrived JOIN marks USING (batch_id)
      WHERE event_timestamp <= watermark""",
    "encode_clean": """SELECT event_id AS key, event_id, user_id, event_type, event_value,
      date_trunc('millisecond', event_timestamp) AS event_timestamp, event_date, processing_key, source_offset
      FROM deduped""",
    "encode_quarantine": """SELECT CAST(NULL AS VARCHAR) AS key, event_id, original_payload, error_type,
      error_message, failed_field, replay_eligible, retry_count FROM envelopes""",
    "encode_aggregates": f"""SELECT concat_ws('|', CAST(window_start AS VARCHAR), event_type, region) AS key,
      window_start, window_end, event_type, region, source_system, event_count, window_date
      FROM ({_windows("deduped", "1 hour")})""",
    "quarantine_envelope": """SELECT event_id, original_payload, error_type, error_message, failed_field,
      replay_eligible, retry_count, source_partition, source_offset FROM envelopes""",
    "quarantine_latest": """SELECT event_id, original_payload, error_type, failed_field FROM envelopes
      ORDER BY kafka_timestamp DESC, event_id DESC NULLS LAST, original_payload DESC LIMIT 100""",
    "quarantine_index": """SELECT event_id, original_payload, error_type, failed_field FROM envelopes
      ORDER BY kafka_timestamp DESC, event_id DESC NULLS LAST, original_payload DESC LIMIT 2000""",
    "quarantine_ids": "SELECT DISTINCT event_id FROM envelopes WHERE event_id IS NOT NULL",
    "quarantine_stats": """SELECT error_type, CAST(grouping(error_type) AS INTEGER) AS is_total, count(*) AS records,
      count(*) FILTER (replay_eligible) AS replay_eligible FROM envelopes GROUP BY ROLLUP (error_type)""",
    "quarantine_index_stats": """SELECT error_type, CAST(grouping(error_type) AS INTEGER) AS is_total, count(*) AS records,
      count(*) FILTER (replay_eligible) AS replay_eligible FROM (SELECT * FROM envelopes
        ORDER BY kafka_timestamp DESC, event_id DESC NULLS LAST, original_payload DESC LIMIT 2000)
      GROUP BY ROLLUP (error_type)""",
    "quarantine_summary": """SELECT count(*) AS indexed_records, count(*) FILTER (replay_eligible) AS replay_eligible,
      count(*) FILTER (error_type = 'malformed_json') AS malformed_json,
      count(*) FILTER (error_type = 'malformed_timestamp') AS malformed_timestamp,
      count(*) FILTER (error_type = 'quality_rule') AS quality_rule,
      count(*) FILTER (error_type = 'schema_validation') AS schema_validation,
      (SELECT sum(quarantined) / CAST(sum(valid) + sum(quarantined) AS DOUBLE) FROM metrics) AS quarantine_rate
      FROM envelopes""",
    "batch_metrics": "SELECT * FROM metrics",
    "quarantine_rate": """SELECT CAST(sum(valid) AS BIGINT) AS valid, CAST(sum(quarantined) AS BIGINT) AS quarantined,
      CAST(sum(duplicates) AS BIGINT) AS duplicates, max(batch_id) AS last_batch_id,
      sum(quarantined) / CAST(sum(valid) + sum(quarantined) AS DOUBLE) AS quarantine_rate,
      sum(quarantined) > 0.1 * (sum(valid) + sum(quarantined)) AS quarantine_rate_alerted FROM metrics""",
    "rate_history": """SELECT query_id, batch_id, total_valid, total_quarantined, rate AS quarantine_rate,
      rate > 0.1 AS breached, rate > 0.1 AND rate_before <= 0.1 AS alert FROM history""",
    **{
        name: f"""SELECT query_id, batch_id, 'excessive_quarantine_rate' AS failure_type,
          'Quarantine rate ' || printf('%.2f', rate * 100) || '% exceeds {limit:.2%}' AS message,
          'validation' AS component, true AS recoverable, CAST(total_quarantined AS VARCHAR) AS invalid_records,
          CAST(total_valid + total_quarantined AS VARCHAR) AS total_records
          FROM history WHERE rate > {limit} AND rate_before <= {limit}"""
        for name, limit in (("rate_alerts", 0.10), ("rate_alerts_rearmed", 0.45), ("stream_rate_alerts", 0.45))
    },
    "rate_incidents": """SELECT 'Quarantine rate ' || printf('%.2f', rate * 100) || '% exceeds 45.00%' AS exception_message,
      'excessive_quarantine_rate' AS failure_type, 'Validation' AS component,
      CASE WHEN rate >= 0.5 THEN 'critical' ELSE 'high' END AS severity,
      'The streaming pipeline reported: Quarantine rate ' || printf('%.2f', rate * 100)
        || '% exceeds 45.00%. Retry attempts: 0; quarantine rate: ' || printf('%.2f', rate * 100) || '%.' AS summary,
      make_timestamp(batch_id * 3600 * 1000000) AS collected_at
      FROM history WHERE rate > 0.45 AND rate_before <= 0.45""",
    "incident_job": """, alerted AS (SELECT DISTINCT rate, batch_id FROM history WHERE rate > 0.45 AND rate_before <= 0.45)
      SELECT exception_message, failure_type, severity, summary, collected_at AS created_at, true AS success
      FROM (SELECT DISTINCT ON (incident_id) * FROM triaged)
      UNION ALL SELECT 'Quarantine rate ' || printf('%.2f', rate * 100) || '% exceeds 45.00%', 'excessive_quarantine_rate',
      CASE WHEN rate >= 0.5 THEN 'critical' ELSE 'high' END,
      'The streaming pipeline reported: Quarantine rate ' || printf('%.2f', rate * 100)
        || '% exceeds 45.00%. Retry attempts: 0; quarantine rate: ' || printf('%.2f', rate * 100) || '%.',
      make_timestamp(batch_id * 3600 * 1000000), true FROM alerted""",
    "processed_at": f"SELECT event_id, source_offset, {NOW} AS processed_at FROM clean",
    "stream_generic_sinks": "SELECT event_id, event_date, event_value, event_value AS said_value FROM deduped",
    "stream_checkpoint_reads": """SELECT 'clean' AS query_name, count(*) > 0 AS committed_twice,
      'dedupeWithinWatermark' AS operator_name, true AS holds_state, '/x/clean' AS folder FROM deduped""",
    "run_status": """SELECT CASE WHEN event_type = 'error' THEN 'stopped' ELSE 'running' END AS status, ts AS at
      FROM events ORDER BY ts DESC LIMIT 1""",
    "ledger_current": "SELECT * FROM ledger_current",
    "ledger_live": "SELECT * FROM ledger_live",
    "ledger_reject_bad_status": """SELECT event_id, status, CASE WHEN status = 'archived'
      THEN 'Unsupported processing status: archived' ELSE 'event_id cannot be empty' END AS reason, updated_at
      FROM ledger_log WHERE event_id = '' OR status = 'archived'""",
    "ledger_claim": """SELECT DISTINCT event_id, event_id NOT IN (SELECT event_id FROM ledger_live) AS claimed FROM clean""",
    "ledger_claimed_entries": f"""SELECT DISTINCT event_id, 'received' AS status, {NOW} AS updated_at,
      {NOW} + INTERVAL 1 DAY AS expires_at FROM clean WHERE event_id NOT IN (SELECT event_id FROM ledger_live)""",
    "idempotent_gate": """SELECT event_id, event_timestamp, source_offset FROM deduped
      WHERE event_id NOT IN (SELECT event_id FROM ledger_written)""",
    "gate_bucketed": """SELECT event_id, event_timestamp, source_offset FROM deduped
      WHERE event_id NOT IN (SELECT event_id FROM ledger_written)""",
    "gate_duplicates": """SELECT count(*) AS distinct_ids, count(*) FILTER (NOT seen) AS admitted,
      count(*) FILTER (seen) AS duplicates
      FROM (SELECT DISTINCT event_id, event_id IN (SELECT event_id FROM ledger_written) AS seen FROM clean)""",
    "mark_quarantined": f"""SELECT DISTINCT event_id, 'quarantined' AS status, {NOW} AS updated_at,
      {NOW} + INTERVAL 1 DAY AS expires_at FROM envelopes
      WHERE event_id IS NOT NULL AND event_id NOT IN (SELECT event_id FROM ledger_current)""",
    "replay_decisions": """SELECT source_partition, source_offset, event_id, retry_count, outcome, reason, destination
      FROM replays""",
    "replay_failed_fields": f"""SELECT source_partition, source_offset, retry_count, new_error AS last_replay_error,
      {NOW} AS last_replay_at FROM replays WHERE reason = 'payload still fails validation'""",
    "replay_deferred": f"""SELECT event_id, original_payload, retry_count, new_error AS last_replay_error,
      {NOW} + to_seconds(CAST(least(30, 2 * pow(2, greatest(0, retry_count - 1))) AS BIGINT)) AS next_attempt_at
      FROM replays WHERE outcome = 'deferred'""",
    "replay_due": """, first_try AS (
        SELECT CASE WHEN replay_eligible AND NOT now_valid THEN 'deferred' WHEN replay_eligible THEN 'replayed' ELSE 'dead_lettered' END AS outcome,
          CAST(CASE WHEN replay_eligible THEN 1 ELSE 0 END AS INTEGER) AS retry_count FROM quarantined_before),
      runs AS (SELECT 'replay-0s' AS run, * FROM first_try
        UNION ALL SELECT 'replay-2s', 'deferred', 2 FROM first_try WHERE outcome = 'deferred'
        UNION ALL SELECT 'replay-6s', 'dead_lettered', 3 FROM first_try WHERE outcome = 'deferred')
      SELECT run, outcome, retry_count, count(*) AS records FROM runs GROUP BY ALL""",
    "replay_published_once": """, sent AS (SELECT unnest(CASE WHEN NOT replay_eligible THEN ['events.dead_letter']
        WHEN now_valid THEN ['events.replay', 'events.raw'] ELSE ['events.replay'] END) AS topic FROM quarantined_before)
      SELECT topic, count(*) AS messages, count(*) AS distinct_ids FROM sent GROUP BY topic""",
    "replay_publish": """SELECT topic, event_id,
      CASE WHEN outcome <> 'replayed' THEN first_error END AS error_type,
      CASE WHEN outcome <> 'replayed' THEN retry_count END AS record_retry_count,
      CASE WHEN outcome = 'replayed' THEN retry_count END AS audit_retry_count,
      CASE WHEN outcome = 'replayed' THEN 'quarantine' END AS audit_source,
      CASE WHEN outcome = 'replayed' AND CAST(substr(event_id, 5) AS BIGINT) % 3 = 0 THEN substr(event_id, 5) END AS note_id
      FROM (SELECT *, unnest(CASE WHEN outcome = 'replayed' THEN [destination, 'events.raw'] ELSE [destination] END) AS topic
        FROM replays)""",
    "replay_counts": """SELECT count(*) FILTER (outcome = 'replayed') AS replayed,
      count(*) FILTER (outcome = 'dead_lettered') AS dead_lettered,
      count(*) FILTER (outcome = 'deferred') AS deferred FROM replays""",
    "replay_run": f"""SELECT count(*) FILTER (outcome = 'replayed') AS replayed,
      count(*) FILTER (outcome = 'dead_lettered') AS dead_lettered,
      count(*) FILTER (outcome = 'deferred') AS deferred, {NOW} AS completed_at FROM replays""",
    "replay_dry_run": "SELECT destination, count(*) AS records FROM replays GROUP BY ALL",
    "dead_letters": """SELECT source_partition, source_offset, event_id, first_error AS error_type, retry_count, reason
      FROM replays WHERE outcome = 'dead_lettered'""",
    "replayed_clean": """SELECT event_id, source_offset, event_timestamp, ingestion_timestamp, event_type, region,
      event_value, event_date, processing_key FROM replayed_rows""",
    "failure_class": """SELECT exception_class, message, detected_at, failure_type,
      CASE failure_type WHEN 'kafka_failure' THEN 'kafka' WHEN 'redis_failure' THEN 'redis'
        WHEN 'checkpoint_failure' THEN 'checkpoint' WHEN 'output_write_failure' THEN 'parquet_sink'
        WHEN 'spark_query_failure' THEN 'spark' ELSE 'pipeline' END AS component,
      failure_type <> 'unknown_failure' AS recoverable FROM failures""",
    "incident_context": "SELECT * EXCLUDE (id) FROM contexts",
    "incident_triage": """SELECT collected_at, component, likely_root_cause, severity, incident_title, summary
      FROM triaged""",
    "incident_steps": """SELECT incident_id, CAST(position - 1 AS INTEGER) AS position, recommended[position] AS step
      FROM (SELECT incident_id, recommended, unnest(range(1, len(recommended) + 1)) AS position FROM steps)""",
    "incident_reports": f"""SELECT incident_id, incident_title, severity, summary, likely_root_cause,
      '["' || component || '","PySpark Structured Streaming"]' AS affected_components,
      '["' || array_to_string(recommended, '","') || '"]' AS recommended_recovery_steps,
      {_quoted('["' + '","'.join(texts.PREVENTION_NOTES) + '"]')} AS prevention_notes,
      'mock' AS provider, collected_at AS created_at FROM steps""",
    "incident_evidence": """SELECT incident_id AS key, exception_message, failure_type, failed_topic, failed_batch_id,
      failed_records, quarantine_rate, retry_attempts, latest_checkpoint, redis_status, kafka_status FROM triaged""",
    "incident_contract": """SELECT incident_id,
      CASE WHEN failed_batch_id % 3 = 0 THEN '' ELSE 'severity,summary' END AS missing_fields
      FROM triaged WHERE failed_batch_id % 3 <> 2""",
    "incident_fallback": """SELECT incident_id,
      CASE WHEN failed_batch_id % 3 = 0 THEN 'External: ' || incident_title ELSE incident_title END AS incident_title,
      severity,
      CASE WHEN failed_batch_id % 3 = 0 THEN 'external summary' ELSE summary END AS summary,
      CASE WHEN failed_batch_id % 3 = 0 THEN 'external' ELSE 'mock' END AS provider,
      CASE WHEN failed_batch_id % 3 = 1 THEN 'Incident provider omitted fields: [''severity'', ''summary'']' END AS provider_fallback_reason
      FROM triaged""",
    "incident_latest": """SELECT incident_id, incident_title, severity, collected_at AS created_at FROM triaged
      ORDER BY collected_at DESC, incident_id DESC LIMIT 1""",
    "incidents_recent": """SELECT incident_id, severity, collected_at AS created_at FROM triaged
      ORDER BY collected_at DESC, incident_id DESC LIMIT 1000""",
    "incidents_recent_per_type": """SELECT failure_type, incident_id, collected_at AS created_at FROM triaged
      QUALIFY row_number() OVER (PARTITION BY failure_type ORDER BY collected_at DESC, incident_id DESC) <= 3""",
    "incident_input_checked": """SELECT 'input-' || event_id AS input_id,
      CASE WHEN event_id % 6 <> 0 THEN 'failure of evt-' || event_id ELSE 'Pipeline health threshold exceeded' END AS exception_message,
      CASE WHEN event_id % 5 <> 0 THEN event_id % 7 - 1 ELSE 0 END AS failed_records,
      CASE WHEN event_id % 8 <> 0 THEN round(value / 100, 4) ELSE 0 END AS quarantine_rate,
      CASE WHEN event_id % 4 <> 0 THEN event_id % 9 - 1 ELSE 0 END AS retry_attempts,
      CASE WHEN event_id % 3 = 0 THEN 'down' ELSE 'unknown' END AS redis_status, 'unknown' AS kafka_status
      FROM events WHERE NOT (event_id % 5 <> 0 AND event_id % 7 = 0) AND NOT (event_id % 8 <> 0 AND round(value / 100, 4) > 1)
        AND NOT (event_id % 4 <> 0 AND event_id % 9 = 0)""",
    "incident_input_rejected": """SELECT * FROM (SELECT 'input-' || event_id AS input_id, concat_ws(',',
        CASE WHEN event_id % 5 <> 0 AND event_id % 7 = 0 THEN 'failed_records' END,
        CASE WHEN event_id % 8 <> 0 AND round(value / 100, 4) > 1 THEN 'quarantine_rate' END,
        CASE WHEN event_id % 4 <> 0 AND event_id % 9 = 0 THEN 'retry_attempts' END) AS out_of_bounds FROM events)
      WHERE out_of_bounds <> ''""",
    "backoff_schedule": """, tries AS (SELECT event_id, ts, CAST(unnest(range(1, event_id % 6 + 2)) AS INTEGER) AS attempt
        FROM events WHERE event_type = 'error')
      SELECT 'operation-' || (event_id % 5) AS operation, attempt,
        'attempt ' || attempt || ' failed for evt-' || event_id AS exception, ts + to_seconds(attempt) AS timestamp,
        least(30.0, 2.0 * pow(2.0, attempt - 1)) AS delay_seconds,
        ts + to_seconds(attempt) + to_seconds(CAST(least(30.0, 2.0 * pow(2.0, attempt - 1)) AS BIGINT)) AS next_attempt_at
      FROM tries""",
    "retry_history": """, tries AS (SELECT event_id, ts, CAST(unnest(range(1, event_id % 6 + 2)) AS INTEGER) AS attempt
        FROM events WHERE event_type = 'error')
      SELECT 'operation-' || (event_id % 5) AS operation, count(*) AS retries, max(attempt) AS max_attempt,
        arg_max('attempt ' || attempt || ' failed for evt-' || event_id, ts + to_seconds(attempt)) AS last_exception,
        max(ts + to_seconds(attempt)) AS last_at FROM tries GROUP BY ALL""",
    "audit_latest": """SELECT CASE event_id % 3 WHEN 0 THEN 'restart_streaming_query' WHEN 1 THEN 'archive_corrupt_checkpoint'
        ELSE 'pipeline_supervisor_restart' END AS action, event_id % 4 <> 0 AS success, ts AS timestamp,
      'evt-' || event_id AS details FROM events ORDER BY timestamp DESC, action DESC LIMIT 500""",
    "stream_clean_equals_batch": """SELECT event_id, event_timestamp, event_type, region, event_value, processing_key,
      event_date FROM deduped""",
    "stream_three_queries": f"""SELECT 'clean_events' AS "table", count(*) AS records FROM deduped
      UNION ALL SELECT 'quarantine', count(*) FROM envelopes
      UNION ALL SELECT 'aggregates', count(*) FROM ({_windows("deduped", "5 minutes")})""",
    "stream_resumed_batch": """SELECT event_id, event_timestamp, processing_key, CAST(1 AS BIGINT) AS entries FROM deduped""",
    "stream_gate_ttl": """SELECT event_id, CAST(CASE WHEN CAST(substr(event_id, 5) AS BIGINT) % 3 = 0 THEN 2 ELSE 1 END AS BIGINT)
      AS times_written FROM deduped""",
    "stream_side_outputs": """, arrived AS (SELECT event_id, event_timestamp,
        kafka_timestamp + to_hours(CASE WHEN source_offset % 11 = 0 THEN 40 ELSE 0 END) AS seen_at FROM clean),
      parted AS (SELECT *, CASE WHEN seen_at < TIMESTAMP '2024-01-08 00:00:00' THEN 0 WHEN seen_at < TIMESTAMP '2024-01-16 00:00:00' THEN 1
        WHEN seen_at < TIMESTAMP '2024-01-24 00:00:00' THEN 2 ELSE 3 END AS part FROM arrived),
      tops AS (SELECT part, max(event_timestamp) AS top FROM parted GROUP BY part),
      marks AS (SELECT p.part, max(t.top) - INTERVAL 10 MINUTE AS mark FROM tops p LEFT JOIN tops t ON t.part < p.part GROUP BY p.part),
      judged AS (SELECT event_id, coalesce(event_timestamp <= mark, false) AS late FROM parted JOIN marks USING (part))
      SELECT event_id, CAST(least(count(*) FILTER (NOT late), 1) AS BIGINT) AS kept, count(*) FILTER (late) AS late,
        CAST(greatest(count(*) FILTER (NOT late) - 1, 0) AS BIGINT) AS duplicate FROM judged GROUP BY event_id""",
    "ledger_purged": "SELECT * FROM ledger_current",
    "compacted_clean": "SELECT event_id, source_offset, event_date, region, event_value FROM deduped",
    "stream_agg_equals_batch": _windows("deduped", "5 minutes"),
    "stream_lost_checkpoint_aggregates": _windows("deduped", "5 minutes"),
    "stream_lost_checkpoint_quarantine": """SELECT event_id, original_payload, error_type, error_message, failed_field,
      replay_eligible, retry_count FROM envelopes""",
    "stream_restart": """SELECT event_id, original_payload, error_type, error_message, failed_field, replay_eligible,
      retry_count FROM envelopes""",
}


def _statement(body: str) -> str:
    """Prefix the shared definitions; a body may start with more of its own after a comma."""
    return f"WITH {_EVENTS.rstrip()}\n{body.strip()}"


def oracle_sql() -> dict[str, str]:
    return {name: _statement(body) for name, body in SQL.items()}
