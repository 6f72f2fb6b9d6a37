"""Parsing and the ordered rules, one row per case."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import NOW, payload, raw_frame
from tidegate.model import RuleConfig
from tidegate.operators import rules
from tidegate.operators.parsing import parse_events
from tidegate.operators.transform import transform_events
from tidegate.session import overridden

CASES = {
    "sound": (payload(), None, None),
    "null payload": (None, "malformed_json", None),
    "two objects": (payload() + payload(), "malformed_json", None),
    "two objects and a comma": (payload() + "," + payload(), "malformed_json", None),
    "text behind": (payload() + " and more", "malformed_json", None),
    "bracket behind": (payload() + "]", "malformed_json", None),
    "brace behind": (payload() + "}", "malformed_json", None),
    "object in a list": ("[" + payload() + "]", "schema_validation", "event_id"),
    "white space around": ("  " + payload() + "\n", None, None),
    "closing member within": (payload()[:-1] + ',"_end_of_payload":1}', None, None),
    "closing member named in text": (payload(session_id="_end_of_payload"), None, None),
    "closing member behind": (payload() + ',"_end_of_payload":1', "malformed_json", None),
    "member behind": (payload() + ',"x":1', "malformed_json", None),
    "another event behind": (payload() + ',"event":' + payload(event_id="evt-2"), "malformed_json", None),
    "another list behind": (payload() + "],[" + payload(), "malformed_json", None),
    "two comma": (payload() + ",", "malformed_json", None),
    "closed early": (payload() + '}{"a":1', "malformed_json", None),
    "empty payload": ("", "malformed_json", None),
    "blank payload": ("   ", "malformed_json", None),
    "truncated": ('{"event_id":', "malformed_json", None),
    "prose": ("not json", "malformed_json", None),
    "trailing comma in a member": (payload()[:-2] + ",}}", "malformed_json", None),
    "trailing comma": ('{"event_id":"a",}', "malformed_json", None),
    "single quotes": ("{'event_id':'a'}", "malformed_json", None),
    "bare number": ("5", "schema_validation", "event_id"),
    "array": ("[1,2]", "schema_validation", "event_id"),
    "empty object": ("{}", "schema_validation", "event_id"),
    "no id": (payload(event_id=...), "schema_validation", "event_id"),
    "null id": (payload(event_id=None), "schema_validation", "event_id"),
    "blank id": (payload(event_id="  "), "schema_validation", "event_id"),
    "no time": (payload(event_timestamp=...), "malformed_timestamp", "event_timestamp"),
    "bad time": (payload(event_timestamp="half past nine"), "malformed_timestamp", "event_timestamp"),
    "clock only": (payload(event_timestamp="12:00"), "malformed_timestamp", "event_timestamp"),
    "no such day": (payload(event_timestamp="2026-02-30T00:00:00Z"), "malformed_timestamp", "event_timestamp"),
    "no type": (payload(event_type=...), "schema_validation", "event_type"),
    "blank type": (payload(event_type=" "), "schema_validation", "event_type"),
    "unknown type": (payload(event_type="unknown"), "quality_rule", "event_type"),
    "upper-case type": (payload(event_type="PURCHASE"), "quality_rule", "event_type"),
    "nobody": (payload(user_id=None, device_id=...), "quality_rule", "user_id|device_id"),
    "user only": (payload(device_id=...), None, None),
    "device only": (payload(user_id=...), None, None),
    "empty user and device": (payload(user_id="", device_id=""), None, None),
    "no source": (payload(source_system=...), "schema_validation", "source_system"),
    "blank source": (payload(source_system=" "), "schema_validation", "source_system"),
    "no region": (payload(region=...), "schema_validation", "region"),
    "unknown region": (payload(region="north-pole"), "quality_rule", "region"),
    "no version": (payload(payload_version=...), "schema_validation", "payload_version"),
    "unknown version": (payload(payload_version="7.3"), "quality_rule", "payload_version"),
    "no metadata": (payload(metadata=...), "quality_rule", "metadata"),
    "empty metadata": (payload(metadata={}), "quality_rule", "metadata"),
    "metadata is text": (payload(metadata="x"), "quality_rule", "metadata"),
    "nested metadata": (payload(metadata={"a": {"b": 1}, "c": 2}), None, None),
    "no value": (payload(event_value=...), None, None),
    "null value": (payload(event_value=None), None, None),
    "text value": (payload(event_value="abc"), "quality_rule", "event_value"),
    "number as text": (payload(event_value="3.7"), "quality_rule", "event_value"),
    "boolean value": (payload(event_value=True), "quality_rule", "event_value"),
    "object value": (payload(event_value={}), "quality_rule", "event_value"),
    "NaN text": (payload(event_value="NaN"), "quality_rule", "event_value"),
    "too large": (payload().replace("3.75", "1e999"), "quality_rule", "event_value"),
    "integer value": (payload(event_value=3), None, None),
    "negative value": (payload(event_value=-6.5), "quality_rule", "event_value"),
    "negative error": (payload(event_value=-6.5, event_type="error_event"), None, None),
    "at tolerance": (payload(event_timestamp="2026-01-15T13:05:00Z"), None, None),
    "beyond tolerance": (payload(event_timestamp="2026-01-15T13:05:01Z"), "quality_rule", "event_timestamp"),
    "no arrival": (payload(ingestion_timestamp=...), "malformed_timestamp", "ingestion_timestamp"),
    "bad arrival": (payload(ingestion_timestamp="x"), "malformed_timestamp", "ingestion_timestamp"),
    "extra member": (payload(extra=[1]), None, None),
    "repeated member": (payload()[:-1] + ',"event_id":"evt-2"}', None, None),
    "other number fields as text": (payload(event_id=5), None, None),
    # Order: the first rule that fails names the error.
    "id before time": (payload(event_id="", event_timestamp="x"), "schema_validation", "event_id"),
    "time before type": (payload(event_timestamp="x", event_type="x"), "malformed_timestamp", "event_timestamp"),
    "value before future": (payload(event_value=-1, event_timestamp="2071-05-06T00:00:00Z"), "quality_rule", "event_value"),
    "future before arrival": (payload(event_timestamp="2071-05-06T00:00:00Z", ingestion_timestamp="x"), "quality_rule", "event_timestamp"),
    "text value among other type errors": (payload(event_value="abc", metadata="x"), "quality_rule", "metadata"),
}


@pytest.fixture(scope="module")
def judged(spark):
    names = list(CASES)
    checked = rules.check_events(raw_frame(spark, [CASES[name][0] for name in names]), now=NOW)
    return {names[row.source_offset]: row for row in checked.collect()}


@pytest.mark.parametrize("name", CASES)
def test_first_failure(judged, name):
    _, error_type, failed_field = CASES[name]
    row = judged[name]
    assert (row.error_type, row.failed_field) == (error_type, failed_field)
    assert row.is_valid == (error_type is None)


def test_messages(judged):
    assert judged["sound"].error_message is None
    assert judged["prose"].error_message == "payload is not valid JSON or does not match the event schema"
    assert judged["nobody"].error_message == "validation failed: user_id|device_id"


def test_every_row_is_valid_or_invalid(spark):
    checked = rules.check_events(raw_frame(spark, [case[0] for case in CASES.values()]), now=NOW)
    split = rules.valid_events(checked).count() + rules.invalid_events(checked).count()
    assert split == len(CASES)


def test_clock_may_be_a_column(spark):
    frame = raw_frame(spark, [payload(event_timestamp="2026-01-15T13:30:00Z")])
    late = rules.check_events(frame, now=F.col("kafka_timestamp")).first()
    later = rules.check_events(frame, now=F.col("kafka_timestamp") + F.expr("interval 1 hour")).first()
    assert late.failed_field == "event_timestamp" and later.is_valid
    assert rules.check_events(frame, now=dt.datetime(2026, 1, 15, 14)).first().is_valid


def test_rules_follow_the_configuration(spark):
    config = RuleConfig.from_mapping(
        {
            "required_fields": ["event_id"],
            "allowed_event_types": ["click", "it's"],
            "identity": {"require_user_or_device": False},
            "event_value": {"non_negative_event_types": ["click"]},
            "event_timestamp": {"future_tolerance_minutes": 0},
        }
    )
    payloads = [
        payload(event_type="it's", event_value=-5, user_id=None, device_id=None),
        payload(event_type="purchase"),
        payload(event_type="click", event_value=-5),
        payload(event_type="click", source_system=...),
        payload(event_type="click", event_timestamp="2026-01-15T13:00:01Z"),
    ]
    rows = rules.check_events(raw_frame(spark, payloads), config=config, now=NOW).orderBy("source_offset")
    assert [row.failed_field for row in rows.collect()] == [
        None, "event_type", "event_value", None, "event_timestamp",
    ]


def test_rule_files(tmp_path):
    assert RuleConfig.from_mapping({}) == RuleConfig()
    path = tmp_path / "rules.json"
    path.write_text('{"allowed_regions": ["north-pole"], "metadata": {"required": false}}')
    config = RuleConfig.from_file(str(path))
    assert config.regions == ("north-pole",) and not config.require_metadata


def test_types_from_a_table_keep_the_rule_order(spark):
    allowed = spark.createDataFrame([("purchase",), ("purchase",), (None,)], "event_type string")
    payloads = [payload(), payload(event_type="click"), payload(event_type="click", region="x"), payload(event_type=" ")]
    rows = rules.check_against_table(raw_frame(spark, payloads), allowed, now=NOW).orderBy("source_offset").collect()
    assert [(row.error_type, row.failed_field) for row in rows] == [
        (None, None), ("quality_rule", "event_type"), ("quality_rule", "event_type"), ("schema_validation", "event_type"),
    ]


def test_short_list_is_broadcast_whatever_table_it_comes_from(spark):
    """Spark's own size check is off: only the counted list can have placed the types beside every event."""
    allowed = spark.createDataFrame([("purchase",)] * 3, "event_type string")
    with overridden(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}):
        judged = rules.check_against_table(raw_frame(spark, [payload(), payload(event_type="click")]), allowed, now=NOW)
        plan = judged._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        assert sorted(row.is_valid for row in judged.collect()) == [False, True]


def test_transformation(spark):
    frame = raw_frame(spark, [payload(event_timestamp="2026-01-15T23:30:00-02:00", event_value=7)])
    row = transform_events(rules.valid_events(rules.check_events(frame, now="2026-02-01T00:00:00Z")), now=NOW).first()
    assert row.event_timestamp == dt.datetime(2026, 1, 16, 1, 30)
    assert row.event_date == dt.date(2026, 1, 16)
    assert row.processed_at == dt.datetime(2026, 1, 15, 13)
    assert row.event_value == 7.0 and isinstance(row.event_value, float)
    assert len(row.processing_key) == 64
    assert row.metadata == {"pier": "north"}
    assert not {"_parsed", "_times", "is_valid", "error_type"} & set(row.asDict())
    assert {"raw_payload", "source_topic", "source_partition", "source_offset", "kafka_timestamp"} <= set(row.asDict())


def test_payload_is_parsed_once_in_every_branch(spark):
    checked = rules.check_events(raw_frame(spark, [payload()]), now=NOW)
    for branch in (rules.valid_events(checked), rules.invalid_events(checked), checked):
        plan = branch._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json(") == 1
        assert "PythonUDF" not in plan and "BatchEvalPython" not in plan


def test_parse_keeps_the_raw_text(spark):
    text = payload(extra="kept only here")
    row = parse_events(raw_frame(spark, [text])).first()
    assert row.raw_payload == text and "extra" not in row.asDict()
