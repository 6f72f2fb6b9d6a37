import json

import pytest
from pyspark.sql import functions as F

from conftest import NOW, payload, raw_frame
from tidegate.model import LEDGER_SCHEMA, QUARANTINE_SCHEMA
from tidegate.operators import quarantine, replay, rules

BAD = payload(region="north-pole")


def record(text, *, eligible=True, tries=0, event_id="evt-ferry-3"):
    return (event_id, text, "quality_rule", "validation failed: region", "region", "2026-01-15 12:00:00", eligible, tries)


CASES = {
    "valid": (record(payload()), "replayed", "eligible and valid", 1),
    "ineligible": (record(payload(), eligible=False), "dead_lettered", "record is not replay eligible", 0),
    "eligibility unknown": (record(payload(), eligible=None), "dead_lettered", "record is not replay eligible", 0),
    "exhausted": (record("{}", tries=3), "dead_lettered", "maximum replay attempts exceeded", 3),
    "malformed": (record('{"event_id":'), "dead_lettered", "original payload is malformed", 0),
    "no payload": (record(None), "dead_lettered", "original payload is malformed", 0),
    "still invalid": (record(BAD), "deferred", "payload still fails validation", 1),
    "invalid, second try": (record(BAD, tries=1), "deferred", "payload still fails validation", 2),
    "invalid, last try": (record(BAD, tries=2), "dead_lettered", "payload still fails validation", 3),
    "count unknown": (record(BAD, tries=None), "deferred", "payload still fails validation", 1),
    "valid, last try": (record(payload(), tries=2), "replayed", "eligible and valid", 3),
}


@pytest.fixture(scope="module")
def decided(spark):
    rows = [(*case[0], n) for n, case in enumerate(CASES.values())]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in QUARANTINE_SCHEMA.fields)
    frame = spark.createDataFrame(rows, schema + ", n int")
    return replay.decide_replay(frame, now=NOW).cache()


@pytest.mark.parametrize("name", CASES)
def test_decision(decided, name):
    _, outcome, reason, count = CASES[name]
    row = decided.where(F.col("n") == list(CASES).index(name)).first()
    assert (row.outcome, row.reason, row.retry_count) == (outcome, reason, count)
    assert row.destination == ("events.dead_letter" if outcome == "dead_lettered" else "events.replay")
    failed = reason == "payload still fails validation"
    assert row.last_replay_error == ("validation failed: region" if failed else None)
    assert (row.last_replay_at is not None) == failed


def test_payloads(decided):
    rows = {list(CASES)[row.n]: json.loads(row.payload) for row in decided.collect()}
    sent = rows["valid"]
    assert sent["_replay"]["source"] == "quarantine" and sent["_replay"]["retry_count"] == 1
    assert sent["event_id"] == "evt-ferry-3" and sent["metadata"] == {"pier": "north"}
    back = rows["still invalid"]
    assert back["retry_count"] == 1 and back["original_payload"] == BAD and "_replay" not in back
    assert rows["exhausted"]["retry_count"] == 3


def test_a_replayed_payload_keeps_all_its_members(spark):
    text = payload(extra={"keep": [1, {"a": None}]}, metadata={"a": {"b": 1}, "c": 2}) + " \n"
    names = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in QUARANTINE_SCHEMA.fields)

    def sent(original, tries):
        row = replay.decide_replay(spark.createDataFrame([record(original, tries=tries)], names), now=NOW).first()
        assert row.outcome == "replayed"
        return row.payload

    once = sent(text, 0)
    twice = sent(once, 1)
    for found, tries in ((once, 1), (twice, 2)):
        body = json.loads(found)
        assert body.pop("_replay")["retry_count"] == tries and found.count("_replay") == 1
        assert body == json.loads(text)


def test_valid_replay_goes_to_two_topics(decided):
    one = decided.where("n = 0")
    assert sorted(row.topic for row in replay.replay_messages(one).collect()) == ["events.raw", "events.replay"]
    assert replay.replay_messages(decided).count() == len(CASES) + 2


def test_counts_run_and_dry_run(decided):
    counts = replay.replay_counts(decided).first()
    assert (counts.replayed, counts.dead_lettered, counts.deferred) == (2, 6, 3)
    assert replay.replay_run(decided, NOW).first().completed_at is not None
    where = {row.destination: row.records for row in replay.dry_run(decided).collect()}
    assert where == {"events.replay": 5, "events.dead_letter": 6}
    assert replay.dead_letters(decided).count() == 6


def test_deferred_records_wait_longer_each_time(decided):
    rows = replay.deferred_records(decided).collect()
    waits = sorted((row.retry_count, (row.next_attempt_at - row.last_replay_at).total_seconds()) for row in rows)
    assert waits == [(1, 2.0), (1, 2.0), (2, 4.0)]


def test_replayed_event_that_fails_again_keeps_its_count(spark, decided):
    sent = decided.where("n = 0").first().payload
    broken = sent.replace("us-east", "north-pole")
    checked = rules.check_events(raw_frame(spark, [broken, BAD]), now=NOW)
    rows = quarantine.quarantine_envelope(rules.invalid_events(checked), now=NOW).collect()
    assert sorted(row.retry_count for row in rows) == [0, 1]


def test_replayed_rows_are_deduplicated_and_gated(spark, decided):
    empty = spark.createDataFrame([], LEDGER_SCHEMA)
    rows = replay.replayed_clean(decided, empty, now=NOW).collect()
    assert [row.event_id for row in rows] == ["evt-ferry-3"]
    assert rows[0].event_type == "purchase" and len(rows[0].processing_key) == 64
    written = spark.createDataFrame([("evt-ferry-3", "written")], "event_id string, status string").select(
        "*", F.lit(NOW).cast("timestamp").alias("updated_at"),
        (F.lit(NOW).cast("timestamp") + F.expr("interval 1 day")).alias("expires_at"),
    )
    assert replay.replayed_clean(decided, written, now=NOW).count() == 0


def test_envelope_has_its_eight_columns(spark):
    checked = rules.check_events(raw_frame(spark, ["nonsense", BAD]), now=NOW)
    frame = quarantine.quarantine_envelope(rules.invalid_events(checked), now=NOW)
    assert frame.columns == QUARANTINE_SCHEMA.fieldNames()
    rows = {row.error_type: row for row in frame.collect()}
    assert not rows["malformed_json"].replay_eligible and rows["malformed_json"].event_id is None
    assert rows["quality_rule"].replay_eligible and rows["quality_rule"].original_payload == BAD
    assert rows["quality_rule"].processing_timestamp == "2026-01-15 13:00:00"


def test_audits_are_cut_out_as_the_pattern_says_and_bare_payloads_pass_it_by(spark):
    audit = ',"_replay":{"retry_count":1,"source":"quarantine"}'
    texts = [payload(), payload() + " ", payload() + "\n\t ", payload()[:-1] + audit + "}", payload()[:-1] + audit + "} \n",
             payload()[:-1] + audit + audit + "}", payload(note=audit), payload(note={"_replay": {"a": 1}})]
    rows = spark.createDataFrame([record(text) for text in texts], QUARANTINE_SCHEMA)
    sent = replay.decide_replay(rows, now=NOW).withColumn("plain", F.regexp_replace("original_payload", replay.EARLIER_AUDIT, ""))
    for row in sent.select("outcome", "payload", "plain").collect():
        assert row.outcome == "replayed"
        assert row.payload.startswith(row.plain[:-1] + ',"_replay":{"replayed_at"') and json.loads(row.payload)
    plan = sent.select("payload")._jdf.queryExecution().optimizedPlan().toString()
    assert "EndsWith(original_payload" in plan, plan
