import datetime as dt

from pyspark.sql import functions as F

from conftest import payload
from tidegate.model import QUARANTINE_SCHEMA
from tidegate.operators.aggregate import aggregate_events
from tidegate.plans.replay_job import ReplayJob, corrected_windows
from tidegate.session import scratch_dir
from tidegate.sinks.tables import utc_day, write_batch
from tidegate.streaming.batches import BatchTables

NOW = dt.datetime(2026, 1, 15, 13, tzinfo=dt.timezone.utc)
LATER = dt.datetime(2026, 1, 15, 14, tzinfo=dt.timezone.utc)


def quarantined(spark, tables):
    texts = [
        (payload(event_id="a"), True), (payload(event_id="a"), True), (payload(event_id="b"), True),
        (payload(region="north-pole"), True), ('{"event_id":', False),
        (payload(event_id="soon", event_timestamp="2026-01-15T13:30:00Z"), True),
    ]
    rows = [("x", text, "quality_rule", "m", "f", f"2026-01-15 12:00:0{n}", ok, 0) for n, (text, ok) in enumerate(texts)]
    frame = spark.createDataFrame(rows, QUARANTINE_SCHEMA)
    write_batch(frame, tables.path("quarantine"), utc_day(int(NOW.timestamp())), "q", 0)


def ids(frame):
    return sorted(row.event_id for row in frame.collect())


def test_replay_runs(spark):
    tables = BatchTables(spark, scratch_dir(spark, "replay"))
    quarantined(spark, tables)
    job = ReplayJob(tables, "one", NOW)
    assert {row.destination: row.records for row in job.dry_run().collect()} == {"events.replay": 5, "events.dead_letter": 1}
    assert tables.clean().count() == 0

    for _ in range(2):  # a repeated run leaves the same tables
        counts = job.run().first()
        assert (counts.replayed, counts.dead_lettered, counts.deferred) == (3, 1, 2)
        assert ids(tables.clean()) == ["a", "b"]
        sent = spark.read.parquet(tables.path("replay_messages"))
        assert {row.topic: row["count"] for row in sent.groupBy("topic").count().collect()} == {
            "events.replay": 5, "events.raw": 3, "events.dead_letter": 1,
        }
        assert {row.status for row in tables.ledger().collect()} == {"replayed"} and tables.ledger().count() == 2
        assert spark.read.parquet(tables.path("replay_runs")).count() == 1

    second = ReplayJob(tables, "two", LATER)
    assert sorted(row.retry_count for row in second.pending().collect()) == [1, 1]
    counts = second.run().first()
    assert (counts.replayed, counts.dead_lettered, counts.deferred) == (1, 0, 1)
    assert ids(tables.clean()) == ["a", "b", "soon"]
    early = ReplayJob(tables, "early", LATER + dt.timedelta(seconds=3))
    assert early.pending().count() == 0  # the second failure waits four seconds
    third = ReplayJob(tables, "three", LATER + dt.timedelta(seconds=4)).run().first()
    assert (third.replayed, third.dead_lettered, third.deferred) == (0, 1, 0)
    assert ReplayJob(tables, "four", LATER + dt.timedelta(days=1)).pending().count() == 0

    want = aggregate_events(tables.clean())
    got = corrected_windows(tables).select(*want.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert tables.metrics().agg(F.sum("valid")).first()[0] == 3


def test_replay_does_not_pass_the_gate_twice(spark):
    tables = BatchTables(spark, scratch_dir(spark, "replay"))
    quarantined(spark, tables)
    ReplayJob(tables, "one", NOW).run()
    frame = spark.createDataFrame(
        [("x", payload(event_id="a", device_id="other"), "t", "m", "f", "2026-01-15 12:30:00", True, 0)], QUARANTINE_SCHEMA
    )
    write_batch(frame, tables.path("quarantine"), utc_day(int(NOW.timestamp())), "q", 1)
    assert ReplayJob(tables, "two", LATER).run().first().replayed == 2
    assert ids(tables.clean()) == ["a", "b", "soon"]


def test_a_log_gets_each_message_once(spark):
    root = scratch_dir(spark, "replay")
    sent = []

    def send(messages):
        sent.append(sorted(map(tuple, messages.collect())))
        if len(sent) == 1:
            raise RuntimeError("lost before the mark")

    tables = BatchTables(spark, root, send=send)
    quarantined(spark, tables)
    for _ in range(3):
        try:
            ReplayJob(tables, "one", NOW).run()
        except RuntimeError:
            pass
    assert len(sent) == 2 and sent[0] == sent[1]  # the same ids again, and then no more
    assert len({row[-1] for row in sent[0]}) == len(sent[0]) == 9
