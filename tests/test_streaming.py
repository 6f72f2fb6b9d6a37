"""The streams against their batch twins, restarts, and batches that fail half way."""

from collections import Counter
from datetime import datetime, timedelta, timezone

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidegate.operators import metrics
from tidegate.operators.aggregate import aggregate_events
from tidegate.operators.dedup import dedup_first
from tidegate.operators.quarantine import quarantine_envelope
from tidegate.operators.rules import check_events, invalid_events, valid_events
from tidegate.operators.triage import classify_failures
from tidegate.operators.transform import transform_events
from tidegate.plans import fixture, streams
from tidegate.plans.fixture import NOW, wire_records
from tidegate.plans.streams import LAST, SENTINEL_ID, closing_record, compacted_clean, run_gated
from tidegate.session import ROCKSDB, overridden, scratch_dir
from tidegate.sources.checkpoints import latest_commit, state_operators, state_rows
from tidegate.sources.wire import file_stream, raw_envelope
from tidegate.streaming.batches import BatchTables
from tidegate.streaming.flows import Flows, build_flows
from tidegate.streaming import gate, run as started
from tidegate.streaming.run import drain, failures_of, start_flows

PARTS = ("2024-01-01", "2024-01-04", "2024-01-07")


@pytest.fixture(scope="module")
def wire(spark, sf_dir):
    """Three days' worth of parts of the small wire records, as one frame per part."""
    records = wire_records(spark, sf_dir).where(F.col("timestamp") < F.lit(PARTS[-1]).cast("timestamp")).cache()
    bounds = [F.lit(day).cast("timestamp") for day in PARTS]
    return [
        records.where((F.col("timestamp") >= low) & (F.col("timestamp") < high))
        for low, high in zip(bounds, bounds[1:])
    ]


def run(spark, root, tables, names, **options):
    flows = build_flows(file_stream(spark, f"{root}/wire"), now=NOW)
    drain(start_flows(flows, tables, f"{root}/checkpoints", trigger="availableNow", names=names,
                      state_partitions=2, **options))


def batch_twin(wire, closing=None):
    records = wire[0].unionByName(wire[1])
    if closing is not None:
        records = records.unionByName(closing)
    return check_events(raw_envelope(records), now=NOW)


def ids(frame):
    return sorted(row.event_id for row in frame.select("event_id").collect())


def test_three_queries_over_two_runs_equal_the_batch(spark, wire):
    root = scratch_dir(spark, "test")
    tables = BatchTables(spark, f"{root}/tables")
    names = ("clean", "quarantine", "aggregates")
    wire[0].write.mode("append").parquet(f"{root}/wire")
    run(spark, root, tables, names)
    wire[1].unionByName(closing_record(spark)).write.mode("append").parquet(f"{root}/wire")
    run(spark, root, tables, names)

    checked = batch_twin(wire, closing_record(spark))
    clean = dedup_first(transform_events(valid_events(checked), now=NOW))
    assert ids(tables.clean()) == ids(clean)
    columns = [c for c in quarantine_envelope(invalid_events(checked), now=NOW).columns]
    expected = quarantine_envelope(invalid_events(checked), now=NOW)
    got = tables.quarantine().select(*columns)
    assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0

    windows = aggregate_events(clean.where(F.col("event_id") != SENTINEL_ID))
    got = tables.aggregates().select(*windows.columns)
    assert got.exceptAll(windows).count() == 0 and windows.exceptAll(got).count() == 0

    totals = tables.metrics().agg(F.sum("valid"), F.sum("quarantined"), F.sum("aggregate_rows"), F.sum("duplicates")).first()
    assert tuple(totals) == (clean.count(), expected.count(), windows.count(), 0)
    history = metrics.rate_history(metrics.timeline(tables.metrics()), chunk=metrics.SECONDS_PER_DAY)
    last = history.orderBy(F.desc("total_valid"), F.desc("total_quarantined")).first()
    assert (last.total_valid, last.total_quarantined, last.breached) == (clean.count(), expected.count(), True)
    assert history.where("alert").count() == 1
    assert tables.messages("events.transformed").count() == clean.count()
    assert tables.messages("events.quarantine").where("key IS NULL").count() == expected.count()
    assert tables.messages("events.aggregated").count() == windows.count()
    statuses = {row.status: row["count"] for row in tables.ledger().groupBy("status").count().collect()}
    assert statuses["written"] == clean.count()
    marked = invalid_events(checked).where("event_id IS NOT NULL").select("event_id").distinct()
    assert statuses["quarantined"] == marked.count()

    commits = latest_commit(spark, f"{root}/checkpoints", "clean").first().latest_commit
    assert commits >= 2
    assert state_operators(spark, f"{root}/checkpoints", "clean").first().operatorName == "dedupeWithinWatermark"
    assert state_rows(spark, f"{root}/checkpoints", "clean").count() >= 1


class Interrupted(BatchTables):
    """Fails once, after the clean rows of a batch were written."""

    failed = False

    def _note(self, entries, stamp):
        if stamp.batch_id > 0 and not Interrupted.failed:
            Interrupted.failed = True
            raise RuntimeError("lost between two writes")
        super()._note(entries, stamp)


def test_batch_that_failed_after_its_write_is_repeated_once(spark, wire):
    root = scratch_dir(spark, "test")
    tables = Interrupted(spark, f"{root}/tables")
    wire[0].write.mode("append").parquet(f"{root}/wire")
    run(spark, root, tables, ("clean",))
    wire[1].write.mode("append").parquet(f"{root}/wire")
    flows = build_flows(file_stream(spark, f"{root}/wire"), now=NOW)
    queries = start_flows(flows, tables, f"{root}/checkpoints", trigger="availableNow", names=("clean",),
                          state_partitions=2)
    with pytest.raises(Exception, match="lost between two writes"):
        drain(queries)
    (failure,) = classify_failures(failures_of(spark, queries)).collect()
    assert "lost between two writes" in failure.message and failure.metadata == {"checkpoint": "clean"}
    run(spark, root, tables, ("clean",))
    expected = ids(dedup_first(transform_events(valid_events(batch_twin(wire)), now=NOW)))
    assert ids(tables.clean()) == expected
    assert tables.ledger().count() == len(expected)


def test_lost_checkpoint_admits_nothing_twice(spark, wire):
    root = scratch_dir(spark, "test")
    tables = BatchTables(spark, f"{root}/tables")
    wire[0].write.mode("append").parquet(f"{root}/wire")
    run(spark, root, tables, ("clean",))
    before = ids(tables.clean())
    flows = build_flows(file_stream(spark, f"{root}/wire"), now=NOW)
    drain(start_flows(flows, tables, f"{root}/other", trigger="availableNow", names=("clean",), state_partitions=2))
    assert ids(tables.clean()) == before
    counts = tables.metrics().agg(F.sum("valid"), F.sum("duplicates")).first()
    assert tuple(counts) == (len(before), len(before))


def test_late_rows_are_dropped_and_ids_are_forgotten(spark, sf_dir):
    """A row an hour behind the watermark is dropped; unbounded dedup remembers old ids."""
    root = scratch_dir(spark, "test")

    def record(event_id, at):
        body = (f'{{"event_id":"{event_id}","device_id":"d","event_type":"click","event_timestamp":"{at}",'
                f'"ingestion_timestamp":"{at}","source_system":"web","region":"us-east","payload_version":"1.0",'
                '"metadata":{"k":"0"}}')
        return closing_record(spark).withColumn("value", F.lit(body).cast("binary"))

    arrivals = [
        [record("a", "2024-01-01T00:00:00Z")],
        [record("b", "2024-01-01T06:00:00Z")],
        [record("late", "2024-01-01T05:00:00Z"), record("a", "2024-01-01T06:30:00Z"), record("b", "2024-01-01T06:00:00Z")],
    ]
    tables = {bounded: BatchTables(spark, f"{root}/tables-{bounded}", ttl_seconds=0) for bounded in (True, False)}
    for batch in arrivals:
        for part in batch:
            part.write.mode("append").parquet(f"{root}/wire")
        for bounded, target in tables.items():
            flows = build_flows(file_stream(spark, f"{root}/wire"), now=NOW, bounded_dedup=bounded)
            drain(start_flows(flows, target, f"{root}/checkpoints-{bounded}", trigger="availableNow",
                              names=("clean",), state_partitions=1))
    assert ids(tables[True].clean()) == ["a", "a", "b"]
    assert ids(tables[False].clean()) == ["a", "b"]


def test_rows_are_dealt_to_tasks_of_bounded_size(spark, monkeypatch):
    monkeypatch.setattr(fixture, "TASK_ROWS", 2)
    cores = spark.sparkContext.defaultParallelism
    dealt = fixture.spread(spark.range(0, 5 * cores, 1, cores + 1))
    assert dealt.rdd.getNumPartitions() == 3 * cores
    assert sorted(row.id for row in dealt.collect()) == list(range(5 * cores))
    assert fixture.spread(spark.range(0, 5, 1, 1)).rdd.getNumPartitions() == cores


def test_compacted_rows_are_made_once(spark):
    made = spark.sparkContext.accumulator(0)

    def count(value):
        made.add(1)
        return value

    rows = spark.range(30).select(
        F.concat(F.lit("evt-"), "id").alias("event_id"), F.when(F.col("id") < 24, F.col("id")).alias("source_offset"),
        F.lit("2024-01-05").cast("date").alias("event_date"), F.lit("us-east").alias("region"),
        F.udf(count, "double")(F.col("id").cast("double")).alias("event_value"),
    )
    got = compacted_clean(spark, "", rows).select("event_id", "source_offset", "event_value").collect()
    assert sorted((r.source_offset, r.event_id, r.event_value) for r in got) == [(n, f"evt-{n}", float(n)) for n in range(24)]
    assert made.value == 30


def test_gate_state_is_dealt_to_all_cores(spark):
    root = scratch_dir(spark, "gate-partitions")
    closing_record(spark).write.parquet(f"{root}/wire")
    run_gated(spark, BatchTables(spark, f"{root}/tables"), f"{root}/wire", f"{root}/checkpoints", LAST)
    gate = state_operators(spark, f"{root}/checkpoints", "clean").where("operatorName LIKE 'transformWithState%'").first()
    assert gate.numPartitions == spark.sparkContext.defaultParallelism


DAY = 24 * 3600
GATE_ROWS = "event_id string, source_partition int, source_offset long, processed_at timestamp"


class CountedMap:
    """Map state in a dict, which counts what it is asked."""

    def __init__(self):
        self.entries, self.asked = {}, 0

    def containsKey(self, key):
        self.asked += 1
        return key in self.entries

    def getValue(self, key):
        self.asked += 1
        return self.entries.get(key)

    def updateValue(self, key, value):
        self.asked += 1
        self.entries[key] = value

    def getMapState(self, *described):
        return self


def test_gate_asks_its_state_once_for_all_rows_of_an_entry():
    state, processor = CountedMap(), gate.written_ids(DAY, ["event_id"])
    processor.init(state)

    def seen(ids, now):
        parts = [pd.DataFrame({"event_id": ids[n::2], gate.BUCKET: 0, gate.CLOCK: now}) for n in range(2)]
        marked = pd.concat(list(processor.handleInputRows((0,), iter(parts), None)))
        return [bool(x) for x in marked.set_index("event_id").loc[ids, "_seen"]]

    names = [f"evt-{n}" for n in range(1000)]
    taken = pd.DataFrame({"event_id": names[:100], gate.BUCKET: 0, "at": [10] * 50 + [500] * 50})
    processor.handleInitialState((0,), taken, None)
    assert seen(names, DAY + 10) == [False] * 50 + [True] * 50 + [False] * 900
    assert seen(names, DAY + 20) == [True] * 1000
    assert seen(names, DAY + 501) == [True] * 50 + [False] * 50 + [True] * 900
    assert state.asked <= 4 * 3


def test_gate_entries_are_rid_of_expired_ids():
    state, processor = CountedMap(), gate.written_ids(DAY, ["event_id"])
    processor.init(state)
    for n in range(20):
        part = pd.DataFrame({"event_id": [f"evt-{n}", None], gate.BUCKET: 3, gate.CLOCK: n * DAY // 2})
        assert [list(x["_seen"]) for x in processor.handleInputRows((0,), iter([part]), None)] == [[False, False]]
    assert state.entries == {(3,): (["evt-18", "evt-19"], [9 * DAY, 19 * DAY // 2])}


def test_no_key_of_the_gate_holds_many_of_the_ids(spark):
    placed = spark.range(200_000).select(*gate.dealt(F.concat(F.lit("evt-"), "id")))
    shards = placed.groupBy(gate.SHARD).agg(F.count("*").alias("ids"), F.count_distinct(gate.BUCKET).alias("entries"))
    most, entries, keys = shards.agg(F.max("ids"), F.max("entries"), F.count("*")).first()
    assert most <= 300 and entries <= gate.BUCKETS and keys == gate.SHARDS


def test_gate_in_state_over_batches(spark):
    """Three runs on one checkpoint against plain Python: ids taken over, repeated, expired and missing."""
    root, start = scratch_dir(spark, "gate-batches"), datetime(2024, 2, 1, tzinfo=timezone.utc)
    written = [(f"evt-{n}", start - timedelta(hours=25 if n % 2 else 1)) for n in range(0, 300, 3)]
    batches = [
        [(None if n % 50 == 7 else f"evt-{n}", n % 3, n, start + timedelta(hours=hours)) for n in range(low, high)]
        for hours, low, high in ((0, 0, 200), (12, 100, 400), (24, 0, 500))
    ]
    taken = spark.createDataFrame(written, "event_id string, processed_at timestamp")
    settings = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB, "spark.sql.shuffle.partitions": "4", gate.NO_DATA_BATCHES: "false"}
    at, wanted = dict(written), Counter()
    for number, rows in enumerate(batches):
        spark.createDataFrame([*rows, *rows[:5]], GATE_ROWS).coalesce(1).write.mode("append").parquet(f"{root}/in")
        gated = gate.gated_in_state(spark.readStream.schema(GATE_ROWS).parquet(f"{root}/in"), DAY, taken)
        with overridden(spark, settings):
            gated.writeStream.format("parquet").option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start(
                f"{root}/out").awaitTermination()
        for event_id, _, offset, now in [*rows, *rows[:5]]:
            seen = event_id is not None and event_id in at and at[event_id] > now - timedelta(seconds=DAY)
            if event_id is not None and not seen:
                at[event_id] = now
            wanted[event_id, offset, now.timestamp(), seen] += 1
    got = spark.read.parquet(f"{root}/out").selectExpr("event_id", "source_offset", "double(unix_seconds(processed_at)) AS at", "_seen")
    assert Counter(tuple(row) for row in got.collect()) == wanted


def test_gated_stream_bounds_the_memory_of_its_state(spark, monkeypatch):
    used = {}
    names = [f"spark.sql.streaming.stateStore.rocksdb.{x}" for x in ("boundedMemoryUsage", "maxMemoryUsageMB")]
    start = started.start_query

    def noting(*args, **options):
        used.update({name: spark.conf.get(name, None) for name in names})
        return start(*args, **options)

    monkeypatch.setattr(started, "start_query", noting)
    root = scratch_dir(spark, "gate-memory")
    closing_record(spark).write.parquet(f"{root}/wire")
    run_gated(spark, BatchTables(spark, f"{root}/tables"), f"{root}/wire", f"{root}/checkpoints", LAST)
    assert used[names[0]] == "true" and int(used[names[1]]) <= 500
    assert spark.conf.get(names[0], "false") == "false"


def test_gate_state_partitions_grow_with_the_records(spark, monkeypatch):
    root, cores = scratch_dir(spark, "gate-grows"), spark.sparkContext.defaultParallelism
    spark.range(100).write.parquet(f"{root}/wire")
    assert streams.state_partitions(spark, f"{root}/wire") == cores
    monkeypatch.setattr(streams, "PARTITION_RECORDS", 5)
    assert streams.state_partitions(spark, f"{root}/wire") == cores * -(-100 // (cores * 5))


def test_state_rows_are_not_counted_and_methods_stay_small(spark, monkeypatch):
    """A stream keeps the settings it is started under: no read before each write of the state."""
    seen = {}
    names = ("spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows", "spark.sql.codegen.hugeMethodLimit")
    monkeypatch.setattr(started, "start_query", lambda *a, **k: seen.update({n: spark.conf.get(n, None) for n in names}))
    root, rows = scratch_dir(spark, "settings"), spark.range(1)
    start_flows(Flows(rows, rows, rows), BatchTables(spark, f"{root}/tables"), f"{root}/checkpoints", names=("clean",))
    assert list(seen.values()) == ["false", "8000"]
