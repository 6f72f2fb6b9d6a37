"""Compaction, purge and the switch between batches and segments."""

import datetime as dt

import pytest
from pyspark.sql import functions as F, types as T

from tidegate.model import LEDGER_SCHEMA
from tidegate.operators.ledger import ledger_entries
from tidegate.session import scratch_dir
from tidegate.sinks import snapshots
from tidegate.sinks.tables import read_table, write_batch
from tidegate.streaming.batches import BatchStamp, BatchTables

SCHEMA = T.StructType([T.StructField("n", T.LongType()), T.StructField("part", T.StringType())])
DAYS = [dt.date(2024, 1, 1) + dt.timedelta(days=k) for k in range(3)]


def fill(spark, root, query, batch, numbers, day=DAYS[0]):
    rows = spark.createDataFrame([(n, "ab"[n % 2]) for n in numbers], SCHEMA)
    write_batch(rows, root, day, query, batch, partition_by=("part",))


def numbers(spark, root, **options):
    return sorted(row.n for row in read_table(spark, root, SCHEMA, **options).collect())


def live_files(spark, root):
    return read_table(spark, root, SCHEMA).select(F.input_file_name()).distinct().count()


def pack(spark, root, **options):
    return snapshots.compact(spark, root, SCHEMA, partition_by=("part",), **options)


def test_settled_batches_are_packed_and_the_newest_stays(spark):
    root = scratch_dir(spark, "packed")
    for batch in range(8):
        fill(spark, root, "q", batch, range(10 * batch, 10 * batch + 10), DAYS[batch // 4])
    fill(spark, root, "other", 0, [1000])
    before = live_files(spark, root)
    manifest = pack(spark, root)
    assert manifest.version == 1 and manifest.settled == {"q": 6, "other": -1}
    assert {day for day, _ in manifest.segments} == set(DAYS[:2])
    assert numbers(spark, root) == [*range(80), 1000]
    assert live_files(spark, root) < before / 2
    assert numbers(spark, root, days=[DAYS[1]]) == list(range(40, 80))
    assert pack(spark, root) is None
    fill(spark, root, "q", 7, range(70, 80), DAYS[1])  # the newest batch is written once more
    fill(spark, root, "q", 8, [80], DAYS[2])
    assert numbers(spark, root) == [*range(81), 1000]
    assert pack(spark, root, closed=["other"]).settled == {"q": 7, "other": 0}
    assert numbers(spark, root) == [*range(81), 1000]
    dead = snapshots.dead_folders(spark, root)
    assert len(dead) == 9 and not any("batch_id=8" in path for path in dead)


def test_files_stay_few(spark):
    root = scratch_dir(spark, "packed")
    most = 0
    for batch in range(14):
        fill(spark, root, "q", batch, [2 * batch, 2 * batch + 1])
        if batch % 2:
            pack(spark, root, most_segments=2)
            most = max(most, live_files(spark, root))
    assert numbers(spark, root) == list(range(28))
    assert most <= 2 * (2 + 1 + 2)  # two parts of at most three segments and two batches


@pytest.mark.parametrize("at", ["_pack", "write_manifest"])
def test_a_run_that_dies_before_the_switch_changes_nothing(spark, monkeypatch, at):
    root = scratch_dir(spark, "packed")
    for batch in range(4):
        fill(spark, root, "q", batch, [batch, batch + 10])
    real = getattr(snapshots, at)

    def dies(*args, **kwargs):
        if at == "_pack":
            real(*args, **kwargs)  # the segment is there, no manifest names it
        raise RuntimeError("lost")

    monkeypatch.setattr(snapshots, at, dies)
    with pytest.raises(RuntimeError):
        pack(spark, root)
    monkeypatch.undo()
    assert numbers(spark, root) == sorted([*range(4), *range(10, 14)])
    assert pack(spark, root).version == 1
    assert numbers(spark, root) == sorted([*range(4), *range(10, 14)])


def test_two_runs_that_race_agree(spark):
    root = scratch_dir(spark, "packed")
    for batch in range(4):
        fill(spark, root, "q", batch, [batch])
    first = pack(spark, root)
    rival = snapshots.Manifest(1, {"q": 1}, ())
    snapshots.write_manifest(spark, root, rival)
    chosen = snapshots.latest_manifest(spark, root)
    assert chosen in (first, rival) and chosen == snapshots.latest_manifest(spark, root)


def test_purge_leaves_one_live_entry_for_each_id_and_the_gate_sees_it(spark):
    tables = BatchTables(spark, scratch_dir(spark, "purge"))
    now = int(dt.datetime(2024, 1, 2, 12, tzinfo=dt.timezone.utc).timestamp())

    def note(batch, ids, hours_ago):
        stamp = BatchStamp("clean", batch, now - 3600 * hours_ago)
        rows = spark.createDataFrame([(i,) for i in ids], "event_id string")
        entries = ledger_entries(rows, "written", now=F.timestamp_seconds(F.lit(stamp.epoch_seconds)))
        write_batch(entries, tables.path("ledger"), stamp.day, "clean", batch)

    note(0, ["old", "again"], 30)
    note(1, ["again", "kept"], 5)
    note(2, ["kept"], 4)
    note(3, ["new"], 1)
    tables.purge_ledger(F.timestamp_seconds(F.lit(now)))
    assert sorted(row.event_id for row in tables.ledger().collect()) == ["again", "kept", "new"]
    assert tables.ledger().columns[: len(LEDGER_SCHEMA)] == LEDGER_SCHEMA.fieldNames()
    batch = spark.createDataFrame([(i,) for i in ("old", "again", "kept", "new", "fresh")], "event_id string")
    seen = {row.event_id: row._seen for row in tables.gate(batch, BatchStamp("clean", 4, now)).collect()}
    assert seen == {"old": False, "again": True, "kept": True, "new": True, "fresh": False}


def test_an_untouched_table_has_no_manifest(spark):
    root = scratch_dir(spark, "packed")
    assert snapshots.latest_manifest(spark, root) is None and snapshots.dead_folders(spark, root) == []
    fill(spark, root, "q", 0, [1])
    assert pack(spark, root) is None and numbers(spark, root) == [1]
