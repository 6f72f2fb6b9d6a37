import random

from pyspark.sql import functions as F

from tidegate.operators import aggregate, dedup
from tidegate.operators.running import running_over_batches


def events(spark, rows):
    schema = ("event_id string, ingestion_timestamp string, source_partition int, source_offset long, "
              "event_timestamp string, event_type string, region string, source_system string, "
              "event_value double, device_id string")
    frame = spark.createDataFrame(rows, schema)
    return frame.withColumns(
        {
            "ingestion_timestamp": F.col("ingestion_timestamp").cast("timestamp"),
            "event_timestamp": F.col("event_timestamp").cast("timestamp"),
            "event_date": F.to_date("event_timestamp"),
        }
    )


def event(event_id, arrived, offset, at="2024-01-01 00:00:00", kind="click", value=1.0, device="d"):
    return (event_id, arrived, 0, offset, at, kind, "us-east", "web", value, device)


def test_first_arrival_wins_also_for_a_hot_id(spark):
    random.seed(1)
    rows = [event("hot", f"2024-01-01 00:{random.randrange(60):02}:{random.randrange(60):02}", n) for n in range(1, 400)]
    rows += [event("hot", "2023-12-31 23:59:59", 1000), event("hot", "2023-12-31 23:59:59", 999)]
    rows += [event(f"e{n}", "2024-01-01 00:00:00", n) for n in range(200)]
    kept = dedup.dedup_first(events(spark, rows).repartition(6)).collect()
    assert len(kept) == 201
    assert next(row for row in kept if row.event_id == "hot").source_offset == 999


def test_rows_without_an_id_are_events_of_their_own(spark):
    rows = [event(None, "2024-01-01 00:00:00", n) for n in range(5)] + [event("a", "2024-01-01 00:00:00", n) for n in (5, 6)]
    assert sorted(str(row.event_id) for row in dedup.dedup_first(events(spark, rows)).collect()) == ["None"] * 5 + ["a"]


def test_copies_are_dropped_before_the_shuffle(spark):
    frame = events(spark, [event("a", "2024-01-01 00:00:00", 1)])
    plan = dedup.dedup_first(frame)._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in below and "Partial" in below


def test_windows(spark):
    rows = [
        event("a", "2024-01-01 00:00:00", 1, "2024-01-01 00:00:00", value=1.0, device="d1"),
        event("b", "2024-01-01 00:00:00", 2, "2024-01-01 00:04:59", value=2.0, device="d2"),
        event("c", "2024-01-01 00:00:00", 3, "2024-01-01 00:04:59", value=None, device="d2"),
        event("d", "2024-01-01 00:00:00", 4, "2024-01-01 00:05:00"),
        event("e", "2024-01-01 00:00:00", 5, "2024-01-01 00:00:10", kind="error_event", value=-3.0),
    ]
    windows = aggregate.aggregate_events(events(spark, rows)).orderBy("window_start", "event_type").collect()
    first, errors, second = windows
    assert (first.event_count, first.average_event_value, first.unique_device_count) == (3, 1.5, 2)
    assert (first.error_event_count, errors.error_event_count) == (0, 1)
    assert (second.window_start.minute, second.window_end.minute, second.event_count) == (5, 10, 1)
    assert str(first.window_date) == "2024-01-01"
    exact = aggregate.aggregate_events(events(spark, rows), "1 hour", exact_devices=True)
    assert {row.event_type: row.unique_device_count for row in exact.collect()} == {"click": 3, "error_event": 1}


def test_aggregate_combines_before_its_only_shuffle(spark):
    plan = aggregate.aggregate_events(events(spark, [event("a", "2024-01-01 00:00:00", 1)]))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1 and text.count("ObjectHashAggregate") == 2


def test_touched_windows_are_aggregated_whole_and_others_left(spark):
    old = [event(f"o{n}", "2024-01-01 00:00:00", n, f"2024-01-01 00:{n:02}:00") for n in range(20)]
    new = [event("n", "2024-01-01 00:00:00", 99, "2024-01-01 00:07:00")]
    added = events(spark, new)
    (row,) = aggregate.finished(aggregate.states_with(aggregate.window_states(events(spark, old)), added)).collect()
    assert (row.window_start.minute, row.event_count) == (5, 6)


def test_states_merge_to_those_of_all_rows(spark):
    random.seed(5)
    rows = [
        event(f"e{n}", "2024-01-01 00:00:00", n, f"2024-01-01 {random.randrange(24):02}:{random.randrange(60):02}:00",
              random.choice(["click", "error_event"]), random.choice([None, 1.25, 2.5]), random.choice(["a", "b", "c", None]))
        for n in range(500)
    ]
    frame = events(spark, rows)
    parts = [frame.where(F.col("source_offset") % 3 == n) for n in range(3)]
    states = aggregate.window_states(parts[0])
    for part in parts[1:]:
        states = states.unionByName(aggregate.window_states(part))
    for size in ("1 hour", "1 day"):
        got = aggregate.finished(aggregate.merged_states(states, size))
        want = aggregate.aggregate_events(frame, size, exact_devices=True)
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0




def test_late_rows_against_a_walk_over_batches(spark):
    random.seed(7)
    start = 1_704_067_200
    rows = [(f"e{n}", random.randrange(40), start + 60 * random.randrange(120)) for n in range(300)]
    frame = spark.createDataFrame(rows, "event_id string, batch_id long, s long").withColumn(
        "event_timestamp", F.timestamp_seconds("s")
    )
    expected, newest = set(), None
    for batch in sorted({row[1] for row in rows}):
        here = [row for row in rows if row[1] == batch]
        if newest is not None:
            expected |= {row[0] for row in here if row[2] <= newest - 600}
        newest = max([row[2] for row in here] + ([newest] if newest is not None else []))
    assert {row.event_id for row in dedup.late_rows(frame).collect()} == expected


def test_running_totals_over_chunks_and_gaps(spark):
    random.seed(3)
    rows = [(key, batch, random.randrange(100)) for key in ("a", "b", None) for batch in random.sample(range(500), 120)]
    frame = spark.createDataFrame(rows, "k string, batch_id long, v long")
    out = running_over_batches(
        frame, {"total": (F.sum, "v"), "top": (F.max, "v")}, keys=["k"], chunk=37
    ).collect()
    assert len(out) == len(rows)
    for row in out:
        upto = [v for key, batch, v in rows if key == row.k and batch <= row.batch_id]
        assert (row.total, row.top) == (sum(upto), max(upto))
    before = running_over_batches(frame, {"top": (F.max, "v")}, keys=["k"], inclusive=False, chunk=37)
    for row in before.collect():
        earlier = [v for key, batch, v in rows if key == row.k and batch < row.batch_id]
        assert row.top == (max(earlier) if earlier else None)
