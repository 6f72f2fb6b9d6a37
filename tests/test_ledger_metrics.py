import pytest
from pyspark.sql import functions as F

from tidegate.operators import ledger, metrics, quarantine

NOW = "2024-02-01T00:00:00Z"


def entries(spark, rows):
    frame = spark.createDataFrame(rows, "event_id string, status string, hours int")
    updated = F.lit(NOW).cast("timestamp") - F.make_interval(hours=F.col("hours"))
    return frame.select(
        "event_id", "status", updated.alias("updated_at"),
        (updated + F.expr("interval 1 day")).alias("expires_at"),
    )


def ids(frame):
    return sorted(row.event_id for row in frame.collect())


def batch(spark, *names):
    return spark.createDataFrame([(name,) for name in names], "event_id string")


def test_second_claim_is_refused_and_status_kept(spark):
    empty = entries(spark, []).where("false")
    claimed = ledger.claim(batch(spark, "e1", "e1", None), empty, now=NOW)
    assert [(row.event_id, row.status) for row in claimed.collect()] == [("e1", "received")]
    assert ledger.claim(batch(spark, "e1"), claimed, now=NOW).count() == 0
    written = claimed.unionByName(ledger.ledger_entries(batch(spark, "e1"), "written", now="2024-02-01T00:00:01Z"))
    assert ledger.current_status(written, NOW).first().status == "written"


def test_claim_after_expiry(spark):
    old = entries(spark, [("e1", "written", 25), ("e2", "written", 24), ("e3", "written", 23)])
    assert ids(ledger.claim(batch(spark, "e1", "e2", "e3"), old, now=NOW)) == ["e1", "e2"]


def test_last_write_wins_and_renews_the_expiry(spark):
    log = entries(spark, [("a", "written", 30), ("a", "received", 1), ("b", "written", 2), ("b", "quarantined", 1),
                          ("c", "received", 1), ("c", "written", 1)])
    assert {row.event_id: row.status for row in ledger.current_status(log, NOW).collect()} == {
        "a": "received", "b": "quarantined", "c": "written",
    }


def test_gate_skips_written_and_resumes_unfinished(spark):
    log = entries(spark, [("w", "written", 1), ("r", "received", 1), ("x", "written", 30)])
    rows = batch(spark, "w", "r", "x", "new")
    assert ids(ledger.idempotent_gate(rows, log, NOW)) == ["new", "r", "x"]
    counts = ledger.gate_duplicates(rows, log, NOW).first()
    assert (counts.distinct_ids, counts.admitted, counts.duplicates) == (4, 3, 1)


def test_gate_with_a_hot_id_in_the_ledger(spark):
    log = entries(spark, [("hot", "written", 1)] * 500 + [(f"e{n}", "received", 1) for n in range(50)])
    assert ids(ledger.idempotent_gate(batch(spark, "hot", "e1"), log, NOW)) == ["e1"]


def test_illegal_entries_are_set_aside(spark):
    log = entries(spark, [("a", "written", 1), ("", "written", 1), (None, "received", 1), ("b", "lost", 1), ("c", None, 1)])
    assert ids(ledger.accepted_entries(log)) == ["a"]
    reasons = {(row.event_id, row.reason) for row in ledger.rejected_entries(log).collect()}
    assert reasons == {
        ("", "event_id cannot be empty"), (None, "event_id cannot be empty"),
        ("b", "Unsupported processing status: lost"), ("c", "Unsupported processing status: None"),
    }
    with pytest.raises(Exception, match="Unsupported processing status: lost"):
        ledger.strict_entries(log.where("event_id = 'b'")).collect()


def test_first_quarantine_mark(spark):
    log = entries(spark, [("w", "written", 1), ("x", "written", 30)])
    marks = ledger.mark_quarantined(batch(spark, "w", "x", "n", "n", None), log, now=NOW)
    assert sorted((row.event_id, row.status) for row in marks.collect()) == [("n", "quarantined"), ("x", "quarantined")]


def test_alert_fires_on_the_edge_and_arms_again(spark):
    counts = [(9, 1), (0, 1), (0, 5), (100, 0), (0, 20), (0, 1), (50, 0), (0, 0)]
    rows = [("q", n, valid, bad) for n, (valid, bad) in enumerate(counts)]
    frame = spark.createDataFrame(rows, "query_id string, batch_id long, valid long, quarantined long")
    history = metrics.rate_history(frame, 0.10, chunk=3).orderBy("batch_id").collect()
    valid = bad = 0
    alerted = False
    for row, (more_valid, more_bad) in zip(history, counts, strict=True):
        valid, bad = valid + more_valid, bad + more_bad
        breached = bad / (valid + bad) > 0.10
        assert row.alert == (breached and not alerted)
        alerted = breached
    fired = metrics.rate_alerts(frame, 0.10, chunk=3).orderBy("batch_id").collect()
    assert [row.batch_id for row in fired] == [1, 4]
    assert fired[0].message == "Quarantine rate 18.18% exceeds 10.00%"
    assert fired[0].metadata["total_records"] == "11"


def test_rate_of_nothing_is_zero(spark):
    empty = spark.createDataFrame([], "query_id string, batch_id long, valid long, quarantined long")
    totals = metrics.metric_totals(empty).first()
    assert (totals.valid, totals.quarantined, totals.quarantine_rate, totals.last_batch_id) == (0, 0, 0.0, None)


def test_batch_metrics_count_an_id_once(spark):
    rows = [(1, True, "a")] * 3 + [(2, True, "a"), (2, True, "b"), (2, False, None), (2, False, "a"), (1, False, "z")]
    frame = spark.createDataFrame(rows, "batch_id long, is_valid boolean, event_id string").withColumn("query_id", F.lit("q"))
    out = {row.batch_id: (row.valid, row.quarantined, row.duplicates) for row in metrics.batch_metrics(frame).collect()}
    assert out == {1: (1, 1, 2), 2: (1, 2, 1)}


def test_status_defaults_to_not_started(spark):
    log = spark.createDataFrame([], "status string, at timestamp")
    assert metrics.run_status(log).first().status == "not_started"


def test_newest_records_bounds(spark):
    table = spark.createDataFrame(
        [(str(n), f"2024-01-01 00:00:{n:02}", "p") for n in range(30)],
        "event_id string, processing_timestamp string, original_payload string",
    )
    assert [row.event_id for row in quarantine.newest_records(table, 2).collect()] == ["29", "28"]
    assert quarantine.newest_records(table, 20_000).count() == 30
    with pytest.raises(ValueError):
        quarantine.newest_records(table, 0)


def test_quarantine_stats_and_summary(spark):
    table = spark.createDataFrame(
        [("malformed_json", False), ("quality_rule", True), ("quality_rule", True)],
        "error_type string, replay_eligible boolean",
    )
    stats = {row.error_type: (row.records, row.replay_eligible) for row in quarantine.quarantine_stats(table).collect()}
    assert stats == {"malformed_json": (1, 0), "quality_rule": (2, 2), None: (3, 2)}
    totals = spark.createDataFrame([(0.25,)], "quarantine_rate double")
    row = quarantine.quarantine_summary(table, totals).first()
    assert (row.indexed_records, row.replay_eligible, row.pipeline_quarantine_rate) == (3, 2, 0.25)
    assert row.by_error_type == {"malformed_json": 1, "quality_rule": 2}


def test_a_bucketed_ledger_is_never_shuffled(spark):
    from tidegate.session import overridden, scratch_dir

    rows = [(f"e{n}", "written", "2024-01-01 00:00:00", "2024-01-03 00:00:00") for n in range(50)]
    entries = spark.createDataFrame(rows, "event_id string, status string, updated_at string, expires_at string")
    entries = entries.withColumns({c: F.col(c).cast("timestamp") for c in ("updated_at", "expires_at")})
    batch = spark.createDataFrame([(f"e{n}",) for n in range(40, 60)], "event_id string").repartition(3)
    with overridden(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}):
        stored = ledger.store_bucketed(entries, "ledger_by_id", scratch_dir(spark, "bucketed"), 16)
        admitted = ledger.idempotent_gate(batch, stored, "2024-01-02T00:00:00Z")
        plan = admitted._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning(event_id") == 1 and "SortMergeJoin" in plan
        assert sorted(row.event_id for row in admitted.collect()) == [f"e{n}" for n in range(50, 60)]
