import json

import pytest
from pyspark.sql import functions as F

from conftest import NOW, payload, raw_frame
from tidegate.model import LEDGER_SCHEMA, WIRE_SCHEMA
from tidegate.operators import rules
from tidegate.operators.aggregate import aggregate_events
from tidegate.operators.dedup import dedup_first
from tidegate.operators.transform import transform_events
from tidegate.session import scratch_dir, shared_root
from tidegate.sinks import messages, streams, tables
from tidegate.sources import checkpoints, wire


def clean(spark, *payloads):
    return transform_events(rules.valid_events(rules.check_events(raw_frame(spark, payloads), now=NOW)), now=NOW)


def test_kafka_options():
    options = wire.kafka_options("a:1,b:2")
    assert options == {
        "kafka.bootstrap.servers": "a:1,b:2", "subscribe": "events.raw", "startingOffsets": "latest", "failOnDataLoss": "false",
    }
    more = wire.kafka_options("a:1", "t", starting_offsets="earliest", max_offsets_per_trigger=5, min_partitions=9)
    assert (more["startingOffsets"], more["maxOffsetsPerTrigger"], more["minPartitions"]) == ("earliest", "5", "9")
    assert messages.kafka_sink_options("a:1") == {"kafka.bootstrap.servers": "a:1"}
    assert messages.kafka_sink_options("a:1", "t")["topic"] == "t"


def test_envelope_has_no_key(spark):
    records = spark.createDataFrame([(None, bytearray(b"{}"), "t", 1, 2, None)], WIRE_SCHEMA)
    assert wire.raw_envelope(records).columns == [
        "raw_payload", "source_topic", "source_partition", "source_offset", "kafka_timestamp",
    ]
    assert wire.raw_envelope(records).first().raw_payload == "{}"


def test_messages(spark):
    rows = dedup_first(clean(spark, payload(session_id=None)))
    message = messages.encode_clean(rows).first()
    body = json.loads(message.value)
    assert message.key == "evt-ferry-3" and body["region"] == "us-east" and "session_id" not in body
    window = messages.encode_aggregates(aggregate_events(rows)).first()
    assert window.key == "2026-01-15 12:00:00|purchase|us-east"
    assert json.loads(window.value)["event_count"] == 1
    assert messages.encode_quarantine(rows).first().key is None
    assert messages.encode_any(rows.drop("event_id")).first().key is None


def test_checkpoint_names_and_commits(spark, tmp_path):
    with pytest.raises(ValueError):
        checkpoints.checkpoint_path("root", "other")
    assert checkpoints.latest_commit(spark, str(tmp_path), "clean").first().latest_commit is None
    folder = tmp_path / "clean" / "commits"
    folder.mkdir(parents=True)
    for name in ("0", "9", "10", ".10.crc", "11.tmp"):
        (folder / name).write_text("v1")
    row = checkpoints.latest_commit(spark, str(tmp_path), "clean").first()
    assert (row.query_name, row.latest_commit) == ("clean", 10)


def test_batch_is_replaced_and_partitions_are_pruned(spark, tmp_path):
    from tidegate.streaming.batches import CLEAN_SCHEMA

    root, day = str(tmp_path / "clean"), tables.utc_day(1_768_482_000)
    rows = clean(spark, payload(), payload(event_id="b", region="eu-west"))
    for _ in range(2):
        tables.write_batch(rows, root, day, "q", 0, partition_by=tables.CLEAN_PARTITIONS)
    tables.write_batch(clean(spark, payload(event_id="c")), root, day, "q", 1, partition_by=tables.CLEAN_PARTITIONS)
    table = tables.read_table(spark, root, CLEAN_SCHEMA)
    assert sorted(row.event_id for row in table.collect()) == ["b", "c", "evt-ferry-3"]
    assert [row.event_id for row in tables.not_from(table, "q", 0).collect()] == ["c"]
    pruned = table.where("event_date = date'2026-01-15' AND region = 'eu-west'").select("event_id")
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters:"):plan.index("PushedFilters")]
    assert "event_date" in filters and "region" in filters
    assert pruned.count() == 1
    assert tables.read_table(spark, root, CLEAN_SCHEMA, days=tables.days_back(1_768_482_000, 86_400)).count() == 3
    assert tables.read_table(spark, root, CLEAN_SCHEMA, days=[tables.utc_day(0)]).count() == 0


def test_days_back():
    assert [str(day) for day in tables.days_back(86_400 * 10 + 5, 86_400)] == ["1970-01-10", "1970-01-11"]
    assert [str(day) for day in tables.days_back(86_400 * 10, 0)] == ["1970-01-11"]


def test_generic_stream_sinks(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.range(20).select(F.concat(F.lit("e"), "id").alias("event_id"), (F.col("id") % 2).alias("half")).write.parquet(source)
    rows = spark.readStream.schema("event_id string, half long").parquet(source)
    out = str(tmp_path / "out")
    streams.write_parquet_stream(
        rows, path=out, checkpoint=str(tmp_path / "c1"), query_name="p", partition_by=["half"], trigger="availableNow"
    ).awaitTermination()
    assert spark.read.parquet(out).where("half = 1").count() == 10
    said = str(tmp_path / "said")
    streams.write_json_stream(
        rows, checkpoint=str(tmp_path / "c2"), query_name="j", format="json", path=said, trigger="availableNow"
    ).awaitTermination()
    message = spark.read.schema("key string, value string").json(said).orderBy("key").first()
    assert message.key == "e0" and json.loads(message.value) == {"event_id": "e0", "half": 0}


def test_scratch_is_the_shared_folder(spark):
    shared = shared_root(spark)
    assert spark.conf.get("spark.checkpoint.dir", shared).rstrip("/") == shared
    first, second = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert first.startswith(shared) and first != second


def test_other_queries_are_found_by_folder(spark, tmp_path):
    import datetime as dt

    from tidegate.sinks.tables import folders_of_others, write_batch

    root, rows = str(tmp_path / "t"), spark.range(3)
    assert folders_of_others(spark, root, "own") == []
    for query_id, day in (("own", 1), ("own", 2), ("old", 1), ("replay-1", 2)):
        write_batch(rows, root, dt.date(2024, 1, day), query_id, 0)
    found = folders_of_others(spark, root, "own")
    assert sorted(path.split("/t/")[1] for path in found) == ["day=2024-01-01/query_id=old", "day=2024-01-02/query_id=replay-1"]
    (late,) = folders_of_others(spark, root, "own", [dt.date(2024, 1, 2)])
    assert late.endswith("day=2024-01-02/query_id=replay-1")


def test_a_table_that_is_not_there_is_planned_away(spark):
    """A first batch is joined with nothing: no shuffle, and no Python worker for the empty side."""
    none = tables.read_table(spark, f"{scratch_dir(spark, 'none')}/ledger", LEDGER_SCHEMA)
    assert none.schema.fieldNames() == [*LEDGER_SCHEMA.fieldNames(), "day", "query_id", "batch_id"]
    assert [f.dataType for f in none.schema][:4] == [f.dataType for f in LEDGER_SCHEMA]
    batch = spark.range(5).select(F.col("id").cast("string").alias("event_id"))
    for kind, rows in (("left_anti", 5), ("left_semi", 0), ("left", 5)):
        joined = batch.join(none.select("event_id").distinct(), "event_id", kind)
        plan = joined._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan and "ExistingRDD" not in plan and joined.count() == rows, plan
