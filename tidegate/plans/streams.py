"""The streams run over the given tables, stopped and restarted half way."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidegate.model import LEDGER_TTL_SECONDS, RAW_TOPIC
from tidegate.plans.fixture import NOW, wire_records
from tidegate.plans.replay_job import ReplayJob
from tidegate.session import ROCKSDB, overridden, scratch_dir
from tidegate.sinks.streams import AVAILABLE_NOW, triggered, write_json_stream, write_parquet_stream
from tidegate.sinks.tables import CLEAN_PARTITIONS, write_batch
from tidegate.sources.checkpoints import checkpoint_path, latest_commit, state_operators, state_rows
from tidegate.sources.wire import file_stream
from tidegate.streaming.alerts import alert_stream
from tidegate.streaming.batches import CLEAN_SCHEMA, BatchStamp, BatchTables
from tidegate.streaming.flows import Flows, build_flows
from tidegate.streaming.gate import NO_DATA_BATCHES, STATE_MEMORY, gated_in_state, own_query_id, written_by_others
from tidegate.streaming.run import drain, start_flows

# The first run reads what arrived before this instant, the second run the rest.
SPLIT = "2024-01-16T00:00:00Z"
SENTINEL_ID = "evt-closing"
LAST = datetime(2024, 2, 1, tzinfo=timezone.utc)
#: Records of a gated stream for a state partition. A task's share of a batch, and what it fetches of it at once,
#: then stay the same however many records there are.
PARTITION_RECORDS = 500_000
SIDE_SPLITS = ("2024-01-08T00:00:00Z", "2024-01-16T00:00:00Z", "2024-01-24T00:00:00Z")


def closing_record(spark: SparkSession) -> DataFrame:
    """A valid heartbeat after all events: its event time lets the watermark close their windows."""
    body = (
        f'{{"event_id":"{SENTINEL_ID}","device_id":"dev-0","event_type":"heartbeat",'
        f'"event_timestamp":"{NOW}","ingestion_timestamp":"{NOW}","source_system":"web",'
        '"region":"us-east","payload_version":"1.0","metadata":{"k":"0"}}'
    )
    return spark.range(1).select(
        F.lit(None).cast("binary").alias("key"),
        F.lit(body).cast("binary").alias("value"),
        F.lit(RAW_TOPIC).alias("topic"),
        F.lit(0).alias("partition"),
        F.lit(-1).cast("long").alias("offset"),
        F.lit(NOW).cast("timestamp").alias("timestamp"),
    )


def run_in_two_parts(spark: SparkSession, sf_dir: str, *names: str) -> BatchTables:
    """Write the wire records to the shared folder in order of arrival and stream them.

    The queries drain the first part, end, and start again on their checkpoints for the second.
    """
    root = scratch_dir(spark, f"stream-{'-'.join(names)}")
    wire = wire_records(spark, sf_dir)
    split = F.lit(SPLIT).cast("timestamp")
    parts = [
        wire.where(F.col("timestamp") < split),
        wire.where(F.col("timestamp") >= split).unionByName(closing_record(spark)),
    ]
    tables = BatchTables(spark, f"{root}/tables")
    for part in parts:
        part.write.mode("append").parquet(f"{root}/wire")
        flows = build_flows(file_stream(spark, f"{root}/wire"), now=NOW)
        queries = start_flows(
            flows,
            tables,
            f"{root}/checkpoints",
            trigger=AVAILABLE_NOW,
            names=names,
            state_partitions=spark.sparkContext.defaultParallelism,
        )
        drain(queries)
    return tables


def three_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the tables that all three queries fill at once from one source."""
    tables = run_in_two_parts(spark, sf_dir, "clean", "quarantine", "aggregates")
    clean = tables.clean().where(F.col("event_id") != SENTINEL_ID)
    stored = {"clean_events": clean, "quarantine": tables.quarantine(), "aggregates": tables.aggregates()}
    counted = [rows.agg(F.lit(name).alias("table"), F.count("*").alias("records")) for name, rows in stored.items()]
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


class FailsOnce(BatchTables):
    """Loses the second batch between its clean rows and its ledger entries, once."""

    lost = False

    def _note(self, entries: DataFrame, stamp: BatchStamp) -> None:
        if stamp.batch_id > 0 and not self.lost:
            self.lost = True
            raise RuntimeError("lost between two writes")
        super()._note(entries, stamp)


def resumed_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean rows and their ledger entries after a batch that failed half way and was resumed."""
    root = scratch_dir(spark, "stream-resumed")
    wire, split = wire_records(spark, sf_dir), F.lit(SPLIT).cast("timestamp")
    tables = FailsOnce(spark, f"{root}/tables")
    for part in (wire.where(F.col("timestamp") < split), wire.where(F.col("timestamp") >= split), None):
        if part is not None:
            part.write.mode("append").parquet(f"{root}/wire")
        flows = build_flows(file_stream(spark, f"{root}/wire"), now=NOW)
        queries = start_flows(
            flows, tables, f"{root}/checkpoints", trigger=AVAILABLE_NOW, names=("clean",),
            state_partitions=spark.sparkContext.defaultParallelism,
        )
        try:
            drain(queries)
        except StreamingQueryException:
            if not tables.lost:
                raise
    noted = tables.ledger().groupBy("event_id").agg(F.count("*").alias("entries"))
    return tables.clean().join(noted, "event_id").select("event_id", "event_timestamp", "processing_key", "entries")


def run_with_lost_checkpoint(spark: SparkSession, sf_dir: str, name: str) -> BatchTables:
    """As above, then the whole input once more under a new checkpoint, into the same tables."""
    root = scratch_dir(spark, f"stream-lost-{name}")
    wire_records(spark, sf_dir).unionByName(closing_record(spark)).write.parquet(f"{root}/wire")
    tables = BatchTables(spark, f"{root}/tables")
    for checkpoint in ("first", "second"):
        flows = build_flows(file_stream(spark, f"{root}/wire"), now=NOW)
        drain(
            start_flows(
                flows, tables, f"{root}/{checkpoint}", trigger=AVAILABLE_NOW, names=(name,),
                state_partitions=spark.sparkContext.defaultParallelism,
            )
        )
    return tables


def state_partitions(spark: SparkSession, wire: str) -> int:
    """For the records of a folder: as many for each core."""
    cores = spark.sparkContext.defaultParallelism
    return cores * max(-(-spark.read.parquet(wire).count() // (cores * PARTITION_RECORDS)), 1)


def run_gated(spark: SparkSession, tables: BatchTables, wire: str, checkpoints: str, clock: datetime) -> None:
    """The clean flow with its gate in keyed state, over the records of a folder."""
    flows = build_flows(file_stream(spark, wire), now=clock)
    own = own_query_id(spark, checkpoints, "clean")
    written = written_by_others(spark, tables.path("clean_events"), CLEAN_SCHEMA, LEDGER_TTL_SECONDS, clock, own)
    clean = gated_in_state(flows.clean, LEDGER_TTL_SECONDS, written)
    with overridden(spark, {NO_DATA_BATCHES: "false", **STATE_MEMORY}):
        queries = start_flows(
            Flows(clean, flows.quarantine, flows.aggregates), tables, checkpoints, trigger=AVAILABLE_NOW, names=("clean",),
            state_partitions=state_partitions(spark, wire),
        )
        drain(queries)


def stored_parts(rows: DataFrame, number: Column, path: str) -> Callable[[int], DataFrame]:
    """Rows written once, in folders by a number, for parts that would each make all of them again."""
    rows.withColumn("_part", number).write.partitionBy("_part").parquet(path)
    stored = rows.sparkSession.read.schema(T.StructType([*rows.schema.fields, T.StructField("_part", T.LongType())])).parquet(path)
    return lambda n: stored.where(F.col("_part") == n).drop("_part")


def gate_ttl(spark: SparkSession, sf_dir: str, rows: DataFrame) -> DataFrame:
    """How often each id is written by a stream whose checkpoint was lost, gated in state.

    Of the clean ``rows``, the lost stream wrote a third 25 hours before, which has expired, and a
    third one hour before, which the new stream's state takes over.
    """
    root = scratch_dir(spark, "stream-gate-ttl")
    wire_records(spark, sf_dir).write.parquet(f"{root}/wire")
    tables = BatchTables(spark, f"{root}/tables")
    parts = stored_parts(rows, F.substring("event_id", 5, 20).cast("long") % 3, f"{root}/rows")
    for n, hours in enumerate((25, 1)):
        at = LAST - timedelta(hours=hours)
        part = parts(n).withColumn("processed_at", F.lit(at.isoformat()).cast("timestamp"))
        write_batch(part, tables.path("clean_events"), at.date(), "lost", n, partition_by=CLEAN_PARTITIONS)
    run_gated(spark, tables, f"{root}/wire", f"{root}/checkpoints", LAST)
    return tables.clean().groupBy("event_id").agg(F.count("*").alias("times_written"))


def side_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each id of the valid rows: how many were kept, late and copies, over four runs on one checkpoint.

    Every eleventh offset arrives forty hours late.
    """
    root = scratch_dir(spark, "stream-side")
    delay = F.make_interval(hours=F.when(F.col("offset") % 11 == 0, 40).otherwise(0))
    wire = wire_records(spark, sf_dir).withColumn("timestamp", F.col("timestamp") + delay)
    bounds = [F.lit(at).cast("timestamp") for at in SIDE_SPLITS]
    tables = BatchTables(spark, f"{root}/tables", checkpoints=f"{root}/checkpoints")
    partitions = spark.sparkContext.defaultParallelism
    for n in range(len(bounds) + 1):
        part = wire if n == 0 else wire.where(F.col("timestamp") >= bounds[n - 1])
        part = part if n == len(bounds) else part.where(F.col("timestamp") < bounds[n])
        part.write.mode("append").parquet(f"{root}/wire")
        flows = build_flows(file_stream(spark, f"{root}/wire"), now=NOW, arrivals=partitions)
        drain(start_flows(flows, tables, f"{root}/checkpoints", trigger=AVAILABLE_NOW, names=("clean",), state_partitions=partitions))
    fates = tables.clean().select("event_id", F.lit("kept").alias("fate")).unionByName(tables.set_aside().select("event_id", "fate"))
    counted = {name: F.count_if(F.col("fate") == name).alias(name) for name in ("kept", "late", "duplicate")}
    return fates.groupBy("event_id").agg(*counted.values())


def rate_alert_stream(spark: SparkSession, metrics: DataFrame, threshold: float) -> DataFrame:
    """Alerts of a stream over batch counters, ended half way and started again on its checkpoint."""
    root = scratch_dir(spark, "stream-alerts")
    metrics = metrics.select("query_id", "batch_id", "valid", "quarantined")
    metrics.write.parquet(f"{root}/counters")
    stored = spark.read.schema(metrics.schema).parquet(f"{root}/counters")
    middle = stored.agg(F.percentile_approx("batch_id", 0.5)).first()[0] or 0

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/alerts/batch={batch_id}")

    alerts = None
    for part in (stored.where(F.col("batch_id") <= middle), stored.where(F.col("batch_id") > middle)):
        part.write.mode("append").parquet(f"{root}/wire")
        settings = {
            "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
            "spark.sql.shuffle.partitions": str(spark.sparkContext.defaultParallelism),
        }
        with overridden(spark, settings):
            alerts = alert_stream(spark.readStream.schema(metrics.schema).parquet(f"{root}/wire"), threshold)
            writer = alerts.writeStream.outputMode("append").foreachBatch(write).option("checkpointLocation", f"{root}/checkpoint")
            triggered(writer, AVAILABLE_NOW).start().awaitTermination()
    return spark.read.schema(alerts.schema).parquet(f"{root}/alerts/batch=*")


def published_once(spark: SparkSession, records: DataFrame) -> DataFrame:
    """What a replay run and its repeat append to a message log, by topic."""
    root = scratch_dir(spark, "published")

    def send(messages: DataFrame) -> None:
        messages.write.mode("append").parquet(f"{root}/log")

    tables = BatchTables(spark, f"{root}/tables", send=send)
    write_batch(records, tables.path("quarantine"), LAST.date(), "arrived", 0)
    for _ in range(2):
        ReplayJob(tables, "one", LAST).run()
    log = spark.read.parquet(f"{root}/log")
    return log.groupBy("topic").agg(F.count("*").alias("messages"), F.count_distinct("message_id").alias("distinct_ids"))


def compacted_clean(spark: SparkSession, sf_dir: str, rows: DataFrame) -> DataFrame:
    """Clean rows in six batches of two queries, packed after the fourth and again at the end."""
    root = scratch_dir(spark, "compacted")
    tables = BatchTables(spark, root)
    day = LAST.date()
    parts = stored_parts(rows, F.col("source_offset") % 6, f"{root}-rows")
    for n in range(6):
        write_batch(parts(n), tables.path("clean_events"), day, f"query-{n % 2}", n // 2, partition_by=CLEAN_PARTITIONS)
        if n == 3:
            tables.compact("clean_events")
    tables.compact("clean_events", closed=["query-0"])
    return tables.clean().select("event_id", "source_offset", "event_date", "region", "event_value")


def purged_ledger(spark: SparkSession, entries: DataFrame) -> DataFrame:
    """The ledger log in three batches, purged twice: once before the last of them."""
    root = scratch_dir(spark, "purged")
    tables = BatchTables(spark, root)
    for n in range(3):
        write_batch(entries.where(F.pmod(F.xxhash64("event_id", "updated_at"), F.lit(3)) == n), tables.path("ledger"), LAST.date(), "log", n)
        if n == 1:
            tables.purge_ledger(NOW)
    tables.purge_ledger(NOW, closed=["log"])
    return tables.ledger().select("event_id", "status", "updated_at", "expires_at")


def generic_sinks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean rows of the stream through the generic Parquet and JSON sinks, read back side by side.

    The Parquet sink drains what there is; the JSON sink runs on a processing-time trigger until
    the source is used up.
    """
    root = scratch_dir(spark, "stream-sinks")
    wire_records(spark, sf_dir).write.parquet(f"{root}/wire")
    rows = build_flows(file_stream(spark, f"{root}/wire"), now=NOW).clean
    rows = rows.select("event_id", "event_date", "source_offset", "event_timestamp", "event_value")
    with overridden(spark, {"spark.sql.shuffle.partitions": str(spark.sparkContext.defaultParallelism)}):
        write_parquet_stream(
            rows, path=f"{root}/table", checkpoint=f"{root}/check-table", query_name="generic-table",
            partition_by=["event_date"], trigger=AVAILABLE_NOW,
        ).awaitTermination()
        said = write_json_stream(
            rows, checkpoint=f"{root}/check-said", query_name="generic-messages", format="json",
            path=f"{root}/said", trigger="1 second",
        )
        try:
            said.processAllAvailable()
        finally:
            said.stop()
    value = F.from_json("value", "event_id string, event_value double")
    messages = spark.read.schema("key string, value string").json(f"{root}/said")
    messages = messages.select("key", F.explode(F.array(value)).alias("v")).select(
        F.col("key").alias("event_id"), F.col("v.event_value").alias("said_value")
    )
    table = spark.read.parquet(f"{root}/table").select("event_id", "event_date", "event_value")
    return table.join(messages, "event_id")


def checkpoint_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the checkpoint of the clean query says after two runs: commits, operator, checkpoint folder."""
    root = run_in_two_parts(spark, sf_dir, "clean").root.removesuffix("/tables")
    commits = latest_commit(spark, f"{root}/checkpoints", "clean")
    operator = state_operators(spark, f"{root}/checkpoints", "clean").select("operatorName")
    held = state_rows(spark, f"{root}/checkpoints", "clean").agg((F.count("*") >= 1).alias("holds_state"))
    path = F.lit(checkpoint_path("/x/", "clean")).alias("folder")
    both = commits.withColumn("one", F.lit(1)).join(operator.withColumn("one", F.lit(1)), "one").join(held.withColumn("one", F.lit(1)), "one")
    return both.select("query_name", (F.col("latest_commit") >= 1).alias("committed_twice"), F.col("operatorName").alias("operator_name"), "holds_state", path)


def lost_checkpoint_aggregates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_with_lost_checkpoint(spark, sf_dir, "aggregates").aggregates()


def lost_checkpoint_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = run_with_lost_checkpoint(spark, sf_dir, "quarantine").quarantine()
    return rows.select(
        "event_id", "original_payload", "error_type", "error_message", "failed_field",
        "replay_eligible", "retry_count",
    )


def stream_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = run_in_two_parts(spark, sf_dir, "clean").clean()
    return rows.where(F.col("event_id") != SENTINEL_ID).select(
        "event_id", "event_timestamp", "event_type", "region", "event_value", "processing_key", "event_date"
    )


def stream_aggregates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_in_two_parts(spark, sf_dir, "aggregates").aggregates()


def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = run_in_two_parts(spark, sf_dir, "quarantine").quarantine()
    return rows.select(
        "event_id", "original_payload", "error_type", "error_message", "failed_field",
        "replay_eligible", "retry_count",
    )
