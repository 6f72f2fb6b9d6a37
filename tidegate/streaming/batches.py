"""foreachBatch writers. A batch written twice leaves the same tables as one written once."""

from __future__ import annotations

from collections.abc import Callable, Collection
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import date, datetime
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidegate.model import (
    AGGREGATE_SCHEMA,
    AGGREGATED_TOPIC,
    COORDINATES,
    EVENT_SCHEMA,
    LEDGER_SCHEMA,
    LEDGER_TTL_SECONDS,
    METRIC_COUNTERS,
    QUARANTINE_SCHEMA,
    QUARANTINE_TOPIC,
    TRANSFORMED_TOPIC,
)
from tidegate.operators.aggregate import STATE_SCHEMA, WINDOW_KEYS
from tidegate.operators.ledger import ledger_entries, mark_quarantined, purged
from tidegate.session import overridden
from tidegate.sinks.messages import encode_aggregates, encode_clean, encode_quarantine, publish_kafka
from tidegate.sinks.outbox import Send, send_once
from tidegate.sinks.snapshots import Manifest, compact, latest_manifest
from tidegate.sinks.tables import (
    AGGREGATE_PARTITIONS,
    CLEAN_PARTITIONS,
    days_back,
    folders_of_others,
    not_from,
    read_table,
    utc_day,
    write_batch,
)
from tidegate.sources.checkpoints import late_mark


def _clean_schema() -> T.StructType:
    typed = {"event_timestamp": T.TimestampType(), "ingestion_timestamp": T.TimestampType()}
    events = [T.StructField(f.name, typed.get(f.name, f.dataType)) for f in EVENT_SCHEMA.fields]
    return T.StructType(
        [
            T.StructField("raw_payload", T.StringType()),
            T.StructField("source_topic", T.StringType()),
            T.StructField("source_partition", T.IntegerType()),
            T.StructField("source_offset", T.LongType()),
            T.StructField("kafka_timestamp", T.TimestampType()),
            *events,
            T.StructField("event_date", T.DateType()),
            T.StructField("processed_at", T.TimestampType()),
            T.StructField("processing_key", T.StringType()),
        ]
    )


CLEAN_SCHEMA = _clean_schema()
COORDINATE_FIELDS = [f for f in CLEAN_SCHEMA.fields if f.name in COORDINATES]
STORED_QUARANTINE = T.StructType(QUARANTINE_SCHEMA.fields + COORDINATE_FIELDS)
#: Marks first arrivals in a clean flow that brings all arrivals along, and what became of the others.
KEPT = "_kept"
LATE, DUPLICATE = "late", "duplicate"
#: How the ids of replay runs begin.
REPLAYS = "replay-"
RECORD_KEY = ("source_topic", "source_partition", "source_offset")
METRIC_SCHEMA = T.StructType(
    [T.StructField(name, T.LongType()) for name in METRIC_COUNTERS]
    + [T.StructField("recorded_at", T.TimestampType())]
)
MESSAGE_SCHEMA = T.StructType(
    [T.StructField("key", T.StringType()), T.StructField("value", T.StringType())]
)

SCHEMAS = {
    "clean_events": CLEAN_SCHEMA,
    "aggregates": STATE_SCHEMA,
    "quarantine": STORED_QUARANTINE,
    "ledger": LEDGER_SCHEMA,
    "metrics": METRIC_SCHEMA,
}
PARTITIONS = {"clean_events": CLEAN_PARTITIONS, "aggregates": AGGREGATE_PARTITIONS}

BatchWriter = Callable[[DataFrame, int], None]

# A task's share of a batch is one block. With memory as a first choice a block that was written to disk
# is read back whole, as one array, which a large share has no room for.
HELD = StorageLevel.DISK_ONLY

# Streams run without adaptive execution because their state is tied to its partitions. What a
# writer does with a finished batch is ordinary batch work and may adapt to sizes and skew.
ADAPTIVE = {"spark.sql.adaptive.enabled": "true"}


@dataclass(frozen=True)
class BatchStamp:
    """Which batch this is, and its clock; the checkpoint keeps all three for a repeat."""

    query_id: str
    batch_id: int
    epoch_seconds: int

    @property
    def day(self) -> date:
        return utc_day(self.epoch_seconds)

    def back(self, seconds: int) -> list[date]:
        return days_back(self.epoch_seconds, seconds)


@dataclass
class BatchTables:
    """The tables below one root and the writers that fill them.

    Messages go to ``send`` or to Kafka if one is set, once for each batch, else to one table per topic.
    """

    spark: SparkSession
    root: str
    kafka_servers: str | None = None
    checkpoints: str | None = None
    ttl_seconds: int = LEDGER_TTL_SECONDS
    send: Send | None = None  # takes (topic, key, value, message_id) rows instead of Kafka
    topics: dict[str, str] = field(
        default_factory=lambda: {
            "clean": TRANSFORMED_TOPIC,
            "quarantine": QUARANTINE_TOPIC,
            "aggregates": AGGREGATED_TOPIC,
        }
    )

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    # -- reads ---------------------------------------------------------------------------

    def clean(self) -> DataFrame:
        return read_table(self.spark, self.path("clean_events"), CLEAN_SCHEMA)

    def aggregates(self) -> DataFrame:
        """Closed windows, finished, with the states they can be merged from."""
        return read_table(self.spark, self.path("aggregates"), STATE_SCHEMA)

    def quarantine(self) -> DataFrame:
        return read_table(self.spark, self.path("quarantine"), STORED_QUARANTINE)

    def ledger(self) -> DataFrame:
        return read_table(self.spark, self.path("ledger"), LEDGER_SCHEMA)

    def metrics(self) -> DataFrame:
        return read_table(self.spark, self.path("metrics"), METRIC_SCHEMA)

    def set_aside(self) -> DataFrame:
        """Valid rows that the stream dropped, with their ``fate``."""
        return read_table(self.spark, self.path("set_aside"), T.StructType([*CLEAN_SCHEMA.fields, T.StructField("fate", T.StringType())]))

    def messages(self, topic: str) -> DataFrame:
        return read_table(self.spark, self.path(f"topics/{topic}"), MESSAGE_SCHEMA)

    # -- upkeep --------------------------------------------------------------------------

    def compact(self, table: str, closed: Collection[str] = ()) -> Manifest | None:
        """Pack the settled batches of a table; ``closed`` names queries that have ended for good."""
        return compact(self.spark, self.path(table), SCHEMAS[table], partition_by=PARTITIONS.get(table, ()), closed=closed)

    def purge_ledger(self, now: Column | datetime | str | None = None, closed: Collection[str] = ()) -> Manifest | None:
        """Replace the settled part of the ledger with one live entry for each id."""
        return compact(
            self.spark, self.path("ledger"), LEDGER_SCHEMA, rewrite=lambda rows: purged(rows, now), closed=closed
        )

    # -- writers -------------------------------------------------------------------------

    def write_clean(self, batch: DataFrame, batch_id: int) -> None:
        """Admit unseen ids, then write rows, messages, ledger and counters."""
        with self._batch(batch, batch_id, F.col("processed_at")) as stamp:
            if stamp is None:
                return
            gate = self.gate_replayed if "_seen" in batch.columns else self.gate
            gated = gate(batch, stamp).persist(HELD)
            try:
                admitted = gated.where("NOT _seen").drop("_seen")
                folder = self.path("clean_events")
                write_batch(admitted, folder, stamp.day, stamp.query_id, stamp.batch_id,
                            partition_by=CLEAN_PARTITIONS)
                self._publish("clean", encode_clean(admitted), stamp)
                entries = ledger_entries(
                    admitted, "written", now=_clock(stamp), ttl_seconds=self.ttl_seconds
                )
                self._note(entries, stamp)
                self.count(gated, stamp, valid=F.count_if(~F.col("_seen")),
                            duplicates=F.count_if(F.col("_seen")))
            finally:
                gated.unpersist()

    def write_arrivals(self, batch: DataFrame, batch_id: int) -> None:
        """Write the clean rows of a batch that has all arrivals beside them, and set aside what it dropped.

        A dropped row at or before the mark that the batch went by is late, any other a copy.
        """
        with overridden(batch.sparkSession, ADAPTIVE):
            batch.persist(StorageLevel.MEMORY_AND_DISK)
            try:
                kept = batch.where(KEPT).drop(KEPT)
                arrived = batch.where(f"NOT {KEPT}").drop(KEPT)
                known = kept.select(*RECORD_KEY)
                same = [arrived[name].eqNullSafe(known[name]) for name in RECORD_KEY]
                dropped = arrived.join(known, reduce(Column.__and__, same), "left_anti")
                newest = dropped.agg(F.max(F.unix_seconds("processed_at"))).first()[0]
                if newest is not None:
                    stamp = BatchStamp(self._query_id(), batch_id, newest)
                    mark = late_mark(batch.sparkSession, self.checkpoints, "clean", batch_id)
                    late = F.lit(False) if mark is None else F.col("event_timestamp") <= F.timestamp_millis(F.lit(mark))
                    fate = F.when(late, F.lit(LATE)).otherwise(F.lit(DUPLICATE))
                    write_batch(dropped.withColumn("fate", fate), self.path("set_aside"), stamp.day, stamp.query_id,
                                batch_id, partition_by=("fate",))
                self.write_clean(kept, batch_id)
            finally:
                batch.unpersist()

    def write_quarantine(self, batch: DataFrame, batch_id: int) -> None:
        """Write envelopes, messages, first quarantine marks and the counter."""
        clock = F.col("processing_timestamp").cast("timestamp")
        with self._batch(batch, batch_id, clock) as stamp:
            if stamp is None:
                return
            batch = self._unknown(batch, "quarantine", STORED_QUARANTINE, RECORD_KEY, stamp, "kafka_timestamp")
            write_batch(batch, self.path("quarantine"), stamp.day, stamp.query_id, stamp.batch_id)
            self._publish("quarantine", encode_quarantine(batch.drop(*COORDINATES)), stamp)
            days = stamp.back(self.ttl_seconds)
            ledger = read_table(batch.sparkSession, self.path("ledger"), LEDGER_SCHEMA, days=days)
            known = _among(not_from(ledger, stamp.query_id, stamp.batch_id), batch)
            marks = mark_quarantined(batch, known, now=_clock(stamp), ttl_seconds=self.ttl_seconds)
            self._note(marks, stamp)
            self.count(batch, stamp, quarantined=F.count("*"))

    def write_aggregates(self, batch: DataFrame, batch_id: int) -> None:
        """Write closed windows, their messages and the counter.

        Windows carry no processing time; their folder is dated by the newest window instead,
        which is the same when the batch is repeated.
        """
        with self._batch(batch, batch_id, F.col("window_end")) as stamp:
            if stamp is None:
                return
            batch = self._unknown(batch, "aggregates", STATE_SCHEMA, WINDOW_KEYS, stamp, "window_end")
            write_batch(batch, self.path("aggregates"), stamp.day, stamp.query_id, stamp.batch_id,
                        partition_by=AGGREGATE_PARTITIONS)
            self._publish("aggregates", encode_aggregates(batch.select(*AGGREGATE_SCHEMA.fieldNames())), stamp)
            self.count(batch, stamp, recorded_at=F.current_timestamp(), aggregate_rows=F.count("*"))

    # -- parts ---------------------------------------------------------------------------

    @contextmanager
    def _batch(self, batch: DataFrame, batch_id: int, clock: Column):
        """Keep the batch for the length of a writer; gives its stamp, or None if it is empty.

        The newest time counts, which a repeat in another row order finds again.
        """
        with overridden(batch.sparkSession, ADAPTIVE):
            batch.persist(HELD)
            try:
                newest = batch.agg(F.max(F.unix_seconds(clock))).first()[0]
                yield None if newest is None else BatchStamp(self._query_id(), batch_id, newest)
            finally:
                batch.unpersist()

    def _unknown(
        self, batch: DataFrame, table: str, schema: T.StructType, key: tuple[str, ...], stamp: BatchStamp, at: str
    ) -> DataFrame:
        """Rows that no other query has written: a new checkpoint reads the same input again.

        Batches of the query itself never overlap, so its folders are left out, and while there is
        one query nothing is read. A folder is dated by the clock of its batch, which is not before
        any of its rows' own time ``at``: days before the oldest of this batch hold none of them.
        """
        if not set(key) <= set(batch.columns):
            return batch
        names = folders_of_others(batch.sparkSession, self.path(table), stamp.query_id)
        if not names:
            return batch
        oldest = batch.agg(F.min(F.unix_seconds(at)), F.count_if(F.col(at).isNull())).first()
        since = utc_day(oldest[0]) if oldest[0] is not None and not oldest[1] else None
        folders = folders_of_others(batch.sparkSession, self.path(table), stamp.query_id, since=since)
        if not folders:
            return batch
        stored = read_table(batch.sparkSession, self.path(table), schema, folders=folders)
        others = stored.select(*key).distinct()
        same = [batch[name].eqNullSafe(others[name]) for name in key]
        return batch.join(others, reduce(Column.__and__, same), "left_anti")

    def _query_id(self) -> str:
        """The id kept in the checkpoint, the same after every restart."""
        return self.spark.sparkContext.getLocalProperty("sql.streaming.queryId")

    def gate(self, batch: DataFrame, stamp: BatchStamp) -> DataFrame:
        """The batch with ``_seen``: was the id written by another batch within the TTL?

        For its own batches the query asks its ledger entries: one narrow folder for each batch,
        complete before the next batch begins, however a batch was interrupted. For what other
        queries wrote, before a checkpoint was lost or by a replay, it asks their clean rows. The
        batch's own folder is left out: a repeated batch must admit the same rows again.
        """
        spark, days = batch.sparkSession, stamp.back(self.ttl_seconds)
        oldest = F.timestamp_seconds(F.lit(stamp.epoch_seconds - self.ttl_seconds))
        own = [f"{self.path('ledger')}/day={day.isoformat()}/query_id={stamp.query_id}" for day in days]
        packed = latest_manifest(spark, self.path("ledger"))
        if packed is not None:
            own += packed.folders(self.path("ledger"), days)
        ledger = read_table(spark, self.path("ledger"), LEDGER_SCHEMA, folders=own)
        noted = not_from(ledger, stamp.query_id, stamp.batch_id).where("status = 'written'")
        written = noted.where(F.col("updated_at") > oldest).select("event_id")
        others = folders_of_others(spark, self.path("clean_events"), stamp.query_id, days)
        if others:
            clean = read_table(spark, self.path("clean_events"), CLEAN_SCHEMA, folders=others)
            written = written.union(clean.where(F.col("processed_at") > oldest).select("event_id"))
        return _with_seen(batch, written)

    def gate_replayed(self, batch: DataFrame, stamp: BatchStamp) -> DataFrame:
        """A batch that the keyed state has gated, with what replays wrote since the state was filled."""
        spark, days = batch.sparkSession, stamp.back(self.ttl_seconds)
        folders = folders_of_others(spark, self.path("clean_events"), stamp.query_id, days, named=REPLAYS)
        if not folders:
            return batch
        clean = read_table(spark, self.path("clean_events"), CLEAN_SCHEMA, folders=folders)
        oldest = F.timestamp_seconds(F.lit(stamp.epoch_seconds - self.ttl_seconds))
        seen = batch["_seen"]
        replayed = _with_seen(batch.drop("_seen").withColumn("_before", seen), clean.where(F.col("processed_at") > oldest).select("event_id"))
        return replayed.withColumn("_seen", F.col("_seen") | F.col("_before")).drop("_before")

    def _publish(self, flow: str, messages: DataFrame, stamp: BatchStamp) -> None:
        topic = self.topics[flow]
        if not self.append(messages.withColumn("topic", F.lit(topic)), stamp, flow):
            folder = self.path(f"topics/{topic}")
            write_batch(messages, folder, stamp.day, stamp.query_id, stamp.batch_id)

    def append(self, messages: DataFrame, stamp: BatchStamp, flow: str) -> bool:
        """Send messages that name their topic, once for each batch; False where there is no log to send to."""
        send = self.send
        if send is None and self.kafka_servers:
            send = lambda rows: publish_kafka(rows, self.kafka_servers)
        if send is None:
            return False
        columns = messages.select("topic", "key", "value")
        send_once(columns, self.path(f"published/{flow}"), stamp.day, stamp.query_id, stamp.batch_id, send)
        return True

    def _note(self, entries: DataFrame, stamp: BatchStamp) -> None:
        write_batch(entries, self.path("ledger"), stamp.day, stamp.query_id, stamp.batch_id)

    def count(
        self, rows: DataFrame, stamp: BatchStamp, recorded_at: Column | None = None, **counters: Column
    ) -> None:
        """One row of counters, computed where the cached batch lies and written from there."""
        values = [counters[name].alias(name) for name in METRIC_COUNTERS if name in counters]
        counted = rows.agg(*values).select(
            *[F.col(name) if name in counters else F.lit(0).cast("long").alias(name) for name in METRIC_COUNTERS],
            (_clock(stamp) if recorded_at is None else recorded_at).alias("recorded_at"),
        )
        write_batch(counted, self.path("metrics"), stamp.day, stamp.query_id, stamp.batch_id)


def _with_seen(batch: DataFrame, written: DataFrame) -> DataFrame:
    hits = _among(written, batch).distinct().withColumn("_hit", F.lit(True))
    return batch.join(hits, "event_id", "left").select(*batch.columns, F.col("_hit").isNotNull().alias("_seen"))


def _clock(stamp: BatchStamp) -> Column:
    return F.timestamp_seconds(F.lit(stamp.epoch_seconds))


def _among(table: DataFrame, batch: DataFrame) -> DataFrame:
    """Rows of a large table whose id occurs in the batch.

    The batch's ids are the small side, so Spark may broadcast them and need not shuffle the
    table; where they are too many it shuffles both.
    """
    ids = batch.where("event_id IS NOT NULL").select("event_id").distinct()
    return table.join(ids, "event_id", "left_semi")
