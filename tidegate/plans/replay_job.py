"""A replay run as one batch job over the stored tables.

The decisions are written first and read back for everything that follows, so a run that died
half way can be repeated under its run id and its ``now``: it finds the same pending records and
replaces what it wrote. Messages kept as tables are replaced as well; to a log they go once, unless
the run died between sending them and marking that.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidegate.model import AGGREGATION_WINDOW, EVENT_SCHEMA, QUARANTINE_SCHEMA, RuleConfig
from tidegate.operators import replay
from tidegate.operators.aggregate import STATE_SCHEMA, finished, merged_states, stored_windows
from tidegate.operators.dedup import dedup_first
from tidegate.operators.ledger import ledger_entries
from tidegate.operators.quarantine import newest_records
from tidegate.operators.transform import transform_events
from tidegate.sinks.messages import publish_table
from tidegate.sinks.tables import AGGREGATE_PARTITIONS, CLEAN_PARTITIONS, batch_folder, not_from, read_table, write_batch
from tidegate.streaming.batches import CLEAN_SCHEMA, REPLAYS, BatchStamp, BatchTables

DECISION_SCHEMA = T.StructType(
    [
        T.StructField("record_key", T.StringType()),
        *QUARANTINE_SCHEMA.fields,
        T.StructField("last_replay_error", T.StringType()),
        T.StructField("last_replay_at", T.TimestampType()),
        T.StructField("reason", T.StringType()),
        T.StructField("outcome", T.StringType()),
        T.StructField("destination", T.StringType()),
        T.StructField("payload", T.StringType()),
        T.StructField("event", EVENT_SCHEMA),
    ]
)
# Deferred records, whole, in folders by the minute they are due in.
WAITING_SCHEMA = T.StructType(
    [
        T.StructField("record_key", T.StringType()),
        *QUARANTINE_SCHEMA.fields,
        T.StructField("next_attempt_at", T.TimestampType()),
        T.StructField("due_minute", T.LongType()),
    ]
)


@dataclass
class ReplayJob:
    tables: BatchTables
    run_id: str
    now: datetime
    config: RuleConfig = RuleConfig()
    window: str = AGGREGATION_WINDOW  # that of the flows whose windows are corrected

    @property
    def stamp(self) -> BatchStamp:
        return BatchStamp(f"{REPLAYS}{self.run_id}", 0, int(self.now.timestamp()))

    def decisions_so_far(self) -> DataFrame:
        return read_table(self.tables.spark, self.tables.path("replay_decisions"), DECISION_SCHEMA)

    def pending(self) -> DataFrame:
        """Records no earlier run has decided on, and deferred ones whose time has come.

        A deferred record waits in an index by due minute; minutes to come are not read. Of its
        entries the one of its last attempt counts.
        """
        earlier = not_from(self.decisions_so_far(), self.stamp.query_id, 0)
        latest = earlier.groupBy("record_key").agg(
            F.max("retry_count").alias("_tries"),
            F.bool_or(F.col("outcome") != replay.DEFERRED).alias("_done"),
        )
        names = [*QUARANTINE_SCHEMA.fieldNames(), "record_key"]
        stored = self.tables.quarantine().withColumn("record_key", _record_key())
        fresh = stored.select(*names).join(latest, "record_key", "left_anti")
        waiting = not_from(self._waiting(), self.stamp.query_id, 0)
        due = replay.due_records(waiting, self.now).join(latest, "record_key").where("NOT _done AND retry_count = _tries")
        return fresh.select(*names).unionByName(due.select(*names))

    def _waiting(self) -> DataFrame:
        return read_table(self.tables.spark, self.tables.path("replay_waiting"), WAITING_SCHEMA)

    def decide(self, limit: int | None = None) -> DataFrame:
        records = self.pending() if limit is None else newest_records(self.pending(), limit)
        return replay.decide_replay(records, config=self.config, now=self.now)

    def dry_run(self, limit: int | None = None) -> DataFrame:
        """Records per destination; nothing is written."""
        return replay.dry_run(self.decide(limit))

    def run(self, limit: int | None = None) -> DataFrame:
        """Write decisions, messages, clean rows, what they add to windows, and counts; returns the counts."""
        tables, stamp = self.tables, self.stamp
        decided = self.record_decisions(limit)
        messages = replay.replay_messages(decided)
        if not tables.append(messages, stamp, "replay"):
            publish_table(messages, batch_folder(tables.path("replay_messages"), stamp.day, stamp.query_id, 0))

        gated = tables.gate(self._clean_rows(decided), stamp)
        self._write(gated.where("NOT _seen").drop("_seen"), "clean_events", CLEAN_PARTITIONS)
        added = self._own("clean_events", CLEAN_SCHEMA)
        tables.count(added, stamp, valid=F.count("*"))
        self._write(ledger_entries(added, "replayed", now=self.now, ttl_seconds=tables.ttl_seconds), "ledger")
        self._write(stored_windows(added, self.window), "window_additions", AGGREGATE_PARTITIONS)
        self._write(replay.replay_run(decided, self.now), "replay_runs")
        return replay.replay_counts(decided)

    def record_decisions(self, limit: int | None = None) -> DataFrame:
        """Write the decisions, and the deferred records to where they wait; gives the decisions as stored."""
        event = F.struct(*[F.col("_event")[name].alias(name) for name in EVENT_SCHEMA.fieldNames()])
        decided = self.decide(limit).withColumn("event", event).select(*DECISION_SCHEMA.fieldNames())
        self._write(decided, "replay_decisions")
        decided = self._own("replay_decisions", DECISION_SCHEMA)
        due = replay.next_attempt("retry_count", "last_replay_at")
        deferred = decided.where(F.col("outcome") == replay.DEFERRED).withColumn("next_attempt_at", due)
        waiting = deferred.withColumn("due_minute", replay.due_minute(F.col("next_attempt_at")))
        self._write(waiting.select(*WAITING_SCHEMA.fieldNames()), "replay_waiting", ("due_minute",))
        return decided

    def _clean_rows(self, decided: DataFrame) -> DataFrame:
        unknown = {
            "source_topic": "string", "source_partition": "int", "source_offset": "long",
            "kafka_timestamp": "timestamp",
        }
        events = decided.where(F.col("outcome") == replay.REPLAYED).select(
            F.col("original_payload").alias("raw_payload"),
            *[F.lit(None).cast(kind).alias(name) for name, kind in unknown.items()],
            "event.*",
        )
        clean = transform_events(events, now=self.now)
        return dedup_first(clean, ["ingestion_timestamp", "raw_payload"])

    def _write(self, rows: DataFrame, table: str, partition_by: tuple[str, ...] = ()) -> None:
        stamp = self.stamp
        write_batch(rows, self.tables.path(table), stamp.day, stamp.query_id, 0, partition_by=partition_by)

    def _own(self, table: str, schema: T.StructType) -> DataFrame:
        """What this run wrote to a table, read back."""
        stamp = self.stamp
        rows = read_table(self.tables.spark, self.tables.path(table), schema, days=[stamp.day])
        return rows.where((F.col("query_id") == stamp.query_id) & (F.col("batch_id") == 0))


def _record_key() -> Column:
    """Names a quarantined record by where it came from; one of unknown source by time, type and text."""
    source = F.concat_ws("|", "source_topic", F.col("source_partition").cast("string"), F.col("source_offset").cast("string"))
    text = F.concat_ws("|", "processing_timestamp", "error_type", F.coalesce("original_payload", F.lit("")))
    return F.sha2(F.when(F.col("source_offset").isNotNull(), source).otherwise(text), 256)


def corrected_windows(tables: BatchTables) -> DataFrame:
    """The stream's windows with what replays added to them. Adds up states; no clean row is read."""
    added = read_table(tables.spark, tables.path("window_additions"), STATE_SCHEMA)
    names = STATE_SCHEMA.fieldNames()
    return finished(merged_states(tables.aggregates().select(*names).unionByName(added.select(*names))))
