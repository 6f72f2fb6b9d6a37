"""The idempotency gate as keyed state: ids written within the TTL, held by the stream itself.

A batch then asks no table. State entries expire by themselves, their versions go with the batches of
the checkpoint, so a repeated batch admits the same rows again, and a new checkpoint is filled from
the clean table once, when its first batch runs.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor

from tidegate.functions import as_now
from tidegate.sinks.tables import days_back, read_table
from tidegate.sources.checkpoints import checkpoint_path

#: Ids are dealt to so many keys of state. Spark hands a key's rows to Python together when a new checkpoint
#: is filled, in the executor as in the worker, so a key's share of one batch has to fit into memory.
SHARDS = 2048
#: A key's ids lie in so many entries of its map. A batch asks for an entry once, whatever rows it brings for it.
BUCKETS = 32
#: What Python reads by name must not begin with an underscore: after the first batch Spark renames such columns.
SHARD, BUCKET, CLOCK, SEEN = "_shard", "gate_bucket", "gate_clock", "_seen"
#: State with a TTL asks for a batch after every batch, with or without data: turn these off, or a run
#: that reads what there is never ends.
NO_DATA_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"
#: What RocksDB may take of an executor beside the heap. Unbounded, each store has write buffers of its own for
#: every kind of entry.
STATE_MEMORY = {
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "128",
}


def written_ids(ttl_seconds: int, columns: list[str]) -> StatefulProcessor:
    """Marks rows whose id was written within the TTL and remembers the ids of the others.

    An id counts for a TTL from the time it was written at, which for one from the clean table is the
    table's. An entry is rid of ids past that when it is written again, and expires itself a TTL after its
    last. The class is made here, so that it travels to the workers whole and they need no installed package.
    """
    clock, mark, bucket = CLOCK, SEEN, BUCKET

    class WrittenIds(StatefulProcessor):
        def init(self, handle):
            self.written = handle.getMapState("written", "bucket int", "ids array<string>, at array<long>", ttl_seconds * 1000)

        def handleInputRows(self, key, rows, timerValues):
            held, newest = {}, {}
            for part in rows:
                seen = [self.meet(*row, held, newest) for row in zip(part["event_id"], part[bucket], part[clock])]
                yield part[columns].assign(**{mark: seen})
            for number, now in newest.items():
                self.put(number, {event_id: at for event_id, at in held[number].items() if at > now - ttl_seconds})

        def meet(self, event_id, number, now, held, newest):
            if event_id is None:
                return False
            number, now = int(number), int(now)
            if number not in held:
                held[number] = self.ids(number)
            at = held[number].get(event_id)
            if at is not None and at > now - ttl_seconds:
                return True
            held[number][event_id] = now
            newest[number] = max(now, newest.get(number, now))
            return False

        def handleInitialState(self, key, initialState, timerValues):
            held = {}
            for event_id, number, at in zip(initialState["event_id"], initialState[bucket], initialState["at"]):
                if number not in held:
                    held[number] = self.ids(int(number))
                held[number][event_id] = int(at)
            for number, ids in held.items():
                self.put(int(number), ids)

        def ids(self, number):
            entry = self.written.getValue((number,)) if self.written.containsKey((number,)) else None
            return {} if entry is None else dict(zip(entry[0], entry[1]))

        def put(self, number, ids):
            self.written.updateValue((number,), ([*ids], [*ids.values()]))

        def close(self):
            pass

    return WrittenIds()


def dealt(place: Column) -> list[Column]:
    """The key of state that an id or place is dealt to, and its entry there."""
    hashed = F.pmod(F.xxhash64(place), F.lit(SHARDS * BUCKETS))
    return [(hashed % SHARDS).cast("int").alias(SHARD), F.floor(hashed / SHARDS).cast("int").alias(BUCKET)]


def gated_in_state(clean: DataFrame, ttl_seconds: int, written: DataFrame | None = None) -> DataFrame:
    """A stream of clean rows with ``_seen``: was the id written within the TTL before this row?

    ``written`` has ``event_id`` and ``processed_at`` of rows written by others; a new checkpoint
    takes them over. Rows without an id are never seen and are dealt by where they came from.
    """
    place = F.coalesce("event_id", F.concat_ws("|", F.col("source_partition").cast("string"), F.col("source_offset").cast("string")))
    keyed = clean.select("*", F.unix_seconds("processed_at").alias(CLOCK), *dealt(place))
    schema = T.StructType([*clean.schema.fields, T.StructField(SEEN, T.BooleanType())])
    initial = None
    if written is not None:
        known = written.where("event_id IS NOT NULL").groupBy("event_id").agg(F.max(F.unix_seconds("processed_at")).alias("at"))
        initial = known.select("event_id", "at", *dealt(F.col("event_id"))).groupBy(SHARD)
    return keyed.groupBy(SHARD).transformWithStateInPandas(
        written_ids(ttl_seconds, clean.columns), schema, "Append", "ProcessingTime", initialState=initial
    )


def own_query_id(spark: SparkSession, checkpoints: str, name: str) -> str | None:
    """The id that a query's checkpoint holds, None before its first start."""
    try:
        row = spark.read.schema("id string").json(f"{checkpoint_path(checkpoints, name)}/metadata").first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return row and row.id


def written_by_others(
    spark: SparkSession, clean_root: str, schema: T.StructType, ttl_seconds: int, now: datetime, own: str | None
) -> DataFrame:
    """Ids and times of clean rows within the TTL, but for those of the query itself.

    A first batch that is repeated would find its own rows there and admit none.
    """
    epoch = int(now.timestamp())
    rows = read_table(spark, clean_root, schema, days=days_back(epoch, ttl_seconds))
    if own is not None:
        rows = rows.where(F.col("query_id") != own)
    oldest = as_now(now) - F.make_interval(secs=F.lit(ttl_seconds))
    return rows.where(F.col("processed_at") > oldest).select("event_id", "processed_at")
