"""Start the three queries, each on its own checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidegate.model import QUERY_NAMES, TRIGGER_INTERVAL
from tidegate.session import COMPILED, ROCKSDB, overridden
from tidegate.sinks.streams import triggered
from tidegate.sources.checkpoints import checkpoint_path
from tidegate.streaming.batches import KEPT, BatchTables, BatchWriter
from tidegate.streaming.flows import Flows

COUNT_STATE_ROWS = "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"


def start_query(
    rows: DataFrame,
    name: str,
    write: BatchWriter,
    checkpoints: str,
    *,
    trigger: str = TRIGGER_INTERVAL,
) -> StreamingQuery:
    writer = (
        rows.writeStream.queryName(f"{name}-events")
        .outputMode("append")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint_path(checkpoints, name))
    )
    return triggered(writer, trigger).start()


def start_flows(
    flows: Flows,
    tables: BatchTables,
    checkpoints: str,
    *,
    trigger: str = TRIGGER_INTERVAL,
    names: tuple[str, ...] = QUERY_NAMES,
    state_partitions: int | None = None,
) -> dict[str, StreamingQuery]:
    """Start the named queries with RocksDB state.

    ``state_partitions`` counts the tasks of the stateful operators. A checkpoint keeps the
    number it was made with, so choose it for the size the stream will grow to.
    """
    # Counting the rows of the state costs RocksDB a read before every write.
    settings = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB, COUNT_STATE_ROWS: "false", **COMPILED}
    if state_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(state_partitions)
    work = {
        "clean": (flows.clean, tables.write_arrivals if KEPT in flows.clean.columns else tables.write_clean),
        "quarantine": (flows.quarantine, tables.write_quarantine),
        "aggregates": (flows.aggregates, tables.write_aggregates),
    }
    with overridden(tables.spark, settings):
        return {name: start_query(work[name][0], name, work[name][1], checkpoints, trigger=trigger)
                for name in names}


def drain(queries: dict[str, StreamingQuery]) -> None:
    """Wait for queries that run ``availableNow``; a failed one raises its error here."""
    for query in queries.values():
        query.awaitTermination()


def failures_of(spark: SparkSession, queries: dict[str, StreamingQuery]) -> DataFrame:
    """Rows for the failure log, one per query that ended with an error."""
    errors = [(name, query.exception()) for name, query in queries.items()]
    rows = [
        (type(error).__name__, str(error), {"checkpoint": name})
        for name, error in errors
        if error is not None
    ]
    log = spark.createDataFrame(rows, "exception_class string, message string, metadata map<string,string>")
    return log.withColumn("detected_at", F.current_timestamp())
