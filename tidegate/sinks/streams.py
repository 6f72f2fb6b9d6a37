"""Generic streaming sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from tidegate.model import TRIGGER_INTERVAL
from tidegate.sinks.messages import encode_any, kafka_sink_options

AVAILABLE_NOW = "availableNow"


def triggered(writer: DataStreamWriter, trigger: str) -> DataStreamWriter:
    """A processing-time interval, or ``availableNow`` to drain the source and stop."""
    if trigger == AVAILABLE_NOW:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger)


def write_parquet_stream(
    rows: DataFrame,
    *,
    path: str,
    checkpoint: str,
    query_name: str,
    partition_by: Sequence[str] = (),
    output_mode: str = "append",
    trigger: str = TRIGGER_INTERVAL,
) -> StreamingQuery:
    writer = (
        rows.writeStream.format("parquet")
        .queryName(query_name)
        .outputMode(output_mode)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return triggered(writer, trigger).start()


def write_json_stream(
    rows: DataFrame,
    *,
    checkpoint: str,
    query_name: str,
    format: str = "kafka",
    servers: str | None = None,
    topic: str | None = None,
    path: str | None = None,
    output_mode: str = "append",
    trigger: str = TRIGGER_INTERVAL,
) -> StreamingQuery:
    """Rows as JSON messages to Kafka, or to a folder of message files."""
    writer = (
        encode_any(rows)
        .writeStream.format(format)
        .queryName(query_name)
        .outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
    )
    if format == "kafka":
        writer = writer.options(**kafka_sink_options(servers, topic))
    else:
        writer = writer.option("path", path)
    return triggered(writer, trigger).start()
