"""Event sources: Kafka, or files holding the same record columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidegate.model import RAW_TOPIC, WIRE_SCHEMA


def kafka_options(
    servers: str,
    topic: str = RAW_TOPIC,
    *,
    starting_offsets: str = "latest",
    fail_on_data_loss: bool = False,
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    return options


def kafka_stream(spark: SparkSession, servers: str, topic: str = RAW_TOPIC, **options) -> DataFrame:
    """Raw envelopes of one topic. Needs Spark's Kafka connector on the class path."""
    reader = spark.readStream.format("kafka").options(**kafka_options(servers, topic, **options))
    return raw_envelope(reader.load())


def file_stream(
    spark: SparkSession,
    path: str,
    *,
    format: str = "parquet",
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: str | None = None,
) -> DataFrame:
    """Raw envelopes from a folder of record files."""
    reader = spark.readStream.format(format).schema(WIRE_SCHEMA)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if max_bytes_per_trigger is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    return raw_envelope(reader.load(path))


def raw_envelope(records: DataFrame) -> DataFrame:
    """The payload as text, next to where it came from."""
    return records.select(
        F.col("value").cast("string").alias("raw_payload"),
        F.col("topic").alias("source_topic"),
        F.col("partition").alias("source_partition"),
        F.col("offset").alias("source_offset"),
        F.col("timestamp").alias("kafka_timestamp"),
    )
