"""Rows as keyed JSON messages, and where messages go."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def encode(rows: DataFrame, key: Column) -> DataFrame:
    return rows.select(key.cast("string").alias("key"), F.to_json(F.struct("*")).alias("value"))


def encode_clean(clean: DataFrame) -> DataFrame:
    return encode(clean, F.col("event_id"))


def encode_quarantine(envelopes: DataFrame) -> DataFrame:
    return encode(envelopes, F.lit(None))


def encode_aggregates(aggregates: DataFrame) -> DataFrame:
    return encode(
        aggregates, F.concat_ws("|", F.col("window_start").cast("string"), "event_type", "region")
    )


def encode_any(rows: DataFrame) -> DataFrame:
    """Keyed by ``event_id`` where there is one."""
    return encode(rows, F.col("event_id") if "event_id" in rows.columns else F.lit(None))


def kafka_sink_options(servers: str, topic: str | None = None) -> dict[str, str]:
    """Without a topic each row names its own in a ``topic`` column."""
    options = {"kafka.bootstrap.servers": servers}
    return options if topic is None else {**options, "topic": topic}


def publish_kafka(messages: DataFrame, servers: str, topic: str | None = None) -> None:
    """A ``message_id`` goes along as a header."""
    if "message_id" in messages.columns:
        said = F.struct(F.lit("message_id").alias("key"), F.col("message_id").cast("binary").alias("value"))
        messages = messages.withColumn("headers", F.array(said)).drop("message_id")
    messages.write.format("kafka").options(**kafka_sink_options(servers, topic)).save()


def publish_table(messages: DataFrame, folder: str) -> None:
    """Messages that name their own topic, as a table with one folder per topic.

    Writing the same folder again replaces it, so a job may publish once more after a crash.
    """
    messages.write.mode("overwrite").partitionBy("topic").parquet(folder)
