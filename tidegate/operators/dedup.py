"""Duplicate ids and late rows, on streams and on tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidegate.model import COORDINATES, WATERMARK
from tidegate.operators.running import running_over_batches

ARRIVAL_ORDER = ("ingestion_timestamp", "source_partition", "source_offset")


def dedup_stream(events: DataFrame, watermark: str = WATERMARK, *, bounded: bool = True) -> DataFrame:
    """First arrival per ``event_id``.

    Rows without an id are kept. ``bounded`` forgets an id once the watermark has passed it, so state stays proportional to
    the delay. The unbounded form remembers every id for ever.
    """
    named = events.withColumn("_copy_of", copy_key(events)).withWatermark("event_timestamp", watermark)
    if bounded:
        return named.dropDuplicatesWithinWatermark(["_copy_of"]).drop("_copy_of")
    return named.dropDuplicates(["_copy_of"]).drop("_copy_of")


def dedup_beside_arrivals(events: DataFrame, watermark: str = WATERMARK, *, partitions: int) -> DataFrame:
    """First arrivals, ``_kept``, and beside them every arrival of the batch once more, not ``_kept``.

    What the stream drops, late rows and copies, is in the second part only. Both parts read one
    exchange by id of ``partitions`` tasks, the number of the state's own, so rows are parsed once.
    """
    named = events.withColumn("_copy_of", copy_key(events)).withWatermark("event_timestamp", watermark)
    placed = named.repartition(partitions, "_copy_of")
    kept = placed.dropDuplicatesWithinWatermark(["_copy_of"]).withColumn("_kept", F.lit(True))
    return kept.unionByName(placed.withColumn("_kept", F.lit(False))).drop("_copy_of")


def copy_key(events: DataFrame) -> Column:
    """What copies of one event share: its id, or for a row without one where it came from.

    A configuration may do without the id; rows that lack it are then events of their own.
    """
    source = [F.col(name).cast("string") for name in COORDINATES if name in events.columns]
    place = F.concat_ws("|", F.lit("no id"), *source) if source else F.uuid()
    return F.coalesce("event_id", place)


def dedup_first(events: DataFrame, order: Sequence[str] = ARRIVAL_ORDER) -> DataFrame:
    """The batch form: per ``event_id`` the row that arrived first.

    Spark turns ``row_number() = 1`` into a group limit that also runs before the shuffle, so
    the copies of a hot id shrink to one row per map task.
    """
    first = Window.partitionBy(copy_key(events)).orderBy(*order)
    return events.withColumn("_nth", F.row_number().over(first)).where("_nth = 1").drop("_nth")


def batch_watermarks(events: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    """Per ``batch_id`` the watermark in force when that batch was read.

    It is the greatest event time of all earlier batches minus the delay.
    """
    newest = events.groupBy("batch_id").agg(F.max("event_timestamp").alias("newest"))
    earlier = running_over_batches(
        newest, {"newest_before": (F.max, "newest")}, order="batch_id", inclusive=False
    )
    return earlier.select(
        "batch_id", (F.col("newest_before") - F.expr(f"interval '{watermark}'")).alias("watermark")
    )


def late_rows(events: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    """Rows a stream reading these batches in order would have dropped as late: those at the watermark or before it."""
    marks = batch_watermarks(events, watermark)
    return events.join(marks, "batch_id").where(F.col("event_timestamp") <= F.col("watermark"))
