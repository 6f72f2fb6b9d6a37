"""Tumbling event-time aggregates, kept as states that merge.

A window's state is what adds up: rows, errors, the sum and the number of values, and a sketch of the
devices. Longer windows are sums of shorter ones, and late or replayed rows are added to the window
they belong to, in both cases without a look at the rows that made the states. Means and device
counts are read off a state at the end.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidegate.model import AGGREGATE_SCHEMA, AGGREGATION_WINDOW, SIGNED_EVENT_TYPES

GROUP_KEYS = ("event_type", "region", "source_system")
WINDOW_KEYS = ("window_start", "window_end", *GROUP_KEYS)
#: Registers of a device sketch, as a power of two: an error of about 1.6 % in at most 4 KB.
SKETCH_BITS = 12
#: What a state has beyond the finished columns.
STATE_FIELDS = [
    T.StructField("value_sum", T.DoubleType()),
    T.StructField("value_count", T.LongType()),
    T.StructField("devices", T.BinaryType()),
]
STATE_SCHEMA = T.StructType(AGGREGATE_SCHEMA.fields + STATE_FIELDS)


def window_states(clean: DataFrame, window_duration: str = AGGREGATION_WINDOW) -> DataFrame:
    """The state of each window, type, region and source. Combines before its one shuffle."""
    span = F.window("event_timestamp", window_duration)
    states = clean.groupBy(span.alias("span"), *GROUP_KEYS).agg(
        F.count("*").alias("event_count"),
        F.count_if(_is_error()).alias("error_event_count"),
        F.sum("event_value").alias("value_sum"),
        F.count("event_value").alias("value_count"),
        F.hll_sketch_agg("device_id", F.lit(SKETCH_BITS)).alias("devices"),
    )
    return _placed(states)


def merged_states(states: DataFrame, window_duration: str | None = None) -> DataFrame:
    """States of equal windows as one. With a duration, each goes to the window of that length it lies in.

    The duration must be a multiple of the states' own.
    """
    if window_duration is None:
        span = F.struct(F.col("window_start").alias("start"), F.col("window_end").alias("end"))
    else:
        span = F.window("window_start", window_duration)
    sums = ("event_count", "error_event_count", "value_sum", "value_count")
    merged = states.groupBy(span.alias("span"), *GROUP_KEYS).agg(
        *[F.sum(name).alias(name) for name in sums], F.hll_union_agg("devices").alias("devices")
    )
    return _placed(merged)


def states_with(states: DataFrame, added: DataFrame, window_duration: str = AGGREGATION_WINDOW) -> DataFrame:
    """The states of the windows that ``added`` rows fall into, with these rows in them.

    ``states`` has windows of the same duration. The windows looked for are few, and their dates let
    the scan of stored states skip other partitions.
    """
    new = window_states(added, window_duration)
    where = new.select(*WINDOW_KEYS, F.to_date("window_start").alias("window_date"))
    stored = states.withColumn("window_date", F.to_date("window_start")) if "window_date" not in states.columns else states
    same = [stored[name].eqNullSafe(where[name]) for name in where.columns]
    old = stored.join(where, reduce(Column.__and__, same), "left_semi")
    return merged_states(old.select(*new.columns).unionByName(new))


def finished(states: DataFrame, *more: str) -> DataFrame:
    """The columns of an aggregate, read off states; ``more`` names state columns to keep."""
    derived = {
        "average_event_value": F.try_divide("value_sum", "value_count"),
        "unique_device_count": F.hll_sketch_estimate("devices"),
        "window_date": F.to_date("window_start"),
    }
    names = AGGREGATE_SCHEMA.fieldNames()
    return states.select(*[derived[n].alias(n) if n in derived else F.col(n) for n in names], *more)


def aggregate_events(
    clean: DataFrame, window_duration: str = AGGREGATION_WINDOW, *, exact_devices: bool = False
) -> DataFrame:
    """Counts, mean value, errors and devices per window, type, region and source.

    Devices are estimated from the sketches. ``exact_devices`` counts them and pays a second shuffle;
    it is for tables, not streams.
    """
    if not exact_devices:
        return finished(window_states(clean, window_duration))
    span = F.window("event_timestamp", window_duration)
    exact = clean.groupBy(span.alias("span"), *GROUP_KEYS).agg(
        F.count("*").alias("event_count"),
        F.avg("event_value").alias("average_event_value"),
        F.count_if(_is_error()).alias("error_event_count"),
        F.count_distinct("device_id").alias("unique_device_count"),
    )
    dated = _placed(exact).withColumn("window_date", F.to_date("window_start"))
    return dated.select(*AGGREGATE_SCHEMA.fieldNames())


def stored_windows(clean: DataFrame, window_duration: str = AGGREGATION_WINDOW) -> DataFrame:
    """Finished windows with the states they were read off: what the streams store."""
    return finished(window_states(clean, window_duration), *[field.name for field in STATE_FIELDS])


def _is_error() -> Column:
    return F.col("event_type").isin(*SIGNED_EVENT_TYPES)


def _placed(groups: DataFrame) -> DataFrame:
    """Window bounds as columns."""
    others = [name for name in groups.columns if name != "span"]
    return groups.select(F.col("span.start").alias("window_start"), F.col("span.end").alias("window_end"), *others)
