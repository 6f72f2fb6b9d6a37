"""Running totals over batch numbers that do not gather a query's history in one task."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

CHUNK = 10_000


def running_over_batches(
    batches: DataFrame,
    totals: Mapping[str, tuple[Callable[[str], Column], str]],
    *,
    keys: Sequence[str] = (),
    order: str = "batch_id",
    inclusive: bool = True,
    chunk: int = CHUNK,
) -> DataFrame:
    """Adds running aggregates in the order of an integer column, per ``keys``.

    ``totals`` maps a new column to an aggregate (``F.sum``, ``F.max``) and its input. Batches
    fall into chunks of consecutive numbers. Each chunk is scanned on its own; only one row per
    chunk meets in the second window, which carries the totals of earlier chunks.
    """
    chunked = batches.withColumn("_chunk", F.floor(F.col(order) / chunk).cast("long"))
    last = Window.currentRow if inclusive else -1
    inside = (
        Window.partitionBy(*keys, "_chunk").orderBy(order).rowsBetween(Window.unboundedPreceding, last)
    )
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)

    per_chunk = chunked.groupBy(*keys, "_chunk").agg(
        *[function(source).alias(f"_whole_{name}") for name, (function, source) in totals.items()]
    )
    carried = per_chunk.select(
        *[F.col(key).alias(f"_key_{key}") for key in keys],
        F.col("_chunk").alias("_carried_chunk"),
        *[
            function(f"_whole_{name}").over(before).alias(f"_before_{name}")
            for name, (function, _) in totals.items()
        ],
    )
    scanned = chunked.withColumns(
        {f"_inside_{name}": function(source).over(inside) for name, (function, source) in totals.items()}
    )
    same_chunk = F.col("_chunk") == F.col("_carried_chunk")
    for key in keys:
        same_chunk = same_chunk & F.col(key).eqNullSafe(F.col(f"_key_{key}"))
    joined = scanned.join(carried, same_chunk, "left")

    def combined(name: str, function: Callable) -> Column:
        parts = F.col(f"_inside_{name}"), F.col(f"_before_{name}")
        if function is F.max:
            return F.greatest(*parts)
        return F.when(parts[0].isNotNull() | parts[1].isNotNull(),
                      F.coalesce(parts[0], F.lit(0)) + F.coalesce(parts[1], F.lit(0)))

    return joined.select(
        *[column for column in batches.columns],
        *[combined(name, function).alias(name) for name, (function, _) in totals.items()],
    )
