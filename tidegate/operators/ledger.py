"""The idempotency ledger: an append-only table of id statuses with an expiry."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidegate.functions import as_now
from tidegate.model import LEDGER_STATUSES, LEDGER_TTL_SECONDS

# Reasons for refusing a ledger entry.
EMPTY_ID = "event_id cannot be empty"
BAD_STATUS = "Unsupported processing status: "
# End of fixed values.


def ledger_entries(
    ids: DataFrame,
    status: Column | str,
    *,
    now: Column | datetime | str | None = None,
    ttl_seconds: int = LEDGER_TTL_SECONDS,
) -> DataFrame:
    """Ledger rows for the ``event_id`` column of a frame."""
    updated = as_now(now)
    return ids.select(
        "event_id",
        (F.lit(status) if isinstance(status, str) else status).alias("status"),
        updated.alias("updated_at"),
        (updated + F.make_interval(secs=F.lit(ttl_seconds))).alias("expires_at"),
    )


def refusal(event_id: Column, status: Column) -> Column:
    """Why an entry may not enter the ledger, null if it may."""
    known = F.coalesce(status.isin(*LEDGER_STATUSES), F.lit(False))
    return F.when(~known, F.concat(F.lit(BAD_STATUS), F.coalesce(status, F.lit("None")))).when(
        F.coalesce(event_id, F.lit("")) == "", F.lit(EMPTY_ID)
    )


def accepted_entries(entries: DataFrame) -> DataFrame:
    return entries.where(refusal(F.col("event_id"), F.col("status")).isNull())


def rejected_entries(entries: DataFrame) -> DataFrame:
    return entries.withColumn("reason", refusal(F.col("event_id"), F.col("status"))).where(
        "reason IS NOT NULL"
    )


def strict_entries(entries: DataFrame) -> DataFrame:
    """The entries unchanged; the job fails on the first one that may not enter."""
    reason = refusal(F.col("event_id"), F.col("status"))
    checked = F.when(reason.isNotNull(), F.raise_error(reason).cast("string")).otherwise(F.col("status"))
    return entries.withColumn("status", checked)


def live_entries(ledger: DataFrame, now: Column | datetime | str | None = None) -> DataFrame:
    """Entries that have not expired. On a ledger partitioned by date the filter prunes."""
    return ledger.where(F.col("expires_at") > as_now(now))


def current_status(
    ledger: DataFrame, now: Column | datetime | str | None = None, *, ttl_seconds: int | None = None
) -> DataFrame:
    """The last status written per id, if it has not expired.

    Each write renews the expiry, so the last write decides before the expiry is looked at.
    The group limit behind ``row_number() = 1`` runs on both sides of the shuffle. Where every
    entry lives ``ttl_seconds``, older writes cannot be live, and a filter on their time drops
    them before the shuffle; by day it prunes the scan.
    """
    if ttl_seconds is not None:
        ledger = ledger.where(F.col("updated_at") > as_now(now) - F.make_interval(secs=F.lit(ttl_seconds)))
    newest = Window.partitionBy("event_id").orderBy(F.desc("updated_at"), F.desc(stage("status")))
    last = ledger.withColumn("_nth", F.row_number().over(newest)).where("_nth = 1").drop("_nth")
    return live_entries(last, now)


def stage(status: Column | str) -> Column:
    """Position in the life cycle; settles two writes of the same instant."""
    return F.array_position(F.array(*[F.lit(name) for name in LEDGER_STATUSES]), F.col(status))


def distinct_ids(rows: DataFrame) -> DataFrame:
    return rows.where("event_id IS NOT NULL").select("event_id").distinct()


def claim(
    candidates: DataFrame,
    ledger: DataFrame,
    *,
    now: Column | datetime | str | None = None,
    ttl_seconds: int = LEDGER_TTL_SECONDS,
) -> DataFrame:
    """Ledger rows ``received`` for those candidate ids that are unseen or expired."""
    taken = live_entries(ledger, now).select("event_id").distinct()
    fresh = distinct_ids(candidates).join(taken, "event_id", "left_anti")
    return ledger_entries(fresh, "received", now=now, ttl_seconds=ttl_seconds)


def claim_outcomes(
    candidates: DataFrame, ledger: DataFrame, now: Column | datetime | str | None = None
) -> DataFrame:
    """Every distinct candidate id and whether a claim on it succeeds."""
    taken = live_entries(ledger, now).select("event_id").distinct().withColumn("_taken", F.lit(True))
    return (
        distinct_ids(candidates)
        .join(taken, "event_id", "left")
        .select("event_id", F.col("_taken").isNull().alias("claimed"))
    )


def written_ids(
    ledger: DataFrame, now: Column | datetime | str | None = None, *, ttl_seconds: int | None = None
) -> DataFrame:
    return current_status(ledger, now, ttl_seconds=ttl_seconds).where("status = 'written'").select("event_id")


def purged(ledger: DataFrame, now: Column | datetime | str | None = None) -> DataFrame:
    """What is left of a ledger without expired entries, one per id: the table to replace it with."""
    return current_status(ledger, now)


def store_bucketed(ledger: DataFrame, table: str, path: str, buckets: int) -> DataFrame:
    """The ledger as a table bucketed and sorted by id, read back.

    A window over ids and a join on them find its rows where they need them: only the batch moves,
    to the ledger's buckets, and the ledger is never shuffled. Take as many buckets as shuffle
    partitions, or more.
    """
    writer = ledger.write.mode("overwrite").option("path", path).bucketBy(buckets, "event_id").sortBy("event_id")
    writer.saveAsTable(table)
    return ledger.sparkSession.table(table)


def admit(batch: DataFrame, written: DataFrame) -> DataFrame:
    """Rows of a batch whose id is not among the written ids.

    ``written`` is made distinct first: a hot id shrinks before the shuffle, and the distinct
    ids are then already placed for the join.
    """
    return batch.join(written.select("event_id").distinct(), "event_id", "left_anti")


def idempotent_gate(
    batch: DataFrame,
    ledger: DataFrame,
    now: Column | datetime | str | None = None,
    *,
    ttl_seconds: int | None = None,
) -> DataFrame:
    """Skip ids already written; unseen, expired and unfinished ids go through."""
    return admit(batch, written_ids(ledger, now, ttl_seconds=ttl_seconds))


def gate_duplicates(
    batch: DataFrame,
    ledger: DataFrame,
    now: Column | datetime | str | None = None,
    *,
    ttl_seconds: int | None = None,
) -> DataFrame:
    """One row: distinct ids of the batch, those admitted, and the duplicates among them."""
    written = written_ids(ledger, now, ttl_seconds=ttl_seconds).distinct().withColumn("_written", F.lit(True))
    seen = distinct_ids(batch).join(written, "event_id", "left")
    return seen.agg(
        F.count("*").alias("distinct_ids"),
        F.count_if(F.col("_written").isNull()).alias("admitted"),
        F.count_if(F.col("_written").isNotNull()).alias("duplicates"),
    )


def mark_quarantined(
    invalid: DataFrame,
    ledger: DataFrame,
    *,
    now: Column | datetime | str | None = None,
    ttl_seconds: int = LEDGER_TTL_SECONDS,
) -> DataFrame:
    """Ledger rows ``quarantined`` for ids of invalid rows that have no live status."""
    known = current_status(ledger, now, ttl_seconds=ttl_seconds).select("event_id")
    new = distinct_ids(invalid).join(known, "event_id", "left_anti")
    return ledger_entries(new, "quarantined", now=now, ttl_seconds=ttl_seconds)
