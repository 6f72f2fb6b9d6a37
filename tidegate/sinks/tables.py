"""Partitioned tables whose batches can be written again without harm.

Layout: ``<root>/day=<d>/query_id=<q>/batch_id=<n>/<partition columns>/``. The query id is part
of the path because a new checkpoint counts batches from 0 again. The day is that of the batch's
own clock, which the checkpoint keeps, so a repeated batch finds its folder again. Readers that
look back a limited time open the folders of those days and list no others.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta, timezone
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidegate.session import COMPILED, overridden
from tidegate.sinks.snapshots import BATCH_COLUMNS, Manifest, latest_manifest

CLEAN_PARTITIONS = ("event_date", "region")
AGGREGATE_PARTITIONS = ("window_date", "event_type")


def utc_day(epoch_seconds: int) -> date:
    return datetime.fromtimestamp(epoch_seconds, timezone.utc).date()


def days_back(epoch_seconds: int, seconds: int) -> list[date]:
    """The days touched by the given length of time before an instant."""
    first, last = utc_day(epoch_seconds - seconds), utc_day(epoch_seconds)
    return [first + timedelta(days=n) for n in range((last - first).days + 1)]


def batch_folder(root: str, day: date, query_id: str, batch_id: int) -> str:
    return f"{root.rstrip('/')}/day={day.isoformat()}/query_id={query_id}/batch_id={batch_id}"


def write_batch(
    rows: DataFrame,
    root: str,
    day: date,
    query_id: str,
    batch_id: int,
    *,
    partition_by: Sequence[str] = (),
    format: str = "parquet",
) -> None:
    """Write one batch to its own folder, replacing what an earlier try left there.

    Rows of one partition are brought together so that it gets few files; adaptive execution
    splits those that are too large for one task.
    """
    if partition_by:
        rows = rows.hint("rebalance", *partition_by)
    writer = rows.write.format(format).mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with overridden(rows.sparkSession, COMPILED):
        writer.save(batch_folder(root, day, query_id, batch_id))


def read_table(
    spark: SparkSession,
    root: str,
    schema: T.StructType,
    *,
    days: Sequence[date] | None = None,
    folders: Sequence[str] | None = None,
    format: str = "parquet",
) -> DataFrame:
    """A batch-keyed table with its batch columns, whole, of some days or of some folders; empty if not there.

    Of a table that has been compacted, what its manifest names as live; a segment that none names is not.
    """
    whole = T.StructType(schema.fields + BATCH_COLUMNS)
    root = root.rstrip("/")
    if folders is None:
        folders = [root] if days is None else [f"{root}/day={day.isoformat()}" for day in days]
    found = []
    for folder in folders:
        try:
            reader = spark.read.format(format).schema(whole).option("basePath", root)
            found.append(reader.load(folder))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    if not found:
        return empty_table(spark, whole)
    manifest = latest_manifest(spark, root) or Manifest()
    return reduce(DataFrame.unionByName, found).where(manifest.is_live())


def empty_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows, known to the optimizer as such: a join with them is planned without a shuffle or a Python worker."""
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]).limit(0)


def folders_of_others(
    spark: SparkSession,
    root: str,
    query_id: str,
    days: Sequence[date] | None = None,
    *,
    since: date | None = None,
    named: str = "",
) -> list[str]:
    """Day folders that other queries have in a table. Lists days and queries, never batches.

    ``since`` leaves out earlier days; ``named`` asks for queries whose id begins so.
    """
    jvm, session = spark._jvm, spark._jsparkSession
    pattern = jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/day=*/query_id=*")
    found = pattern.getFileSystem(session.sessionState().newHadoopConf()).globStatus(pattern)
    paths = [status.getPath().toString() for status in found or []]
    wanted = None if days is None else {f"day={day.isoformat()}" for day in days}
    first = "" if since is None else f"day={since.isoformat()}"
    return [
        path for path in paths
        if not path.endswith(f"/query_id={query_id}")
        and path.split("/")[-1].startswith(f"query_id={named}")
        and (wanted is None or path.split("/")[-2] in wanted)
        and path.split("/")[-2] >= first
    ]


def not_from(rows: DataFrame, query_id: str, batch_id: int) -> DataFrame:
    """All batches but one; a filter on partition columns, so the batch's files are not opened."""
    return rows.where(~((F.col("query_id") == query_id) & (F.col("batch_id") == batch_id)))
