"""Upkeep of batch-keyed tables: packed segments, and manifests that switch readers over.

Batches write small folders. Compaction packs the folders of settled batches into one segment for each
day, ``day=<d>/query_id=packed-<version>-<unique>/batch_id=0``, and then writes a manifest beside the
table, ``<root>-manifest/``. A manifest is one small file, so it is there or not: until it is, readers
see the batches and no segment of the run; from then on the segments and no batch that went into them.
A run that dies between the two leaves a segment that no manifest names, and a new run starts over.

A batch is settled when its query has begun a later one: a stream commits a batch before it begins the
next, so a settled batch is never written again. The newest batch of each query stays as it is.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Collection, Sequence
from dataclasses import dataclass, field
from datetime import date
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

BATCH_COLUMNS = [
    T.StructField("day", T.DateType()),
    T.StructField("query_id", T.StringType()),
    T.StructField("batch_id", T.LongType()),
]
PACKED = "packed-"
#: Live segments of a day; one more, and the day is packed anew.
MOST_SEGMENTS = 4
MANIFEST_SCHEMA = T.StructType(
    [
        T.StructField("version", T.LongType()),
        T.StructField("settled", T.MapType(T.StringType(), T.LongType())),
        T.StructField(
            "segments",
            T.ArrayType(T.StructType([T.StructField("day", T.DateType()), T.StructField("segment", T.StringType())])),
        ),
    ]
)


@dataclass(frozen=True)
class Manifest:
    """What of a table is live: segments by day, and of each query the batches behind the settled ones."""

    version: int = 0
    settled: dict[str, int] = field(default_factory=dict)
    segments: tuple[tuple[date, str], ...] = ()

    def is_live(self) -> Column:
        """A condition on the batch columns alone, so that it prunes folders before any file is opened."""
        packed = F.startswith(F.col("query_id"), F.lit(PACKED))
        gone = [(F.col("query_id") == q) & (F.col("batch_id") <= n) for q, n in sorted(self.settled.items())]
        named = [(F.col("day") == F.lit(d)) & (F.col("query_id") == s) for d, s in self.segments]
        either = lambda parts: reduce(Column.__or__, parts) if parts else F.lit(False)
        return (packed & either(named)) | (~packed & ~either(gone))

    def folders(self, root: str, days: Collection[date] | None = None) -> list[str]:
        """The live segments, of some days."""
        return [
            f"{root.rstrip('/')}/day={day.isoformat()}/query_id={segment}"
            for day, segment in self.segments
            if days is None or day in days
        ]


def manifest_path(root: str) -> str:
    return f"{root.rstrip('/')}-manifest"


def latest_manifest(spark: SparkSession, root: str) -> Manifest | None:
    """The manifest in force. Of two that raced for one version, the same one always counts."""
    try:
        rows = spark.read.schema(MANIFEST_SCHEMA).option("recursiveFileLookup", "true").json(manifest_path(root))
        row = rows.orderBy(F.desc("version"), F.to_json("segments")).first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    if row is None:
        return None
    return Manifest(row.version, dict(row.settled or {}), tuple((s.day, s.segment) for s in row.segments or []))


def write_manifest(spark: SparkSession, root: str, manifest: Manifest) -> None:
    """One file in a folder of its own; what an earlier try left half done is in another."""
    row = (manifest.version, manifest.settled, [(day, segment) for day, segment in manifest.segments])
    one = spark.createDataFrame([row], MANIFEST_SCHEMA).coalesce(1)
    one.write.json(f"{manifest_path(root)}/version={manifest.version}-{uuid.uuid4().hex[:12]}")


def batch_folders(spark: SparkSession, root: str) -> list[tuple[date, str, int]]:
    """(day, query, batch) of every folder of a table, live or not. Lists names; no file is opened."""
    try:
        paths = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    parts = r"/day=([0-9-]+)/query_id=([^/]+)/batch_id=(\d+)/"
    named = paths.select(*[F.regexp_extract("path", parts, n).alias(c) for n, c in ((1, "day"), (2, "query_id"), (3, "batch_id"))])
    rows = named.where("day <> ''").distinct().collect()
    return [(date.fromisoformat(r.day), r.query_id, int(r.batch_id)) for r in rows]


def compact(
    spark: SparkSession,
    root: str,
    schema: T.StructType,
    *,
    partition_by: Sequence[str] = (),
    rewrite: Callable[[DataFrame], DataFrame] | None = None,
    closed: Collection[str] = (),
    most_segments: int = MOST_SEGMENTS,
) -> Manifest | None:
    """Pack what has settled since the last run; gives the new manifest, or None if there was nothing.

    ``closed`` names queries that will never write again, whose newest batch is settled as well. With
    ``rewrite``, all settled rows of all days go through it, with their batch columns: a purge.
    """
    root = root.rstrip("/")
    before = latest_manifest(spark, root) or Manifest()
    batches = [b for b in batch_folders(spark, root) if not b[1].startswith(PACKED)]
    newest: dict[str, int] = {}
    for _, query, batch in batches:
        newest[query] = max(newest.get(query, -1), batch)
    settled = dict(before.settled)
    for query, batch in newest.items():
        last = batch if query in closed else max([b for _, q, b in batches if q == query and b < batch], default=-1)
        settled[query] = max(settled.get(query, -1), last)
    new = [b for b in batches if before.settled.get(b[1], -1) < b[2] <= settled[b[1]]]
    if not new and not (rewrite and before.segments):
        return None

    days = {day for day, _, _ in new}
    old = {day: [s for d, s in before.segments if d == day] for day, _ in before.segments}
    full = set(old) if rewrite else {day for day in days if len(old.get(day, [])) >= most_segments}
    segment = f"{PACKED}{before.version + 1}-{uuid.uuid4().hex[:8]}"
    folders = [f"{root}/day={d.isoformat()}/query_id={q}/batch_id={b}" for d, q, b in new]
    folders += [f"{root}/day={d.isoformat()}/query_id={s}/batch_id=0" for d in full for s in old.get(d, [])]
    _pack(spark, root, schema, folders, segment, partition_by, rewrite)

    written = {day for day, query, _ in batch_folders(spark, root) if query == segment}
    kept = [(d, s) for d, s in before.segments if d not in full]
    after = Manifest(before.version + 1, settled, tuple(sorted([*kept, *((d, segment) for d in written)])))
    write_manifest(spark, root, after)
    return after


def _pack(
    spark: SparkSession,
    root: str,
    schema: T.StructType,
    folders: list[str],
    segment: str,
    partition_by: Sequence[str],
    rewrite: Callable[[DataFrame], DataFrame] | None,
) -> None:
    """Rows of the folders as one segment for each day, few files each."""
    whole = T.StructType(schema.fields + BATCH_COLUMNS)
    rows = spark.read.schema(whole).option("basePath", root).parquet(*folders)
    rows = (rows if rewrite is None else rewrite(rows)).select(*whole.fieldNames())
    keys = ["day", "query_id", "batch_id", *partition_by]
    packed = rows.withColumn("query_id", F.lit(segment)).withColumn("batch_id", F.lit(0))
    packed.hint("rebalance", "day", *partition_by).write.mode("append").partitionBy(*keys).parquet(root)


def dead_folders(spark: SparkSession, root: str) -> list[str]:
    """Folders that no reader opens any more, for the store to remove when no old reader is left."""
    manifest = latest_manifest(spark, root)
    if manifest is None:
        return []
    live = set(manifest.segments)
    return [
        f"{root.rstrip('/')}/day={d.isoformat()}/query_id={q}/batch_id={b}"
        for d, q, b in batch_folders(spark, root)
        if ((d, q) not in live if q.startswith(PACKED) else b <= manifest.settled.get(q, -1))
    ]
