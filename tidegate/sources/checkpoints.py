"""Reads of a stream's checkpoint folder."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidegate.model import QUERY_NAMES


def checkpoint_path(root: str, query_name: str) -> str:
    if query_name not in QUERY_NAMES:
        raise ValueError(f"unknown query checkpoint: {query_name}")
    return f"{root.rstrip('/')}/{query_name}"


def latest_commit(spark: SparkSession, root: str, query_name: str) -> DataFrame:
    """One row: the highest committed batch of a query, null before the first commit.

    Only paths are read; the column list keeps file contents out of the scan.
    """
    folder = f"{checkpoint_path(root, query_name)}/commits"
    try:
        paths = spark.read.format("binaryFile").load(folder).select("path")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        paths = spark.createDataFrame([], "path string")
    name = F.regexp_extract("path", r"/(\d+)$", 1)
    return (
        paths.select(name.alias("_name"))
        .where(F.col("_name") != "")
        .agg(F.max(F.col("_name").cast("long")).alias("latest_commit"))
        .select(F.lit(query_name).alias("query_name"), "latest_commit")
    )


def late_mark(spark: SparkSession, root: str, query_name: str, batch_id: int) -> int | None:
    """The event time, in milliseconds, at or before which a batch drops rows as late; None if it drops none.

    That is the watermark the batch before went by, which the offset log holds.
    """
    if batch_id == 0:
        return None
    log = spark.read.text(f"{checkpoint_path(root, query_name)}/offsets/{batch_id - 1}")
    mark = F.get_json_object("value", "$.batchWatermarkMs").cast("long")
    row = log.where(F.startswith("value", F.lit("{"))).select(mark.alias("mark")).where("mark IS NOT NULL").first()
    return row.mark if row is not None and row.mark > 0 else None


def state_operators(spark: SparkSession, root: str, query_name: str) -> DataFrame:
    """The stateful operators of a query and their state partitions."""
    return spark.read.format("state-metadata").load(checkpoint_path(root, query_name))


def state_rows(spark: SparkSession, root: str, query_name: str, operator_id: int = 0) -> DataFrame:
    """Keys and values now held by one stateful operator."""
    reader = spark.read.format("statestore").option("operatorId", operator_id)
    return reader.load(checkpoint_path(root, query_name))
