"""Intermediate tables in the folder that driver and executors share; code for the executors."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from tidegate.session import overridden, scratch_dir

_SHIPPED: set[str] = set()


def written(df: DataFrame) -> DataFrame:
    """`df` written as Parquet below `spark.checkpoint.dir` and read back: its lineage ends there."""
    path = scratch_dir(df.sparkSession, "llm")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, rows: int = 2000):
    """At most `rows` rows at a time between Spark and Python, for jobs started in the block: whole texts take memory on both sides."""
    return overridden(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": str(rows)})


def written_in_small_batches(df: DataFrame, rows: int = 2000) -> DataFrame:
    """`written`, with small batches."""
    with small_batches(df.sparkSession, rows):
        return written(df)


def shipped(spark: SparkSession) -> SparkSession:
    """Sends this package's sources to the executors, once per session, as `--py-files` would."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        package = Path(__file__).resolve().parent.parent
        archive = Path(tempfile.mkdtemp(prefix="llm-ship-")) / f"{package.name}.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for source in sorted(package.rglob("*.py")):
                out.write(source, source.relative_to(package.parent))
        context.addPyFile(str(archive))
        _SHIPPED.add(context.applicationId)
    return spark
