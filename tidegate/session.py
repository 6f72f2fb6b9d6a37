"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# The JVM never compiles a method of more than 8000 bytes; Spark then takes its smaller generated classes instead.
COMPILED = {"spark.sql.codegen.hugeMethodLimit": "8000"}


def local_session(app: str = "tidegate", cores: int | str = "*", memory: str = "8g") -> SparkSession:
    """A session for tests and benches; a cluster brings its own."""
    partitions = "8" if cores == "*" else str(cores)
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.streaming.forceDeleteTempCheckpointLocation", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def pin_utc(spark: SparkSession) -> SparkSession:
    """Naive timestamps mean UTC everywhere in this package."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder of the machine.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tidegate-"))
        root = context.getCheckpointDir()
    return root.rstrip("/")


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder below the shared root."""
    return f"{shared_root(spark)}/{purpose}-{uuid.uuid4().hex[:12]}"


@contextmanager
def overridden(spark: SparkSession, settings: dict[str, str]):
    """Session settings for the length of a block. A stream keeps those it was started under."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield spark
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
