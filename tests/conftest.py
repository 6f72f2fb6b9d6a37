import json
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidegate.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session("tidegate-tests", cores=8, memory="4g")
    if not session.conf.get("spark.checkpoint.dir", None):
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SMALL


GOOD = {
    "event_id": "evt-ferry-3",
    "user_id": "usr-harbour",
    "device_id": "dev-turnstile",
    "event_type": "purchase",
    "event_timestamp": "2026-01-15T12:00:00Z",
    "ingestion_timestamp": "2026-01-15T12:00:04Z",
    "source_system": "mobile",
    "region": "us-east",
    "session_id": "ses-morning",
    "event_value": 3.75,
    "event_status": "accepted",
    "payload_version": "1.1",
    "metadata": {"pier": "north"},
}
NOW = "2026-01-15T13:00:00Z"


def payload(**changes) -> str:
    """A sound event with some members changed; a member set to ``...`` is left out."""
    merged = {**GOOD, **changes}
    return json.dumps({name: value for name, value in merged.items() if value is not ...})


def raw_frame(spark, payloads):
    rows = [(text, "events.raw", 0, offset) for offset, text in enumerate(payloads)]
    frame = spark.createDataFrame(
        rows, "raw_payload string, source_topic string, source_partition int, source_offset long"
    )
    from pyspark.sql import functions as F

    return frame.withColumn("kafka_timestamp", F.lit(NOW).cast("timestamp"))
