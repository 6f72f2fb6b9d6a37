"""Schemas, value domains and the rule configuration."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import types as T

# The value domains, names and defaults every producer and consumer agrees on.
EVENT_TYPES = ("page_view", "click", "purchase", "sensor_reading", "error_event", "heartbeat")
REGIONS = ("us-east", "us-west", "eu-west", "ap-south")
PAYLOAD_VERSIONS = ("1.0", "1.1")
SIGNED_EVENT_TYPES = ("error_event",)
REQUIRED_FIELDS = (
    "event_id",
    "event_timestamp",
    "event_type",
    "source_system",
    "region",
    "payload_version",
)
LEDGER_STATUSES = ("received", "validated", "transformed", "written", "quarantined", "replayed")
LEDGER_TTL_SECONDS = 86_400
MAX_REPLAY_ATTEMPTS = 3
QUARANTINE_RATE_THRESHOLD = 0.10
WATERMARK = "10 minutes"
AGGREGATION_WINDOW = "5 minutes"
TRIGGER_INTERVAL = "10 seconds"
FUTURE_TOLERANCE_MINUTES = 5
QUERY_NAMES = ("clean", "quarantine", "aggregates")

RAW_TOPIC = "events.raw"
TRANSFORMED_TOPIC = "events.transformed"
AGGREGATED_TOPIC = "events.aggregated"
QUARANTINE_TOPIC = "events.quarantine"
DEAD_LETTER_TOPIC = "events.dead_letter"
REPLAY_TOPIC = "events.replay"

EVENT_FIELDS = (
    "event_id",
    "user_id",
    "device_id",
    "event_type",
    "event_timestamp",
    "ingestion_timestamp",
    "source_system",
    "region",
    "session_id",
    "event_value",
    "event_status",
    "payload_version",
    "metadata",
)
# End of fixed values.

COORDINATES = ("source_topic", "source_partition", "source_offset", "kafka_timestamp")


def _event_field_type(name: str) -> T.DataType:
    if name == "event_value":
        return T.DoubleType()
    if name == "metadata":
        return T.MapType(T.StringType(), T.StringType())
    return T.StringType()


EVENT_SCHEMA = T.StructType([T.StructField(name, _event_field_type(name)) for name in EVENT_FIELDS])

# What from_json reads, of a payload set into an outer object: the event with the retry counter a
# replay leaves in it, a closing member, and the text of rows that did not parse cleanly.
CORRUPT_FIELD = "_unreadable"
END_FIELD = "_end_of_payload"
PARSE_SCHEMA = T.StructType(
    [
        T.StructField(
            "event",
            T.StructType(
                EVENT_SCHEMA.fields
                + [T.StructField("_replay", T.StructType([T.StructField("retry_count", T.IntegerType())]))]
            ),
        ),
        T.StructField(END_FIELD, T.IntegerType()),
        T.StructField(CORRUPT_FIELD, T.StringType()),
    ]
)

# The columns a Kafka source delivers; files of the same shape stand in for a broker.
WIRE_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("updated_at", T.TimestampType()),
        T.StructField("expires_at", T.TimestampType()),
    ]
)

QUARANTINE_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("original_payload", T.StringType()),
        T.StructField("error_type", T.StringType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("failed_field", T.StringType()),
        T.StructField("processing_timestamp", T.StringType()),
        T.StructField("replay_eligible", T.BooleanType()),
        T.StructField("retry_count", T.IntegerType()),
    ]
)

AGGREGATE_SCHEMA = T.StructType(
    [
        T.StructField("window_start", T.TimestampType()),
        T.StructField("window_end", T.TimestampType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("source_system", T.StringType()),
        T.StructField("event_count", T.LongType()),
        T.StructField("average_event_value", T.DoubleType()),
        T.StructField("error_event_count", T.LongType()),
        T.StructField("unique_device_count", T.LongType()),
        T.StructField("window_date", T.DateType()),
    ]
)

METRIC_COUNTERS = ("valid", "quarantined", "duplicates", "aggregate_rows")


@dataclass(frozen=True)
class RuleConfig:
    """Which quality rules apply, and with which values."""

    event_types: tuple[str, ...] = EVENT_TYPES
    regions: tuple[str, ...] = REGIONS
    payload_versions: tuple[str, ...] = PAYLOAD_VERSIONS
    signed_event_types: tuple[str, ...] = SIGNED_EVENT_TYPES
    required_fields: tuple[str, ...] = REQUIRED_FIELDS
    require_user_or_device: bool = True
    require_metadata: bool = True
    numeric_event_value: bool = True
    future_tolerance_minutes: int = FUTURE_TOLERANCE_MINUTES

    @classmethod
    def from_file(cls, path: str) -> "RuleConfig":
        """Read a rule file: JSON, or YAML where a YAML parser is installed."""
        with open(path, encoding="utf-8") as handle:
            if path.endswith((".yaml", ".yml")):
                import yaml

                return cls.from_mapping(yaml.safe_load(handle) or {})
            return cls.from_mapping(json.load(handle))

    @classmethod
    def from_mapping(cls, settings: Mapping) -> "RuleConfig":
        """Build the configuration from a parsed rule file (YAML or JSON); gaps keep defaults."""
        event_types = tuple(settings.get("allowed_event_types", EVENT_TYPES))
        value_rules = settings.get("event_value", {})
        unsigned = value_rules.get("non_negative_event_types")
        signed = (
            SIGNED_EVENT_TYPES
            if unsigned is None
            else tuple(name for name in event_types if name not in set(unsigned))
        )
        return cls(
            event_types=event_types,
            regions=tuple(settings.get("allowed_regions", REGIONS)),
            payload_versions=tuple(settings.get("supported_payload_versions", PAYLOAD_VERSIONS)),
            signed_event_types=signed,
            required_fields=tuple(settings.get("required_fields", REQUIRED_FIELDS)),
            require_user_or_device=bool(
                settings.get("identity", {}).get("require_user_or_device", True)
            ),
            require_metadata=bool(settings.get("metadata", {}).get("required", True)),
            numeric_event_value=bool(value_rules.get("numeric_when_present", True)),
            future_tolerance_minutes=int(
                settings.get("event_timestamp", {}).get(
                    "future_tolerance_minutes", FUTURE_TOLERANCE_MINUTES
                )
            ),
        )
