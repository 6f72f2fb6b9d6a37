"""Ordered quality rules: the first one that fails names the row's error."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from tidegate.functions import as_now
from tidegate.model import RuleConfig
from tidegate.operators.parsing import (
    IS_MALFORMED,
    IS_WRONG_NUMBER,
    PARSED,
    TIMES,
    parse_events,
)

# Error types and message texts.
MALFORMED_JSON = "malformed_json"
MALFORMED_TIMESTAMP = "malformed_timestamp"
SCHEMA_VALIDATION = "schema_validation"
QUALITY_RULE = "quality_rule"
MALFORMED_JSON_MESSAGE = "payload is not valid JSON or does not match the event schema"
FAILED_FIELD_MESSAGE = "validation failed: "
UNKNOWN_FIELD = "unknown field"
# End of fixed values.

ERROR_COLUMNS = ("error_type", "failed_field", "error_message", "is_valid")


CLOCK = "_clock"
LISTED = "_listed"
#: A list of allowed types up to this length goes to every task.
LIST_ROWS = 100_000


@dataclass(frozen=True)
class Rule:
    """A row fails if the SQL condition holds. Conditions may use ``_parsed``, ``_times`` and ``_clock``."""

    error_type: str
    failed_field: str | None
    fails: str


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _outside(column: str, allowed: tuple[str, ...]) -> str:
    if not allowed:
        return f"{column} IS NOT NULL"
    return f"{column} NOT IN ({', '.join(_quoted(value) for value in allowed)})"


def event_rules(config: RuleConfig = RuleConfig(), *, listed_types: bool = False) -> list[Rule]:
    """The rules in the order they are tried.

    With ``listed_types`` a column ``_listed`` says whether the event type is allowed.
    """
    rules = [Rule(MALFORMED_JSON, None, IS_MALFORMED)]

    def require(name: str, error_type: str, fails: str) -> None:
        if name in config.required_fields:
            rules.append(Rule(error_type, name, fails))

    def blank(name: str) -> str:
        return f"{name} IS NULL OR trim({name}) = ''"

    require("event_id", SCHEMA_VALIDATION, blank("event_id"))
    require("event_timestamp", MALFORMED_TIMESTAMP, f"{TIMES}.event IS NULL")
    require("event_type", SCHEMA_VALIDATION, blank("event_type"))
    unlisted = f"NOT {LISTED}" if listed_types else _outside("event_type", config.event_types)
    rules.append(Rule(QUALITY_RULE, "event_type", unlisted))
    if config.require_user_or_device:
        rules.append(Rule(QUALITY_RULE, "user_id|device_id", "user_id IS NULL AND device_id IS NULL"))
    require("source_system", SCHEMA_VALIDATION, blank("source_system"))
    require("region", SCHEMA_VALIDATION, "region IS NULL")
    rules.append(Rule(QUALITY_RULE, "region", _outside("region", config.regions)))
    require("payload_version", SCHEMA_VALIDATION, "payload_version IS NULL")
    versions = _outside("payload_version", config.payload_versions)
    rules.append(Rule(QUALITY_RULE, "payload_version", versions))
    if config.require_metadata:
        rules.append(Rule(QUALITY_RULE, "metadata", "metadata IS NULL OR size(metadata) = 0"))
    if config.numeric_event_value:
        rules.append(Rule(QUALITY_RULE, "event_value", IS_WRONG_NUMBER))
    unsigned = _outside("event_type", config.signed_event_types)
    rules.append(Rule(QUALITY_RULE, "event_value", f"event_value < 0 AND {unsigned}"))
    latest = f"{CLOCK} + INTERVAL {int(config.future_tolerance_minutes)} MINUTES"
    rules.append(Rule(QUALITY_RULE, "event_timestamp", f"{TIMES}.event > {latest}"))
    rules.append(Rule(MALFORMED_TIMESTAMP, "ingestion_timestamp", f"{TIMES}.ingestion IS NULL"))
    return rules


def first_failure(rules: list[Rule]) -> Column:
    """One struct per failing row, null for a row that passes.

    Error type and failed field come out of the same branch, so they cannot disagree.
    """

    def error(rule: Rule) -> str:
        field = "CAST(NULL AS STRING)" if rule.failed_field is None else _quoted(rule.failed_field)
        return f"struct({_quoted(rule.error_type)} AS error_type, {field} AS failed_field)"

    branches = " ".join(f"WHEN {rule.fails} THEN {error(rule)}" for rule in rules)
    return F.expr(f"CASE {branches} END")


# What a row's error says, from the struct of ``first_failure``.
ERROR_MESSAGE = f"""CASE
  WHEN _failure.error_type = {_quoted(MALFORMED_JSON)} THEN {_quoted(MALFORMED_JSON_MESSAGE)}
  WHEN _failure IS NOT NULL
    THEN concat({_quoted(FAILED_FIELD_MESSAGE)}, coalesce(_failure.failed_field, {_quoted(UNKNOWN_FIELD)}))
END"""


def apply_rules(
    parsed: DataFrame, rules: list[Rule], now: Column | datetime | str | None = None
) -> DataFrame:
    """Adds ``error_type``, ``failed_field``, ``error_message`` and ``is_valid``."""
    judged = parsed.withColumn(CLOCK, as_now(now)).withColumn("_failure", first_failure(rules))
    return judged.selectExpr(
        "*",
        "_failure.error_type AS error_type",
        "_failure.failed_field AS failed_field",
        f"{ERROR_MESSAGE} AS error_message",
        "_failure IS NULL AS is_valid",
    ).drop(CLOCK, "_failure")


def check_events(
    raw: DataFrame,
    *,
    config: RuleConfig = RuleConfig(),
    now: Column | datetime | str | None = None,
) -> DataFrame:
    """Parse raw envelopes and judge every row."""
    return apply_rules(parse_events(raw), event_rules(config), now)


def valid_events(checked: DataFrame) -> DataFrame:
    """Valid rows without the error columns; their parsed times stay for the transformation."""
    return checked.where("is_valid").drop(PARSED, *ERROR_COLUMNS)


def invalid_events(checked: DataFrame) -> DataFrame:
    return checked.where("NOT is_valid")


def check_against_table(
    raw: DataFrame,
    allowed: DataFrame,
    *,
    config: RuleConfig = RuleConfig(),
    now: Column | datetime | str | None = None,
) -> DataFrame:
    """Like ``check_events``, with the event types kept in a table ``allowed(event_type)``.

    A list of up to `LIST_ROWS` types is counted and broadcast, however large the table it comes from:
    shuffled by type, all events would meet in as few tasks as there are types. A longer list
    joins as Spark sees fit.
    """
    names = allowed.select(F.col("event_type").alias("_name")).where("_name IS NOT NULL").distinct()
    if not allowed.isStreaming and names.limit(LIST_ROWS + 1).count() <= LIST_ROWS:
        names = F.broadcast(names)
    parsed = parse_events(raw)
    listed = parsed.join(names, parsed["event_type"] == names["_name"], "left")
    marked = listed.withColumn(LISTED, F.col("_name").isNotNull()).drop("_name")
    return apply_rules(marked, event_rules(config, listed_types=True), now).drop(LISTED)
