"""JSON text to typed columns, read once per row."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidegate.functions import event_time
from tidegate.model import CORRUPT_FIELD, END_FIELD, EVENT_FIELDS, PARSE_SCHEMA

# Quoted keys and finite numbers only; what breaks these rules lands in the unreadable field.
JSON_OPTIONS = {
    "columnNameOfCorruptRecord": CORRUPT_FIELD,
    "allowSingleQuotes": "false",
    "allowNonNumericNumbers": "false",
}

PARSED = "_parsed"
TIMES = "_times"
HELPERS = (PARSED, TIMES)

# The parser stops behind the first complete value and would not see what follows it. Inside an
# outer object the payload must be one whole value for the closing member to be reached.
# What could go on there, a comma and more members, breaks a list or makes it longer, and what could
# close a list breaks the object: only one whole value fits both, and nothing else is read at all.
IS_ONE_VALUE = "json_array_length(concat('[', raw_payload, ']')) = 1"
WRAPPED = f"""concat('{{"event":', raw_payload, ',"{END_FIELD}":1}}')"""


def parse_events(raw: DataFrame) -> DataFrame:
    """Adds the event fields, ``_parsed`` and ``_times`` to rows holding ``raw_payload``.

    Catalyst would copy the parse into every filter below which a projection sits, and run it
    once per rule there. Exploding a one-element array keeps it in one place: filters on its
    output stay above it. The same goes for the two timestamps, which the rules and the
    transformation both need.
    """
    read = F.when(F.expr(IS_ONE_VALUE), F.from_json(F.expr(WRAPPED), PARSE_SCHEMA, JSON_OPTIONS))
    parsed = raw.withColumn(PARSED, F.explode(F.array(read)))
    times = F.struct(
        event_time(f"{PARSED}.event.event_timestamp").alias("event"),
        event_time(f"{PARSED}.event.ingestion_timestamp").alias("ingestion"),
    )
    timed = parsed.withColumn(TIMES, F.explode(F.array(times)))
    return timed.selectExpr("*", *[f"{PARSED}.event.{name}" for name in EVENT_FIELDS])


# True if the payload is not one JSON value: broken text, several values, text behind the first. Only
# rows the parser flagged pay for a third look, which tells text broken within a member from sound
# JSON with a value of the wrong type.
IS_MALFORMED = f"""{PARSED}.{END_FIELD} IS NULL
  OR ({PARSED}.{CORRUPT_FIELD} IS NOT NULL AND try_parse_json(raw_payload) IS NULL)"""

# True if event_value is present but is not a finite JSON number. NaN sorts above infinity, so
# one comparison covers both.
IS_WRONG_NUMBER = f"""({PARSED}.{CORRUPT_FIELD} IS NOT NULL AND event_value IS NULL
  AND get_json_object(raw_payload, '$.event_value') IS NOT NULL)
  OR coalesce(abs(event_value) >= double('infinity'), false)"""


def drop_helpers(df: DataFrame) -> DataFrame:
    return df.drop(*HELPERS)
