"""Failures and rate alerts to stored incidents and an audit trail, as one batch job.

A run writes to folders named by its run id, and only incidents that no other run has stored; their
ids follow from the evidence. So a run that died half way can be repeated, and a later run over the
same logs adds nothing.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidegate.model import QUARANTINE_RATE_THRESHOLD
from tidegate.operators.incidents import incident_reports, incident_table, new_incidents, reports_with_fallback
from tidegate.operators.metrics import rate_alerts
from tidegate.operators.retries import audit_rows
from tidegate.operators.running import CHUNK
from tidegate.operators.triage import classify_failures, incident_contexts
from tidegate.sinks.tables import not_from, read_table, utc_day, write_batch

INCIDENT_SCHEMA = T.StructType(
    [T.StructField(name, T.StringType()) for name in ("incident_id", "incident_title", "severity", "summary", "likely_root_cause")]
    + [T.StructField(name, T.StringType()) for name in ("affected_components", "recommended_recovery_steps", "prevention_notes", "provider")]
    + [T.StructField("created_at", T.TimestampType()), T.StructField("evidence", T.StringType())]
)
AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("action", T.StringType()),
        T.StructField("success", T.BooleanType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("details", T.MapType(T.StringType(), T.StringType())),
    ]
)
RECORDED = "record_incident"


@dataclass
class IncidentJob:
    """``metrics`` has the columns of batch metrics and ``detected_at``; ``failures`` is a log of exceptions."""

    spark: SparkSession
    root: str
    run_id: str
    now: datetime
    threshold: float = QUARANTINE_RATE_THRESHOLD
    chunk: int = CHUNK

    @property
    def query_id(self) -> str:
        return f"incidents-{self.run_id}"

    def incidents(self) -> DataFrame:
        return read_table(self.spark, f"{self.root}/incidents", INCIDENT_SCHEMA)

    def audit(self) -> DataFrame:
        return read_table(self.spark, f"{self.root}/audit", AUDIT_SCHEMA)

    def reports(self, metrics: DataFrame, failures: DataFrame) -> DataFrame:
        """Rule-based reports of every alert and every failure."""
        moments = metrics.select("query_id", "batch_id", "detected_at")
        alerts = rate_alerts(metrics.drop("detected_at"), self.threshold, chunk=self.chunk).join(moments, ["query_id", "batch_id"])
        names = ("failure_type", "message", "metadata", "detected_at")
        both = classify_failures(failures).select(*names).unionByName(alerts.select(*names))
        return incident_reports(incident_contexts(both))

    def run(self, metrics: DataFrame, failures: DataFrame, external: DataFrame | None = None) -> DataFrame:
        """Store what is new, with an audit row each; returns this run's incidents."""
        reports = self.reports(metrics, failures)
        if external is not None:
            reports = reports_with_fallback(reports, external).drop("provider_fallback_reason")
        known = not_from(self.incidents(), self.query_id, 0)
        fresh = new_incidents(incident_table(reports), known).select(*INCIDENT_SCHEMA.fieldNames())
        self._write(fresh, "incidents")
        own = self.incidents().where(F.col("query_id") == self.query_id)
        noted = own.select(
            F.lit(RECORDED).alias("action"), F.lit(True).alias("success"),
            F.create_map(F.lit("incident_id"), "incident_id", F.lit("severity"), "severity").alias("details"),
        )
        self._write(audit_rows(noted, now=self.now).select(*AUDIT_SCHEMA.fieldNames()), "audit")
        return own

    def _write(self, rows: DataFrame, table: str) -> None:
        write_batch(rows, f"{self.root}/{table}", utc_day(int(self.now.timestamp())), self.query_id, 0)
