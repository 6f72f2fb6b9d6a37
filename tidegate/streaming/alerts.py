"""The quarantine-rate alert as a stream: running totals and the armed trigger live in the checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor

from tidegate.model import QUARANTINE_RATE_THRESHOLD
from tidegate.operators.metrics import alert_rows

FIRED = "query_id string, batch_id long, total_valid long, total_quarantined long, quarantine_rate double"


def rate_trigger(threshold: float) -> StatefulProcessor:
    """Adds up a query's counters and gives the batches at which the rate goes above the threshold.

    The trigger is armed while the rate is at or below it, which the totals before a batch tell. The
    class is made here, so that it travels to the workers whole and they need no installed package.
    """
    names = [field.split()[0] for field in FIRED.split(", ")]

    class RateTrigger(StatefulProcessor):
        def init(self, handle):
            self.totals = handle.getValueState("totals", "valid long, quarantined long")

        def handleInputRows(self, key, rows, timerValues):
            import pandas as pd

            new = pd.concat(list(rows)).sort_values("batch_id")
            valid, quarantined = self.totals.get() if self.totals.exists() else (0, 0)
            new["total_valid"] = valid + new["valid"].cumsum()
            new["total_quarantined"] = quarantined + new["quarantined"].cumsum()
            self.totals.update((int(new["total_valid"].iloc[-1]), int(new["total_quarantined"].iloc[-1])))
            new["quarantine_rate"] = self.rate(new["total_quarantined"], new["total_valid"])
            before = self.rate(new["total_quarantined"] - new["quarantined"], new["total_valid"] - new["valid"])
            yield new[(new["quarantine_rate"] > threshold) & ~(before > threshold)][names]

        def rate(self, quarantined, valid):
            return (quarantined / (quarantined + valid)).fillna(0.0)

        def close(self):
            pass

    return RateTrigger()


def alert_stream(metrics: DataFrame, threshold: float = QUARANTINE_RATE_THRESHOLD) -> DataFrame:
    """Failure rows of a stream of batch counters (query_id, batch_id, valid, quarantined).

    Within a micro-batch counters are added in order of batch_id. A restart goes on where the last
    committed micro-batch ended, so no alert is raised twice.
    """
    counters = metrics.select("query_id", "batch_id", "valid", "quarantined")
    fired = counters.groupBy("query_id").transformWithStateInPandas(rate_trigger(threshold), FIRED, "Append", "None")
    return alert_rows(fired, threshold)
