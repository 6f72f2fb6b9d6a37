"""The three streams: clean rows, quarantine envelopes, window aggregates."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame

from tidegate.model import AGGREGATION_WINDOW, COORDINATES, WATERMARK, RuleConfig
from tidegate.operators.aggregate import stored_windows
from tidegate.operators.dedup import dedup_beside_arrivals, dedup_stream
from tidegate.operators.quarantine import quarantine_envelope
from tidegate.operators.rules import check_events, invalid_events, valid_events
from tidegate.operators.transform import transform_events


@dataclass(frozen=True)
class Flows:
    clean: DataFrame
    quarantine: DataFrame
    aggregates: DataFrame


def build_flows(
    raw: DataFrame,
    *,
    config: RuleConfig = RuleConfig(),
    now: Column | datetime | str | None = None,
    watermark: str = WATERMARK,
    window: str = AGGREGATION_WINDOW,
    bounded_dedup: bool = True,
    arrivals: int | None = None,
) -> Flows:
    """Declare all three on one stream of raw envelopes.

    Without ``now`` the clock is that of each micro-batch. With ``arrivals``, the number of the
    state's partitions, the clean flow brings all arrivals along, so that what it drops can be kept.
    """
    checked = check_events(raw, config=config, now=now)
    rows = transform_events(valid_events(checked), now=now)
    clean = dedup_stream(rows, watermark, bounded=bounded_dedup)
    return Flows(
        clean=clean if arrivals is None else dedup_beside_arrivals(rows, watermark, partitions=arrivals),
        quarantine=quarantine_envelope(invalid_events(checked), now=now, keep=COORDINATES),
        aggregates=stored_windows(clean, window),
    )
