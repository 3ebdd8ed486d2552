"""Cleaning and de-duplication on a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.clean import clean_pings


def clean_stream(raw: DataFrame, line: str | None = None) -> DataFrame:
    return clean_pings(raw, line)


def dedup_stream(pings: DataFrame, late: str = "10 minutes") -> DataFrame:
    """One ping per bus and time. State is dropped once the watermark has passed it."""
    return (pings.withWatermark("timestamp", late)
            .dropDuplicatesWithinWatermark(["codBus", "timestamp"]))
