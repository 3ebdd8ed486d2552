"""Cleaning of raw pings, shared by batch and stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.labels import direction_id
from ..functions.times import parse_feed_time

# Feed spellings, in lower case, and our column names.
FEED_NAMES = {
    "codlinea": "codLinea",
    "codbus": "codBus",
    "latitud": "lat",
    "longitud": "lon",
    "codparini": "codParIni",
}


def normalise_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[FEED_NAMES.get(c.strip().lower(), c.strip().lower()) for c in df.columns])


def select_available(df: DataFrame, expected: list[str]) -> DataFrame:
    """The expected columns in order; those the feed lacks are null."""
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c)
                       for c in expected])


def line_code(codlinea: Column) -> Column:
    return F.regexp_replace(codlinea, r"\.0$", "")


def clean_pings(raw: DataFrame, line: str | None = None) -> DataFrame:
    """Typed pings of one line (all lines when ``line`` is None).

    Rows without a bus, with bad coordinates or a bad time are skipped. The line is
    tested on the raw spellings so that the filter reaches the scan.
    """
    if line is not None:
        raw = raw.filter(F.col("codLinea").isin(line, f"{line}.0"))
    extra = [c for c in ("codParIni", "ingest_time") if c in raw.columns]
    return (
        raw.filter(F.col("codBus").isNotNull())
        .select(
            "codBus",
            line_code(F.col("codLinea")).alias("codLinea"),
            direction_id(F.col("sentido")).alias("direction_id"),
            F.col("lat").try_cast("double").alias("lat"),
            F.col("lon").try_cast("double").alias("lon"),
            "last_update",
            parse_feed_time("last_update").alias("timestamp"),
            *extra,
        )
        .filter(F.col("lat").isNotNull() & F.col("lon").isNotNull()
                & F.col("timestamp").isNotNull())
        .withColumn("event_s", F.unix_seconds("timestamp"))
    )


def dedup_pings(pings: DataFrame, tie_break: list[str] | None = None) -> DataFrame:
    """One ping per bus and second. The rank limit runs before the shuffle as well, so
    many copies of one ping never meet in one task."""
    tie_break = tie_break or ["lat", "lon", "direction_id"]
    w = Window.partitionBy("codBus", "event_s").orderBy(*tie_break)
    return pings.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def stamp_snapshot(df: DataFrame, name: str = "snapshot_time", from_file: bool = False) -> DataFrame:
    """Add when the snapshot was taken: now, or when its file was written."""
    when = F.col("_metadata.file_modification_time") if from_file else F.current_timestamp()
    return df.withColumn(name, when)
