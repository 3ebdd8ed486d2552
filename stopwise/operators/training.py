"""Labelled training rows from matched pings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.times import calendar_features, day_start_sql, second_of_day_sql
from ..settings import LABEL_WINDOW_S, TRAIN_MAX_DELAY_S, TRAIN_MAX_DISTANCE_M
from .asof import match_schedule, nearest_intervals
from .timetable import schedule_valid


def true_delay(arrivals: DataFrame, schedule: DataFrame, *,
               by_direction: bool = False, **options) -> DataFrame:
    """Scheduled time nearest to each arrival on its own day, and the delay in seconds.

    Only hours 0..23 take part and the direction is ignored unless ``by_direction``.
    """
    by = ["stop_id", "direction_id"] if by_direction else ["stop_id"]
    arrived = arrivals.withColumn("_actual_s", F.unix_seconds("actual_time"))
    matched = match_schedule(
        arrived, nearest_intervals(schedule_valid(schedule), by, horizon_s=None), by,
        second_of_day_sql("_actual_s"), how="inner", salt_on=["codBus"], **options)
    due = F.expr(f"CAST({day_start_sql('_actual_s')} + scheduled_s AS bigint)")
    return matched.select(
        "codBus", "stop_id", F.timestamp_seconds(due).alias("scheduled_time"), "actual_time",
        (F.col("_actual_s") - due).alias("true_delay_seconds"))


def label_window(matched: DataFrame, delays: DataFrame,
                 window_s: int = LABEL_WINDOW_S) -> DataFrame:
    """Pair each arrival with the pings of the same bus in the seconds before it.

    The join key holds the time cut into windows: an arrival looks into its own cut and
    the one before. One bus has at most ``window_s`` pings and as many arrivals per cut.
    """
    ping_s, actual_s = F.unix_seconds("timestamp"), F.unix_seconds("actual_time")
    pings = (matched.select("codBus", "timestamp", "lat", "lon", "stop_sequence", "distance_m")
             .withColumn("_cut", F.floor(ping_s / window_s)))
    here = F.floor((actual_s - 1) / window_s)
    first = F.floor((actual_s - window_s) / window_s)
    labels = delays.withColumn("_cut", F.explode(F.sequence(first, here)))
    return (pings.join(labels, ["codBus", "_cut"])
            .filter((F.unix_seconds("timestamp") >= F.unix_seconds("actual_time") - window_s)
                    & (F.col("timestamp") < F.col("actual_time")))
            .drop("_cut"))


def training_rows(windowed: DataFrame) -> DataFrame:
    return windowed.select(
        "timestamp", "lat", "lon", "stop_id", "stop_sequence", "distance_m",
        "scheduled_time", "actual_time",
        (F.unix_seconds("scheduled_time") - F.unix_seconds("timestamp"))
        .alias("seconds_to_scheduled"),
        "true_delay_seconds")


def add_features(df: DataFrame) -> DataFrame:
    """Calendar features and numeric types, the same for training and scoring."""
    types = {"lat": "double", "lon": "double", "stop_sequence": "int", "distance_m": "double",
             "seconds_to_scheduled": "double", "true_delay_seconds": "double"}
    casts = {c: F.col(c).cast(t) for c, t in types.items() if c in df.columns}
    return df.withColumns({**calendar_features("timestamp"), **casts})


def clean_training(df: DataFrame, max_distance_m: float = TRAIN_MAX_DISTANCE_M,
                   max_delay_s: int = TRAIN_MAX_DELAY_S) -> DataFrame:
    """Drop badly matched rows and outlying delays, then add features."""
    kept = df.filter((F.col("distance_m") < max_distance_m)
                     & F.col("true_delay_seconds").isNotNull()
                     & (F.abs("true_delay_seconds") < max_delay_s))
    return add_features(kept)


def hash_split(df: DataFrame, key: Column, share: float = 0.8) -> DataFrame:
    """Add ``is_train`` from a hash of the row's key: the same on every run and layout."""
    limit = format(int(share * 16 ** 8), "08x")
    return df.withColumn("is_train", F.substring(F.md5(key), 1, 8) < limit)
