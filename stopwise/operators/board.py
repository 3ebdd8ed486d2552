"""Live views: one row per bus."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.labels import delay_status, direction_label, display_delay
from ..functions.times import day_start_sql, second_of_day_sql
from .asof import match_schedule, next_intervals
from .joins import join_dimension
from .position import route_position
from .timetable import schedule_valid, ways


def latest_ping(pings: DataFrame, tie_break: list[str] | None = None) -> DataFrame:
    """Newest ping of each bus. Partial maxima are taken before the shuffle."""
    order = F.struct("event_s", *(tie_break or ["lat", "lon"]))
    return (pings.groupBy("codBus").agg(F.max_by(F.struct(*pings.columns), order).alias("_p"))
            .select("_p.*"))


def live_status(pings: DataFrame, stops: DataFrame, schedule: DataFrame, **options) -> DataFrame:
    """Route position and next scheduled time of each bus of a snapshot.

    After the last time of the day the first one of tomorrow is next.
    """
    placed = route_position(pings, stops)
    timed = match_schedule(
        placed, next_intervals(schedule_valid(schedule), ["stop_id", *ways(schedule)], wrap=True),
        {"stop_id": "next_stop_id", **{c: c for c in ways(schedule)}},
        second_of_day_sql("event_s"), **options)
    due = F.expr(f"{day_start_sql('event_s')} + scheduled_s")
    return timed.select(
        "codBus", "timestamp", "lat", "lon", *ways(schedule), "current_stop_id",
        "current_stop_name", "stop_sequence", "next_stop_id", "next_stop_name", "distance_m",
        F.timestamp_seconds(due).alias("next_scheduled_time"))


def board(vehicles: DataFrame, headsigns: DataFrame, mode: str = "heuristic") -> DataFrame:
    """Display rows from vehicle output: position, next stop, both delays, status."""
    if "predicted_delay_ml" not in vehicles.columns:
        vehicles = vehicles.withColumn("predicted_delay_ml", F.lit(None).cast("double"))
    named = join_dimension(vehicles, headsigns, ways(headsigns), salt_on=["bus_id"])
    heuristic, ml = F.col("predicted_delay_math"), F.col("predicted_delay_ml")
    shown = display_delay(mode, heuristic, ml)
    return named.select(
        "bus_id", "lat", "lon", F.col("next_stop_name").alias("next_stop"),
        F.coalesce("scheduled_time", F.lit("N/A")).alias("sched_time"),
        heuristic.alias("delay_math"), F.coalesce(ml, heuristic).alias("delay_ml"),
        shown.alias("delay_display"), F.col("next_stop_lat").alias("next_lat"),
        F.col("next_stop_lon").alias("next_lon"),
        direction_label(F.col("trip_headsign"), F.col("direction_id"))
        .alias("direction_formatted"),
        F.lit(mode).alias("prediction_method"), delay_status(shown).alias("status"),
        "last_update")
