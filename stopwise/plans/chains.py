"""The programs as chains of operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.geo import GEODISTANCE
from ..functions.times import (calendar_features, clock_text, day_start_sql,
                               second_of_day_sql)
from ..operators.arrivals import (actual_delay, arrivals_by_radius, arrivals_by_visit,
                                  back_project, score_arrivals)
from ..operators.asof import match_schedule, nearest_intervals, next_intervals
from ..operators.forest import DelayForest
from ..operators.model import score
from ..operators.motion import advance, ewma_speed, heuristic_delay, link_pings
from ..operators.nearest import nearest_stop
from ..operators.timetable import ways, with_direction_fallback
from ..operators.training import label_window, training_rows, true_delay
from ..schemas import VEHICLE_OUTPUT
from ..session import stage


def training_set(matched: DataFrame, schedule: DataFrame, *, visits: bool = False,
                 staged: bool = True) -> DataFrame:
    """Matched pings to labelled rows.

    Arrivals and windows both read the matched pings. When ``staged`` they are written
    once to the shared folder, else Spark computes them for each branch.
    """
    if staged:
        matched = stage(matched, "matched")
    find = arrivals_by_visit if visits else arrivals_by_radius
    delays = true_delay(find(matched), schedule)
    return training_rows(label_window(matched, delays))


def enrich(pings: DataFrame, stops: DataFrame, schedule: DataFrame, *,
           service_day: str = "reference", upcoming: bool = False) -> DataFrame:
    """Add the nearest stop in the ping's direction, its schedule and calendar features.

    With the stops and schedule of a network, pings need ``route_id`` and keep to their route.
    The schedule is the nearest time, or the next one when ``upcoming``. Runs on batch
    and stream alike: the lookups are joins with measured dimensions.
    """
    near = nearest_stop(pings, with_direction_fallback(stops), metric=GEODISTANCE,
                        by=ways(stops))
    by = ["stop_id", *ways(schedule)]
    intervals = next_intervals if upcoming else nearest_intervals
    timed = match_schedule(near, intervals(schedule, by, service_day=service_day), by,
                           second_of_day_sql("event_s"))
    return timed.withColumns({
        "scheduled_epoch_s": F.expr(f"{day_start_sql('event_s')} + scheduled_s"),
        "scheduled_time": F.coalesce(clock_text("scheduled_s"), F.lit("N/A")),
        **calendar_features("timestamp"),
    }).drop("scheduled_s")


def score_enriched(enriched: DataFrame, model: DelayForest | None) -> DataFrame:
    """Add ``predicted_delay_ml``. A ping without a scheduled time waits 0 seconds."""
    wait = F.coalesce(F.col("scheduled_epoch_s") - F.col("event_s"), F.lit(0)).cast("double")
    return score(enriched.withColumn("seconds_to_scheduled", wait), model,
                 "predicted_delay_ml").drop("seconds_to_scheduled")


def track(enriched: DataFrame, *, speed: str = "instant", staged: bool = True,
          reset_on_direction: bool = False, **motion) -> DataFrame:
    """Speed, heuristic delay and stop advance of enriched pings, one per bus and second.

    With ``reset_on_direction`` a bus that turns round does not arrive by it.

    The pings are read twice, for the segments and for their summaries. When ``staged``
    they are written once to the shared folder first.
    """
    if staged:
        enriched = stage(enriched, "enriched")
    linked = link_pings(enriched, **motion)
    if speed == "ewma":
        linked = ewma_speed(linked)
    elif speed != "instant":
        raise ValueError(f"unknown speed mode {speed!r}")
    return advance(heuristic_delay(linked), reset_on_direction=reset_on_direction)


def evaluate_arrivals(tracked: DataFrame, stops: DataFrame, schedule: DataFrame, *,
                      strict: bool = False, service_day: str = "reference") -> DataFrame:
    """Add the passed stop, its estimated arrival and the actual delay."""
    projected = back_project(tracked, with_direction_fallback(stops))
    return actual_delay(projected, schedule, strict=strict, service_day=service_day)


def vehicle_output(df: DataFrame) -> DataFrame:
    """The 20 output fields, and the route if known; ``df`` needs ``final_math_error``, null for none."""
    renamed = df.withColumns({
        "bus_id": F.col("codBus"),
        "next_stop_name": F.col("stop_name"),
        "next_stop_lat": F.col("stop_lat"),
        "next_stop_lon": F.col("stop_lon"),
        "is_arrival_event": F.col("passed_sequence").isNotNull().cast("int"),
        "actual_delay": F.when(F.col("passed_stop_id").isNotNull(), F.col("actual_delay"))
                         .otherwise(0.0),
        "final_math_error": F.coalesce("final_math_error", F.lit(-1.0)),
    })
    more = [c for c in ("route_id", "predicted_delay_ml", "final_ml_error") if c in df.columns]
    return renamed.select(*VEHICLE_OUTPUT, *more)


def vehicle_replay(enriched: DataFrame, stops: DataFrame, schedule: DataFrame, *,
                   segment_s: int | None = None, service_day: str = "reference",
                   strict: bool = False, **motion) -> DataFrame:
    """Output of the vehicle stream, computed from history with windows only.

    ``strict`` leaves the delay of an arrival without a scheduled time null. The errors read the
    arrivals three times, so these are written once too when ``staged``.
    """
    cut = {"segment_s": segment_s} if segment_s else {}
    tracked = track(enriched, **motion, **cut)
    arrived = evaluate_arrivals(tracked, stops, schedule, strict=strict, service_day=service_day)
    if motion.get("staged", True):
        arrived = stage(arrived.drop("before"), "arrived")
    predictions = {"predicted_delay_math": "final_math_error"}
    if "predicted_delay_ml" in enriched.columns:
        predictions["predicted_delay_ml"] = "final_ml_error"
    return vehicle_output(score_arrivals(arrived, predictions, **cut))
