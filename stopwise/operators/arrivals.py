"""Arrival detection, arrival delay and prediction error."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.geo import geodistance_m
from ..functions.labels import eta_seconds
from ..functions.times import day_start_sql, second_of_day_sql
from ..session import stage
from ..settings import ARRIVAL_RADIUS_M, PREDICTION_AGE_S, SEGMENT_S
from .asof import match_schedule, nearest_intervals
from .joins import join_dimension
from .sequences import segment_of
from .timetable import ways


def arrivals_by_radius(matched: DataFrame, radius_m: float = ARRIVAL_RADIUS_M) -> DataFrame:
    """First time each bus was within the radius of each stop, over all history."""
    return (matched.filter(F.col("distance_m") < radius_m)
            .groupBy("codBus", "stop_id").agg(F.min("timestamp").alias("actual_time")))


def arrivals_by_visit(matched: DataFrame, radius_m: float = ARRIVAL_RADIUS_M, *,
                      gap_s: int = 600, segment_s: int = SEGMENT_S, staged: bool = False) -> DataFrame:
    """First time of every visit: a new one starts after a gap in the close pings.

    Whether a close ping starts a visit depends on the one before it only, so segments
    need the last close second of the segment before and nothing else. The close pings are
    read twice, for the segments and for their summaries. When ``staged`` they are written once
    to the shared folder first.
    """
    close = (matched.filter(F.col("distance_m") < radius_m)
             .select("codBus", "stop_id", "timestamp", "event_s"))
    if staged:
        close = stage(close, "close")
    close = close.withColumn("segment", segment_of(F.col("event_s"), segment_s))
    inside = Window.partitionBy("codBus", "stop_id", "segment").orderBy("event_s")
    along = Window.partitionBy("codBus", "stop_id").orderBy("segment")
    keys = ["codBus", "stop_id", "segment"]
    entered = (close.groupBy(*keys).agg(F.max("event_s").alias("_last"))
               .select(*keys, F.lag("_last").over(along).alias("_entry")))
    before = F.coalesce(F.lag("event_s").over(inside), F.col("_entry"))
    return (close.join(entered, keys).withColumn("_before", before)
            .filter(F.col("_before").isNull() | (F.col("event_s") - F.col("_before") > gap_s))
            .select("codBus", "stop_id", F.col("timestamp").alias("actual_time")))


def back_project(advanced: DataFrame, geometry: DataFrame) -> DataFrame:
    """Add the passed stop and ``arrival_s``: when the bus was there at its present speed."""
    passed = geometry.select(
        *ways(geometry), F.col("stop_sequence").alias("passed_sequence"),
        F.col("stop_id").alias("passed_stop_id"), F.col("stop_lat").alias("passed_lat"),
        F.col("stop_lon").alias("passed_lon"))
    found = join_dimension(advanced, passed, [*ways(geometry), "passed_sequence"],
                           salt_on=["codBus", "event_s"])
    metres = geodistance_m("lat", "lon", "passed_lat", "passed_lon")
    return found.withColumn(
        "arrival_s", F.col("event_s") - eta_seconds(metres, F.col("speed_mps"))
    ).drop("passed_lat", "passed_lon")


def actual_delay(projected: DataFrame, schedule: DataFrame, *, strict: bool = False,
                 **asof_options) -> DataFrame:
    """Add ``actual_delay`` of each arrival against the nearest scheduled time.

    Without a scheduled time it is 0, or null when ``strict``.
    """
    by = ["stop_id", *ways(schedule)]
    owned = nearest_intervals(schedule, by, **asof_options)
    matched = match_schedule(
        projected, owned.withColumnRenamed("scheduled_s", "_due_s"),
        {**{c: c for c in by}, "stop_id": "passed_stop_id"},
        second_of_day_sql("arrival_s"))
    late = F.expr(f"arrival_s - ({day_start_sql('arrival_s')} + _due_s)")
    if not strict:
        late = F.coalesce(late, F.lit(0.0))
    return matched.withColumn("actual_delay", late).drop("_due_s")


def score_arrivals(df: DataFrame, predictions: dict[str, str], *,
                   age_s: int = PREDICTION_AGE_S, segment_s: int = SEGMENT_S) -> DataFrame:
    """Mean absolute error of the predictions made since the previous arrival.

    ``predictions`` maps a prediction column to the error column to add; the error is
    null without an arrival or a prediction to score. A ping belongs to the next arrival
    of its bus and to no other, so the errors are a plain aggregate. Predictions of
    ``age_s`` seconds or more are out, so the next arrival that counts is in the ping's
    segment or the first one of the segment after it.
    """
    segment_s = max(segment_s, age_s)
    cut = segment_of(F.col("event_s"), segment_s)
    arrival = F.when(F.col("passed_sequence").isNotNull(),
                     F.struct(F.col("event_s").alias("at"), "actual_delay"))
    pings = df.select("codBus", "event_s", *predictions, cut.alias("_segment"),
                      arrival.alias("_arrival"))
    ahead = Window.partitionBy("codBus", "_segment").orderBy("event_s").rowsBetween(
        1, Window.unboundedFollowing)
    opening = (pings.groupBy("codBus", (F.col("_segment") - 1).alias("_segment"))
               .agg(F.min("_arrival").alias("_opening")).filter("_opening IS NOT NULL"))
    aimed = (pings.withColumn("_next", F.first("_arrival", ignorenulls=True).over(ahead))
             .join(opening, ["codBus", "_segment"], "left")
             .withColumn("_next", F.coalesce("_next", "_opening"))
             .filter(F.col("_next.at") - F.col("event_s") < age_s))
    errors = aimed.groupBy("codBus", F.col("_next.at").alias("event_s")).agg(
        *[F.avg(F.abs(F.col(made) - F.col("_next.actual_delay"))).alias(error)
          for made, error in predictions.items()])
    scored = df.drop(*predictions.values()).join(errors, ["codBus", "event_s"], "left")
    for error in predictions.values():
        scored = scored.withColumn(error, F.when(F.col("passed_stop_id").isNotNull(),
                                                 F.col(error)))
    return scored


def mean_absolute_error(predictions, actual):
    """Mean of abs(prediction - actual) over an array, null when there is none."""
    misses = F.filter(F.transform(predictions, lambda p: F.abs(p - actual)),
                      lambda e: e.isNotNull())
    total = F.aggregate(misses, F.lit(0.0), lambda a, e: a + e)
    return F.when(F.size(misses) > 0, total / F.size(misses))
