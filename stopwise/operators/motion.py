"""Speed and stop advance of each vehicle from its history.

Input pings hold one row per bus and second, so a segment of ``segment_s`` seconds is
at most that many rows, whatever share of all pings one bus has.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.geo import GEODISTANCE
from ..functions.labels import eta_seconds
from ..settings import DEFAULT_SPEED_MPS, MIN_MOVE_M, SEGMENT_S
from .sequences import segment_of

_HERE = ("event_s", "lat", "lon", "stop_sequence", "direction_id")


def _with_step(df: DataFrame, name: str, here: str, before: str, min_move_m: float) -> DataFrame:
    """Add the speed since the previous ping, null when the bus has not clearly moved."""
    metres = GEODISTANCE.distance(f"{before}.lat", f"{before}.lon", f"{here}lat", f"{here}lon")
    seconds = f"({here}event_s - {before}.event_s)"
    return (df.selectExpr("*", f"{metres} AS _metres")
            .selectExpr("*", f"CASE WHEN {seconds} > 0 AND _metres > {min_move_m} "
                             f"THEN _metres / {seconds} END AS {name}")
            .drop("_metres"))


def link_pings(
    pings: DataFrame,
    *,
    default_speed: float = DEFAULT_SPEED_MPS,
    min_move_m: float = MIN_MOVE_M,
    segment_s: int = SEGMENT_S,
) -> DataFrame:
    """Add the previous ping (``before``) and ``speed_mps`` carried forward.

    One summary per segment (first and last ping, last speed) is enough to resolve both
    across the cuts.
    """
    for missing in (c for c in _HERE if c not in pings.columns):
        pings = pings.withColumn(missing, F.lit(None).cast("int"))
    inside = Window.partitionBy("codBus", "segment").orderBy("event_s")
    known = [*_HERE, *(c for c in ("route_id",) if c in pings.columns)]
    here = F.struct(*known)
    local = (pings.withColumn("segment", segment_of(F.col("event_s"), segment_s))
             .withColumn("_before", F.lag(here).over(inside)))
    summary = (_with_step(local.select("codBus", "segment", *known, "_before"), "_step", "",
                          "_before", min_move_m)
               .groupBy("codBus", "segment").agg(
        F.min_by(here, "event_s").alias("_first"),
        F.max_by(here, "event_s").alias("_last"),
        F.max_by("_step", F.expr("if(_step IS NULL, NULL, event_s)")).alias("_step")))
    along = Window.partitionBy("codBus").orderBy("segment")
    entered = _with_step(summary.withColumn("_entry", F.lag("_last").over(along)),
                         "_entry_step", "_first.", "_entry", min_move_m)
    carried = entered.select(
        "codBus", "segment", "_entry",
        F.last(F.coalesce("_step", "_entry_step"), ignorenulls=True)
        .over(along.rowsBetween(Window.unboundedPreceding, -1)).alias("_entry_speed"))
    linked = (local.join(carried, ["codBus", "segment"])
              .withColumn("before", F.coalesce("_before", "_entry")))
    linked = _with_step(linked, "_step", "", "before", min_move_m)
    running = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (linked
            .withColumn("speed_mps", F.coalesce(F.last("_step", ignorenulls=True).over(running),
                                                F.col("_entry_speed"), F.lit(default_speed)))
            .drop("_before", "_entry", "_entry_speed", "_step", "segment"))


def _compose(maps) -> Column:
    """One affine map ``speed * keep + gain`` from an array of them, the first one first."""
    return F.aggregate(
        maps, F.struct(F.lit(1.0).alias("keep"), F.lit(0.0).alias("gain")),
        lambda a, m: F.struct((a["keep"] * m["keep"]).alias("keep"),
                              (a["gain"] * m["keep"] + m["gain"]).alias("gain")))


def _entry_speeds(maps: DataFrame, default_speed: float, block: int) -> DataFrame:
    """The speed at which each segment is entered, after the maps of all segments before it.

    Maps are composed in blocks of ``block`` segments that have one, then over the blocks; a
    window holds a block's maps or a bus's blocks, however small the weight of a step.
    """
    along = Window.partitionBy("codBus").orderBy("segment")
    placed = maps.withColumn("_block", F.floor((F.row_number().over(along) - 1) / block))
    inside = Window.partitionBy("codBus", "_block").orderBy("segment").rowsBetween(
        Window.unboundedPreceding, -1)
    within = placed.withColumn("_before", _compose(F.collect_list("_map").over(inside)))
    whole = placed.groupBy("codBus", "_block").agg(_compose(F.transform(
        F.array_sort(F.collect_list(F.struct("segment", "_map"))), lambda m: m["_map"])).alias("_map"))
    over = Window.partitionBy("codBus").orderBy("_block").rowsBetween(
        Window.unboundedPreceding, -1)
    opened = whole.select("codBus", "_block", F.aggregate(
        F.collect_list("_map").over(over), F.lit(float(default_speed)),
        lambda speed, m: speed * m["keep"] + m["gain"]).alias("_opened"))
    return within.join(opened, ["codBus", "_block"]).select(
        "codBus", "segment",
        (F.col("_opened") * F.col("_before.keep") + F.col("_before.gain")).alias("_entry"))


def ewma_speed(
    linked: DataFrame,
    *,
    alpha: float = 0.2,
    low: float = 0.1,
    high: float = 25.0,
    default_speed: float = DEFAULT_SPEED_MPS,
    segment_s: int = 900,
    block: int = 256,
) -> DataFrame:
    """Replace ``speed_mps`` by ``alpha * step + (1 - alpha) * previous`` over plausible steps.

    Inside a segment the recurrence is a running sum of steps scaled by growing powers.
    Each segment is one affine map, and the maps are chained over one row per segment.
    """
    rest = 1.0 - alpha
    segment_s = min(segment_s, int(250 / -math.log10(rest)))
    inside = Window.partitionBy("codBus", "segment").orderBy("event_s")
    running = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = (_with_step(linked, "_step", "", "before", 0.0)
             .withColumn("segment", segment_of(F.col("event_s"), segment_s))
             .withColumn("_step", F.expr(f"if(_step > {low} AND _step < {high}, _step, NULL)"))
             .withColumn("_uses", F.count("_step").over(running))
             .withColumn("_sum", F.coalesce(F.sum(
                 F.col("_step") * alpha * F.pow(F.lit(rest), -F.col("_uses"))).over(running),
                 F.lit(0.0))))
    keep = F.pow(F.lit(rest), F.col("_uses"))
    maps = (local.groupBy("codBus", "segment")
            .agg(F.max("_uses").alias("_uses"), F.max_by("_sum", "event_s").alias("_sum"))
            .select("codBus", "segment", F.struct(
                keep.alias("keep"), (keep * F.col("_sum")).alias("gain")).alias("_map")))
    entry = _entry_speeds(maps, default_speed, block)
    return (local.join(entry, ["codBus", "segment"])
            .withColumn("speed_mps", keep * (F.col("_entry") + F.col("_sum")))
            .drop("segment", "_step", "_uses", "_sum", "_entry"))


def advance(linked: DataFrame, *, reset_on_direction: bool = False) -> DataFrame:
    """Add ``passed_sequence``: the stop left behind when the sequence went up, else null."""
    up = (F.col("stop_sequence") > F.col("before.stop_sequence")) & (
        F.col("before.stop_sequence") >= 0)
    if "route_id" in linked.columns:        # sequences of two routes do not compare
        up = up & F.col("route_id").eqNullSafe(F.col("before.route_id"))
    if reset_on_direction:
        up = up & (F.col("direction_id") == F.col("before.direction_id"))
    return linked.withColumn("passed_sequence", F.when(up, F.col("before.stop_sequence")))


def heuristic_delay(df: DataFrame) -> DataFrame:
    """Add ``seconds_to_scheduled`` and ``predicted_delay_math``.

    A ping without a scheduled time is taken to be due exactly at its estimated arrival.
    """
    eta = eta_seconds(F.col("distance_m"), F.col("speed_mps"))
    return (df.withColumn("_eta", eta)
            .selectExpr("*", "scheduled_epoch_s IS NOT NULL AS has_schedule",
                        "coalesce(CAST(scheduled_epoch_s - event_s AS double), _eta) "
                        "AS seconds_to_scheduled")
            .selectExpr("*", "_eta - seconds_to_scheduled AS predicted_delay_math")
            .drop("_eta"))
