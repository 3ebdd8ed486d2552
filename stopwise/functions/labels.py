"""Direction, delay and display rules."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..settings import DELAYED_S, EARLY_S, MIN_SPEED_MPS, ON_TIME_S

# Raw direction codes that mean outbound.
OUTBOUND_CODES = ("1", "1.0", "Ida")


def direction_id(sentido: Column) -> Column:
    """0 for outbound codes, 1 for anything else, null included."""
    return F.when(sentido.isin(*OUTBOUND_CODES), 0).otherwise(1)


def direction_label(headsign: Column, direction: Column) -> Column:
    way = F.when(direction == 0, " (Outbound)").otherwise(" (Inbound)")
    return F.concat(F.coalesce(headsign, F.lit("Unknown")), way)


def eta_seconds(distance_m: Column, speed_mps: Column) -> Column:
    return distance_m / F.greatest(speed_mps, F.lit(MIN_SPEED_MPS))


def delay_status(delay_s: Column) -> Column:
    return (F.when(delay_s < EARLY_S, "Early")
             .when(delay_s <= ON_TIME_S, "On Time")
             .when(delay_s <= DELAYED_S, "Delayed")
             .when(delay_s.isNotNull(), "Very Late"))


def delay_status_3way(delay_s: Column) -> Column:
    """Coarser scale of the plain map: early, on time, late."""
    return (F.when(delay_s < EARLY_S, "Early")
             .when(delay_s > ON_TIME_S, "Late")
             .when(delay_s.isNotNull(), "On Time"))


def display_delay(mode: str, heuristic: Column, ml: Column) -> Column:
    """Delay shown to riders. A bus without a model prediction shows the heuristic."""
    if mode not in ("heuristic", "machine_learning"):
        raise ValueError(f"unknown prediction mode {mode!r}")
    return F.coalesce(ml, heuristic) if mode == "machine_learning" else heuristic
