"""Where a vehicle is on its route."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.geo import GEODISTANCE
from ..settings import ARRIVAL_RADIUS_M
from .joins import join_dimension
from .nearest import nearest_stop
from .timetable import stop_neighbours, ways, with_direction_fallback


def route_position(pings: DataFrame, stops: DataFrame, *,
                   radius_m: float = ARRIVAL_RADIUS_M) -> DataFrame:
    """Current stop, next stop and distance.

    Within the radius the nearest stop is the current one and the distance is to it.
    Farther out the bus is between two stops and the distance is to the next one.
    """
    stops = with_direction_fallback(stops)
    near = nearest_stop(pings, stops, metric=GEODISTANCE, by=ways(stops))
    near = join_dimension(near, stop_neighbours(stops), [*ways(stops), "stop_sequence"],
                          salt_on=["codBus", "event_s"])

    def pick(at_stop, on_the_way, otherwise, name):
        return (f"CASE WHEN distance_m <= {radius_m} THEN {at_stop} "
                f"WHEN toward_stop_id IS NOT NULL THEN {on_the_way} ELSE {otherwise} END "
                f"AS {name}")

    to_next = GEODISTANCE.distance("lat", "lon", "toward_lat", "toward_lon")
    return near.selectExpr(
        *pings.columns,
        pick("stop_id", "before_stop_id", "stop_id", "current_stop_id"),
        pick("stop_name", "before_stop_name", "stop_name", "current_stop_name"),
        pick("stop_sequence", "before_sequence", "stop_sequence", "stop_sequence"),
        pick("after_stop_id", "toward_stop_id", "NULL", "next_stop_id"),
        pick("after_stop_name", "toward_stop_name", "NULL", "next_stop_name"),
        pick("distance_m", to_next, "distance_m", "distance_m"),
    )
