"""Nearest stop without all pairs.

Stops are filed under the grid cells around them, at a few cell sizes. A ping looks up
its own cell, which lists every stop in the 3 x 3 block around it, and keeps the
closest. The answer is final when that distance is within what the block is sure to
cover; otherwise the next coarser grid is asked, and in the end a quadtree of the stops.
The lookups are joins on the cell, so pings are never multiplied nor shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.geo import HAVERSINE, MIN_DEGREE_M, Metric
from ..settings import BROADCAST_ROWS, GRID_LEVELS, SALTS
from .joins import Dimension, hold, join_dimension
from .stop_tree import STOP as _STOP, TREE_STOPS, far_stop

_FOUND = ("struct<line:double,stop_sequence:int,stop_id:string,stop_name:string,"
          "stop_lat:double,stop_lon:double>")


def _cell(lat: str, lon: str, level: int, dy: int = 0, dx: int = 0) -> tuple[str, str]:
    """Grid row and column of a position; columns wrap around the globe."""
    size = 360.0 / 2 ** level
    y = f"CAST(floor(({lat} + 90D) / {size!r}D) AS int) + {dy}"
    x = f"pmod(CAST(floor(({lon} + 180D) / {size!r}D) AS int) + {dx}, {2 ** level})"
    return y, x


def _sure_metres(lat: str, level: int) -> str:
    """Radius around a ping that its 3 x 3 block covers for certain."""
    size = 360.0 / 2 ** level
    return f"{size * MIN_DEGREE_M!r}D * cos(radians(least(abs({lat}) + {size!r}D, 90D)))"


def grid_stops(stops: DataFrame, by: list[str], levels: tuple[int, ...],
               metric: Metric = HAVERSINE) -> DataFrame:
    """One row per grid cell with the stops of its 3 x 3 block."""
    cells = []
    for level in levels:
        for dy in (-1, 0, 1):
            for dx in (-1, 0, 1):
                y, x = _cell("stop_lat", "stop_lon", level, dy, dx)
                cells.append(f"struct({level} AS level, {y} AS cell_y, {x} AS cell_x)")
    place = [f"{sql} AS {axis}" for axis, sql in
             zip("xyz", metric.place("stop_lat", "stop_lon"))]
    return (stops.selectExpr(*by, f"struct({', '.join(_STOP)}, {', '.join(place)}) AS stop",
                             f"inline(array({', '.join(cells)}))")
            .groupBy("level", *by, "cell_y", "cell_x")
            .agg(F.collect_set("stop").alias("near_stops")))


def nearest_stop(
    pings: DataFrame,
    stops: DataFrame,
    *,
    metric: Metric = HAVERSINE,
    by: list[str] | None = None,
    levels: tuple[int, ...] = GRID_LEVELS,
    max_rows: int = BROADCAST_ROWS,
    salts: int = SALTS,
    tree_stops: int = TREE_STOPS,
) -> DataFrame:
    """Add the nearest stop and ``distance_m`` to each ping.

    ``by`` names columns both sides must share, such as ``direction_id``. Ties go to the
    lower sequence, then the lower stop_id. A ping without a position, or whose ``by`` no stop
    shares, is left out. Works on a stream: no shuffle, no window.
    Candidates are ranked by straight lines in space, which takes no trigonometry per
    candidate; the distance itself is computed once, for the stop found. The tree and the cells
    are made from stops that are held, since a timetable may have to be read for them.
    """
    by, kept = by or [], pings.columns
    stops = hold(stops.select(*by, *_STOP))
    far = far_stop(stops, by, metric, tree_stops, max_rows=max_rows, salts=salts)
    cells = Dimension(grid_stops(stops, by, levels, metric),
                      "size(near_stops)") if levels else None
    line = "(s.x - _x) * (s.x - _x) + (s.y - _y) * (s.y - _y) + (s.z - _z) * (s.z - _z)"
    best = (f"array_min(transform(near_stops, s -> struct({line} AS line, "
            f"{', '.join(f's.{c} AS {c}' for c in _STOP)})))")
    spot = [f"{sql} AS _{axis}" for axis, sql in zip("xyz", metric.place("lat", "lon"))]
    away = metric.distance("lat", "lon", "_near.stop_lat", "_near.stop_lon")
    found = pings.selectExpr("*", *spot, f"CAST(NULL AS {_FOUND}) AS _near", "false AS _done")
    for level in levels:
        y, x = _cell("lat", "lon", level)
        keys = {"level": f"CASE WHEN NOT _done THEN {level} END", "cell_y": y, "cell_x": x,
                **{c: c for c in by}}
        found = join_dimension(found, cells, keys, salt_on=["codBus", "event_s"],
                               max_rows=max_rows, salts=salts)
        found = found.selectExpr(*kept, "_x", "_y", "_z", "_done",
                                 f"coalesce({best}, _near) AS _near")
        sure = f"coalesce({away} <= {_sure_metres('lat', level)}, false)"
        found = found.selectExpr(*kept, "_x", "_y", "_z", "_near", f"{sure} AS _done")
    found = far(found, "NOT _done", "_far").selectExpr(
        *kept, "CASE WHEN _done THEN "
        f"struct({', '.join(f'_near.{c} AS {c}' for c in _STOP)}) ELSE _far END AS _near")
    return (found.filter("_near IS NOT NULL")
            .selectExpr(*kept, *[f"_near.{c} AS {c}" for c in _STOP], f"{away} AS distance_m"))


def match_snapshots(pings: DataFrame, stops: DataFrame, **options) -> DataFrame:
    """Nearest stop per bus and timestamp; of repeated pings the closest match is kept."""
    matched = nearest_stop(pings, stops, **options)
    w = Window.partitionBy("codBus", "timestamp").orderBy(
        "distance_m", "stop_sequence", "stop_id", "lat", "lon")
    return matched.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")
