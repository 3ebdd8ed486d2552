"""Timetable assembly: active trips, stop times, route geometry, lookups.

A schedule of one line is keyed by direction, a schedule of the network by route and direction.
Every operator takes the key from the columns it is given, see ``ways``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.times import service_seconds
from ..settings import DAY_S
from ..sources.timetable import Timetable
from .joins import hold, join_dimension


def ways(df: DataFrame) -> list[str]:
    """The columns that tell one way of the network from another: direction, and route if known."""
    return [c for c in ("route_id", "direction_id") if c in df.columns]


def with_route(pings: DataFrame, routes: DataFrame | None = None) -> DataFrame:
    """Add the ``route_id`` of each ping's line: the line itself, or what ``routes`` call so.

    ``routes`` has route_id and route_short_name. A line it lacks has a null route, and its
    pings meet no stop.
    """
    if routes is None:
        return pings.withColumn("route_id", F.col("codLinea"))
    named = routes.groupBy("route_short_name").agg(F.min("route_id").alias("route_id"))
    return join_dimension(pings, named, {"route_short_name": "codLinea"}, salt_on=["codBus", "event_s"])


def active_services(calendar_dates: DataFrame, date: str) -> DataFrame:
    """Services added on a ``yyyyMMdd`` date."""
    return (calendar_dates
            .filter((F.col("date") == date) & (F.col("exception_type") == 1))
            .select("service_id").distinct())


def active_trips(trips: DataFrame, calendar_dates: DataFrame, date: str) -> DataFrame:
    """Trips of the services active on a date; every trip when no service is active."""
    active = active_services(calendar_dates, date)
    marked = join_dimension(trips, active.withColumn("_runs", F.lit(True)), ["service_id"],
                            salt_on=["trip_id"])
    return marked.filter(F.col("_runs") | ~active.exists()).drop("_runs")


def line_trips(trips: DataFrame, line: str | None) -> DataFrame:
    return trips if line is None else trips.filter(F.col("route_id") == line)


def schedule_master(timetable: Timetable, line: str, date: str | None = None, *,
                    keep_stopless: bool = False) -> DataFrame:
    """Stop times of one line's trips with trip and stop attributes and ``service_s``.

    ``keep_stopless`` keeps stop times whose stop the timetable does not describe, with
    null attributes.
    """
    if line is None:
        raise ValueError("a schedule is of one line; network_schedule has those of all lines")
    return _schedule(timetable, line_trips(timetable.trips, line), [], date, keep_stopless)


def network_schedule(timetable: Timetable, date: str | None = None, *,
                     keep_stopless: bool = False) -> DataFrame:
    """The schedules of all lines in one, with ``route_id``, which joins every key."""
    return _schedule(timetable, timetable.trips, ["route_id"], date, keep_stopless)


def _schedule(timetable: Timetable, trips: DataFrame, route: list[str], date: str | None,
              keep_stopless: bool) -> DataFrame:
    """Trips and stop times both grow with the timetable and meet on trip_id, which a
    trip repeats once per stop. A task looks its stop times up among its trips, of which it
    has one row each, instead of sorting both. Stops join as a measured dimension."""
    if date is not None and timetable.calendar_dates is not None:
        trips = active_trips(trips, timetable.calendar_dates, date)
    times = timetable.stop_times.join(
        trips.select("trip_id", *route, "direction_id", "trip_headsign").hint("shuffle_hash"), "trip_id"
    ).withColumn("service_s", service_seconds("arrival_time"))
    return join_dimension(times, timetable.stops, ["stop_id"],
                          "left" if keep_stopless else "inner", salt_on=["trip_id"])


def schedule_distinct(schedule: DataFrame) -> DataFrame:
    """One row per stop, way and time."""
    return (schedule.groupBy("stop_id", *ways(schedule), "arrival_time")
            .agg(F.min("stop_sequence").alias("stop_sequence")))


def schedule_valid(schedule: DataFrame) -> DataFrame:
    """Rows whose hour is 0..23."""
    return schedule.filter(F.col("service_s") < DAY_S)


def schedule_times(schedule: DataFrame) -> DataFrame:
    """Times per stop and way, with the number of trips sharing each time.

    The count keeps repeated times without a list that grows with the trips.
    """
    return (schedule.groupBy("stop_id", *ways(schedule), "arrival_time")
            .agg(F.count("*").alias("n_trips")))


def schedule_arrays(schedule: DataFrame) -> DataFrame:
    """Sorted times per stop and way as one array of (arrival_time, n_trips).

    Its length is bounded by the distinct times of a service day.
    """
    return (schedule_times(schedule).groupBy("stop_id", *ways(schedule))
            .agg(F.array_sort(F.collect_list(F.struct("arrival_time", "n_trips")))
                 .alias("times")))


def route_geometry(schedule: DataFrame) -> DataFrame:
    """One canonical stop per way and sequence: that of the lowest trip_id text."""
    w = Window.partitionBy(*ways(schedule), "stop_sequence").orderBy("trip_id", "stop_id")
    return (schedule.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1")
            .select(*ways(schedule), "stop_sequence", "stop_id", "stop_code", "stop_name",
                    "stop_lat", "stop_lon"))


def route_stops(schedule: DataFrame) -> DataFrame:
    """Distinct stops with their sequence, per way."""
    return schedule.select(*ways(schedule), "stop_id", "stop_name", "stop_lat", "stop_lon",
                           "stop_sequence").distinct()


def with_direction_fallback(stops: DataFrame) -> DataFrame:
    """Give a direction that has no stops the stops of its route's other one."""
    stops = hold(stops)
    have = stops.select(*ways(stops)).distinct()
    flipped = (stops.withColumn("direction_id", 1 - F.col("direction_id"))
               .join(have, ways(stops), "left_anti"))
    return stops.unionByName(flipped)


def headsigns(trips: DataFrame, by: tuple[str, ...] = ("direction_id",)) -> DataFrame:
    """Destination per direction, or per whatever ``by`` names: at most one row each."""
    return trips.groupBy(*by).agg(F.min("trip_headsign").alias("trip_headsign"))


def trip_patterns(schedule: DataFrame) -> DataFrame:
    """The different runs of stops that the trips of a way make, with how many trips make each.

    A pattern is known by a digest of its ordered stops. ``canonical`` marks the way's most
    used one; of equally used ones that of the lowest digest.
    """
    by = ways(schedule)
    stops = F.array_sort(F.collect_list(F.struct("stop_sequence", "stop_id")))
    runs = schedule.groupBy(*by, "trip_id").agg(stops.alias("stops")).select(
        *by, "trip_id", F.size("stops").alias("n_stops"),
        F.md5(F.array_join(F.transform("stops", lambda s: F.concat(
            s["stop_sequence"].cast("string"), F.lit(":"), s["stop_id"])), ",")).alias("pattern"))
    used = runs.groupBy(*by, "pattern").agg(
        F.count("*").alias("n_trips"), F.min("n_stops").alias("n_stops"),
        F.min("trip_id").alias("first_trip"))
    w = Window.partitionBy(*by).orderBy(F.desc("n_trips"), "pattern")
    return used.withColumn("canonical", F.row_number().over(w) == 1)


def line_stop_names(schedule: DataFrame) -> DataFrame:
    by = ways(schedule)
    return schedule.select(*by, "stop_name").distinct().orderBy(*by, "stop_name")


def stop_timetable(schedule: DataFrame, name_part: str) -> DataFrame:
    """Per way: destination, number of departures and distinct times of the stops
    whose name contains a text, in any case."""
    hits = schedule.filter(F.contains(F.lower("stop_name"), F.lit(name_part.lower())))
    by = ways(schedule)
    per_time = (hits.groupBy(*by, "arrival_time", "trip_headsign")
                .agg(F.count("*").alias("n")))
    first = F.min(F.struct("arrival_time", "trip_headsign"))
    return per_time.groupBy(*by).agg(
        first["trip_headsign"].alias("trip_headsign"),
        F.sum("n").alias("n_trips"),
        F.array_sort(F.collect_set("arrival_time")).alias("times"),
    )


def stop_neighbours(stops: DataFrame) -> DataFrame:
    """Neighbours of each sequence on the route, per way.

    ``after_*`` is the first stop with a larger sequence. ``before_*``/``toward_*`` is
    the first consecutive pair of the route that encloses the sequence. Stops that
    share a sequence are ordered by stop_id.
    """
    stop = F.struct("stop_sequence", "stop_id", "stop_name", "stop_lat", "stop_lon")
    by = ways(stops)
    groups = (stops.groupBy(*by, "stop_sequence")
              .agg(F.array_sort(F.collect_set(stop)).alias("here")))
    w = Window.partitionBy(*by).orderBy("stop_sequence")
    first, second = F.col("here")[0], F.get("here", F.lit(1))
    placed = groups.select(
        *by, "stop_sequence", first.alias("first"), second.alias("second"),
        F.lag(F.element_at("here", -1)).over(w).alias("previous"),
        F.lead(first).over(w).alias("after"),
    )
    is_start = F.col("previous").isNull()
    pair = placed.select(
        *by, "stop_sequence", "previous", "after",
        F.when(is_start, F.col("first")).otherwise(F.col("previous")).alias("before"),
        F.when(is_start, F.coalesce("second", "after")).otherwise(F.col("first"))
         .alias("toward"),
    )
    return pair.select(
        *by, "stop_sequence",
        F.col("previous.stop_id").alias("previous_stop_id"),
        F.col("after.stop_id").alias("after_stop_id"),
        F.col("after.stop_name").alias("after_stop_name"),
        F.col("before.stop_sequence").alias("before_sequence"),
        F.col("before.stop_id").alias("before_stop_id"),
        F.col("before.stop_name").alias("before_stop_name"),
        F.col("toward.stop_id").alias("toward_stop_id"),
        F.col("toward.stop_name").alias("toward_stop_name"),
        F.col("toward.stop_lat").alias("toward_lat"),
        F.col("toward.stop_lon").alias("toward_lon"),
    )
