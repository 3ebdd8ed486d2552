"""Transit inputs as views over the test tables.

Pings come from ``events``, trips and service dates from ``orders``, stop times from
``lineitem`` and stops from ``nation``. Every formula is deterministic and works on any
scale of the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.times import two_digits
from ..operators.clean import clean_pings
from ..operators.sequences import number_within_key
from ..session import pin_time_zone
from ..settings import LINE
from ..sources.timetable import Timetable


# The columns the views use; a given schema spares a look into the file footers.
_SCHEMAS = {
    "events": "event_id bigint, user_id bigint",
    "nation": "n_nationkey int, n_name string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return (pin_time_zone(spark).read.schema(_SCHEMAS[name])
            .parquet(f"{folder}/{name}.parquet"))


def gps_raw(spark: SparkSession, folder: str) -> DataFrame:
    """Raw pings: a bus every user, a ping every 30 s, a stop every 45 s."""
    events = table(spark, folder, "events").select("event_id", "user_id")
    numbered = number_within_key(events, "user_id", "event_id", "k")
    travelled = "(CAST((k * 30 + user_id * 150) % 1125 AS double) / 45D)"
    lat = f"round(36.70D + 0.0030D * {travelled} + ((event_id * 37) % 101 - 50) * 0.000004D, 6)"
    lon = f"round(-4.45D + 0.0020D * {travelled} + ((event_id * 53) % 101 - 50) * 0.000004D, 6)"
    base = ("if(user_id % 5 = 4, timestamp '2024-01-01 23:50:00', "
            "timestamp '2024-01-01 06:00:00')")
    tick = "(k - if(event_id % 83 = 0 AND k > 0, 1, 0))"
    return numbered.selectExpr(
        "CAST(user_id AS string) AS codBus",
        "if(user_id % 5 = 3, '31.0', '11.0') AS codLinea",
        "CASE WHEN event_id % 89 = 0 THEN 'Ida' WHEN user_id % 2 = 0 THEN '1' ELSE '2' END "
        "AS sentido",
        f"if(event_id % 97 <> 0, CAST({lat} AS string), NULL) AS lat",
        f"CAST({lon} AS string) AS lon",
        "CAST(100 + user_id % 25 AS string) AS codParIni",
        f"date_format(timestamp_seconds(unix_seconds({base}) + {tick} * 30), "
        "'yyyy-MM-dd HH:mm:ss') AS last_update",
    )


def pings(spark: SparkSession, folder: str, line: str | None = LINE) -> DataFrame:
    return clean_pings(gps_raw(spark, folder), line)


def stops(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "nation").selectExpr(
        "CAST(n_nationkey AS string) AS stop_id",
        "CAST(n_nationkey + 1000 AS string) AS stop_code", "n_name AS stop_name",
        "36.70D + 0.0030D * n_nationkey AS stop_lat",
        "-4.45D + 0.0020D * n_nationkey AS stop_lon")


def _order_trips(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").selectExpr(
        "o_orderkey AS key", "if(o_custkey % 5 = 3, '31', '11') AS route_id",
        "concat('SVC_', CAST(o_custkey % 4 AS string)) AS service_id",
        "CAST(o_orderkey % 2 AS int) AS direction_id",
        "18000 + (o_orderkey * 97) % 72000 AS start_s")


def trips(spark: SparkSession, folder: str) -> DataFrame:
    return _order_trips(spark, folder).selectExpr(
        "CAST(key AS string) AS trip_id", "route_id", "service_id", "direction_id",
        "concat('Terminal ', CAST(direction_id AS string)) AS trip_headsign")


def stop_times(spark: SparkSession, folder: str) -> DataFrame:
    """One row per trip and stop. Visits are dealt out by trip once: they are grouped, get their
    start and meet their trip in a schedule as they lie, unsorted."""
    visits = (table(spark, folder, "lineitem").filter("l_orderkey IS NOT NULL")
              .selectExpr("CAST(l_orderkey AS string) AS trip_id", "l_partkey % 25 AS stop",
                          "l_suppkey % 10 AS wait_s")
              .repartition("trip_id")
              .groupBy("trip_id", "stop").agg(F.min("wait_s").alias("wait_s")))
    starts = _order_trips(spark, folder).selectExpr("CAST(key AS string) AS trip_id", "start_s")
    timed = visits.join(starts.hint("shuffle_hash"), "trip_id").selectExpr(
        "trip_id", "stop", "start_s + stop * 45 + wait_s AS s")
    clock = ", ".join(two_digits(p) for p in ("s DIV 3600", "s DIV 60 % 60", "s % 60"))
    return timed.selectExpr(
        "trip_id", "CAST(stop AS string) AS stop_id", "CAST(stop + 1 AS int) AS stop_sequence",
        f"concat_ws(':', {clock}) AS arrival_time")


def calendar_dates(spark: SparkSession, folder: str) -> DataFrame:
    """A service runs on the days of 2024 on which an order of it falls, except when its
    number plus the day of the month divides by 3."""
    return table(spark, folder, "orders").selectExpr(
        "concat('SVC_', CAST(o_custkey % 4 AS string)) AS service_id",
        "concat('2024', date_format(o_orderdate, 'MMdd')) AS date",
        "if((o_custkey % 4 + day(o_orderdate)) % 3 = 0, 2, 1) AS exception_type").distinct()


def timetable(spark: SparkSession, folder: str) -> Timetable:
    return Timetable(stops=stops(spark, folder), trips=trips(spark, folder),
                     stop_times=stop_times(spark, folder),
                     calendar_dates=calendar_dates(spark, folder))
