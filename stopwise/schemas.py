"""Explicit schemas for every input and output table.

Times of day stay strings on disk: a timetable may hold hours past 23, and type
inference would turn shorter columns into timestamps of the current date.
"""

from pyspark.sql import types as T

PING_CSV = T.StructType([
    T.StructField("codBus", T.StringType()),
    T.StructField("codLinea", T.StringType()),
    T.StructField("sentido", T.StringType()),
    T.StructField("lat", T.StringType()),
    T.StructField("lon", T.StringType()),
    T.StructField("codParIni", T.StringType()),
    T.StructField("last_update", T.StringType()),
])

PING_JSON = T.StructType([
    T.StructField("codBus", T.StringType()),
    T.StructField("codLinea", T.StringType()),
    T.StructField("sentido", T.StringType()),
    T.StructField("lat", T.StringType()),
    T.StructField("lon", T.StringType()),
    T.StructField("last_update", T.StringType()),
    T.StructField("ingest_time", T.StringType()),
])

STOPS = T.StructType([
    T.StructField("stop_id", T.StringType()),
    T.StructField("stop_code", T.StringType()),
    T.StructField("stop_name", T.StringType()),
    T.StructField("stop_lat", T.DoubleType()),
    T.StructField("stop_lon", T.DoubleType()),
])

TRIPS = T.StructType([
    T.StructField("trip_id", T.StringType()),
    T.StructField("route_id", T.StringType()),
    T.StructField("service_id", T.StringType()),
    T.StructField("direction_id", T.IntegerType()),
    T.StructField("trip_headsign", T.StringType()),
])

STOP_TIMES = T.StructType([
    T.StructField("trip_id", T.StringType()),
    T.StructField("stop_id", T.StringType()),
    T.StructField("stop_sequence", T.IntegerType()),
    T.StructField("arrival_time", T.StringType()),
])

CALENDAR_DATES = T.StructType([
    T.StructField("service_id", T.StringType()),
    T.StructField("date", T.StringType()),
    T.StructField("exception_type", T.IntegerType()),
])

TRAINING = T.StructType([
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
    T.StructField("stop_id", T.StringType()),
    T.StructField("stop_sequence", T.IntegerType()),
    T.StructField("distance_m", T.DoubleType()),
    T.StructField("scheduled_time", T.TimestampType()),
    T.StructField("actual_time", T.TimestampType()),
    T.StructField("seconds_to_scheduled", T.LongType()),
    T.StructField("true_delay_seconds", T.LongType()),
])

LIVE_STATUS = T.StructType([
    T.StructField("codBus", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
    T.StructField("direction_id", T.IntegerType()),
    T.StructField("current_stop_id", T.StringType()),
    T.StructField("current_stop_name", T.StringType()),
    T.StructField("stop_sequence", T.IntegerType()),
    T.StructField("next_stop_id", T.StringType()),
    T.StructField("next_stop_name", T.StringType()),
    T.StructField("distance_m", T.DoubleType()),
    T.StructField("next_scheduled_time", T.TimestampType()),
])

VEHICLE_OUTPUT = (
    "bus_id", "lat", "lon", "next_stop_name", "next_stop_lat", "next_stop_lon",
    "seconds_to_scheduled", "scheduled_time", "predicted_delay_math",
    "is_arrival_event", "actual_delay", "final_math_error", "direction_id",
    "last_update", "stop_sequence", "distance_m", "hour", "minute", "weekday",
    "time_of_day",
)

# The feature order every trained model expects.
FEATURES = (
    "lat", "lon", "stop_sequence", "distance_m", "hour", "minute", "weekday",
    "time_of_day", "seconds_to_scheduled",
)
