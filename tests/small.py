"""Small hand-made inputs."""

from pyspark.sql import functions as F

from stopwise.operators.clean import clean_pings
from stopwise.functions.times import service_seconds
from stopwise.schemas import PING_CSV

STOPS = ("direction_id int, stop_sequence int, stop_id string, stop_name string, "
         "stop_lat double, stop_lon double")


def pings(spark, rows):
    """Cleaned pings from (bus, time, lat, lon) or (bus, time, lat, lon, sentido)."""
    full = [(r[0], "11.0", r[4] if len(r) > 4 else "1", str(r[2]), str(r[3]), "1", r[1])
            for r in rows]
    return clean_pings(spark.createDataFrame(full, PING_CSV), "11")


def line(spark, n=6, direction=0, step=0.003):
    """Stops A1..An going north, about 333 m apart."""
    rows = [(direction, i, f"A{i}", f"Stop {i}", 36.70 + step * (i - 1), -4.45)
            for i in range(1, n + 1)]
    return spark.createDataFrame(rows, STOPS)


def schedule(spark, rows):
    """Schedule rows from (stop_id, direction_id, arrival_time)."""
    df = spark.createDataFrame(rows, "stop_id string, direction_id int, arrival_time string")
    return df.withColumn("service_s", service_seconds("arrival_time"))


def lat(stop, offset=0.0):
    return round(36.70 + 0.003 * (stop - 1) + offset, 6)


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


def at(clock, day="2024-01-03"):
    return f"{day} {clock}"


def one(df, column):
    found = df.select(F.col(column)).collect()
    assert len(found) == 1
    return found[0][0]
