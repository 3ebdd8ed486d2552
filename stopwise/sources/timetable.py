"""Published timetable tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import schemas


@dataclass(frozen=True)
class Timetable:
    stops: DataFrame
    trips: DataFrame
    stop_times: DataFrame
    calendar_dates: DataFrame | None = None


#: Columns that a published timetable may lack. Fixed values.
OPTIONAL = ("stop_code", "trip_headsign")


def _read(spark: SparkSession, path: str, schema) -> DataFrame:
    """Pick the wanted columns by header name: published files carry more, in any order,
    and some pad their names with blanks. A required column that is missing is an error."""
    raw = spark.read.option("header", True).csv(path)
    header = raw.toDF(*[c.strip().lstrip("\ufeff") for c in raw.columns])
    missing = [f.name for f in schema.fields
               if f.name not in header.columns and f.name not in OPTIONAL]
    if missing:
        raise ValueError(f"{path} lacks the columns {', '.join(missing)}")
    return header.select(*[header[f.name].try_cast(f.dataType).alias(f.name)
                           if f.name in header.columns
                           else F.lit(None).cast(f.dataType).alias(f.name)
                           for f in schema.fields])


def _calendar(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return _read(spark, path, schemas.CALENDAR_DATES)
    except Exception as missing:
        if "PATH_NOT_FOUND" in str(missing):
            return None
        raise


def read_timetable(spark: SparkSession, folder: str, ext: str = "csv",
                   with_calendar: bool = True) -> Timetable:
    """The tables of a folder. Without a calendar file every trip counts as running."""
    folder = folder.rstrip("/")
    return Timetable(
        stops=_read(spark, f"{folder}/stops.{ext}", schemas.STOPS),
        trips=_read(spark, f"{folder}/trips.{ext}", schemas.TRIPS),
        stop_times=_read(spark, f"{folder}/stop_times.{ext}", schemas.STOP_TIMES),
        calendar_dates=(_calendar(spark, f"{folder}/calendar_dates.{ext}")
                        if with_calendar else None),
    )
