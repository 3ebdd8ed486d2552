"""Files as they are published: column orders, spellings, missing columns and files."""

import pytest
from pyspark.sql import functions as F

from stopwise.functions.geo import GEODISTANCE
from stopwise.operators import timetable as tt
from stopwise.operators.clean import clean_pings
from stopwise.sources import read_ping_history, read_ping_stream, read_timetable
from stopwise.streaming import read_sink, run_available

FEED = "codBus,codLinea,sentido,lon,lat,codParIni,last_update\n"
OLDER = "codLinea,codBus, latitud,longitud ,sentido,last_update\n"


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path.parent)


@pytest.fixture
def folders(tmp_path):
    new = put(tmp_path / "new" / "a.csv",
              FEED + "7,11.0,1,-4.429719,36.71246,100,2024-01-03 07:00:00\n")
    old = put(tmp_path / "old" / "b.csv", OLDER + "11.0,8,36.7,-4.4,2,2024-01-03 07:01:00\n")
    return new, old


def test_history_by_header(spark, folders):
    got = clean_pings(read_ping_history(spark, list(folders), stamp=True), "11").orderBy("codBus")
    assert [(r["lat"], r["lon"], r["codParIni"]) for r in got.collect()] == [
        (36.71246, -4.429719, "100"), (36.7, -4.4, None)]
    assert "snapshot_time" in read_ping_history(spark, folders[0], stamp=True).columns


def test_files_of_another_order_are_not_mixed(spark, folders, tmp_path):
    put(tmp_path / "new" / "b.csv",
        FEED.replace("lon,lat", "lat,lon") + "9,11.0,1,36.7,-4.4,1,2024-01-03 07:00:00\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_ping_history(spark, folders[0]).collect()


def test_missing_columns_raise(spark, tmp_path):
    with pytest.raises(ValueError, match="last_update"):
        read_ping_history(spark, put(tmp_path / "p" / "a.csv", "codBus,codLinea,sentido,lon,lat\n"))
    folder = put(tmp_path / "t" / "stops.csv", "stop_id,stop_name,stop_lat\n")
    with pytest.raises(ValueError, match="stop_lon"):
        read_timetable(spark, folder)


def test_stream_by_header(spark, folders, tmp_path):
    run_available(clean_pings(read_ping_stream(spark, folders[1])), f"{tmp_path}/out",
                  f"{tmp_path}/check")
    assert [tuple(r) for r in read_sink(spark, f"{tmp_path}/out").select("lat", "lon").collect()] \
        == [(36.7, -4.4)]
    empty = tmp_path / "empty"
    empty.mkdir()
    assert "lat" in read_ping_stream(spark, str(empty)).columns


def test_timetable_with_padded_names_and_without_calendar(spark, tmp_path):
    put(tmp_path / "t" / "stops.csv", " stop_id, stop_name,stop_lat ,stop_lon\nA,first,36.7,-4.4\n")
    put(tmp_path / "t" / "trips.csv", "trip_id,route_id,service_id,direction_id\nT,11,S,0\n")
    folder = put(tmp_path / "t" / "stop_times.csv",
                 "trip_id,stop_id,stop_sequence,arrival_time\nT,A,1,07:00:00\nT,B,2,07:05:00\n")
    read = read_timetable(spark, folder)
    assert read.calendar_dates is None
    assert tt.schedule_master(read, "11", "20240103").count() == 1
    kept = tt.schedule_master(read, "11", keep_stopless=True).orderBy("stop_id").collect()
    assert [(r["stop_id"], r["stop_name"]) for r in kept] == [("A", "first"), ("B", None)]
    with pytest.raises(ValueError):
        tt.schedule_master(read, None)


def test_distance_across_the_date_line(spark):
    apart = GEODISTANCE.distance("0D", "179.999D", "0D", "-179.999D")
    assert abs(spark.range(1).select(F.expr(apart)).first()[0] - 222.6) < 0.1
