"""The timetable's joins and the feed that the stream queries land."""

from __future__ import annotations

from stopwise.operators import timetable as tt
from stopwise.plans import catalog
from stopwise.sources.timetable import Timetable
from stopwise.streaming.ingest import clean_stream


def test_stop_times_meet_their_trips_unsorted(spark):
    known = Timetable(
        stops=spark.createDataFrame([("s1", "1", "One", 36.7, -4.4)], "stop_id string, "
                                    "stop_code string, stop_name string, stop_lat double, stop_lon double"),
        trips=spark.createDataFrame([("t1", "11", "S", 0, "End"), ("t1", "11", "S", 1, "End"), (None, "11", "S", 0, "")],
                                    "trip_id string, route_id string, service_id string, "
                                    "direction_id int, trip_headsign string"),
        stop_times=spark.createDataFrame([("t1", "s1", 1, "06:00:00"), (None, "s1", 1, "07:00:00")],
                                         "trip_id string, stop_id string, stop_sequence int, "
                                         "arrival_time string"),
        calendar_dates=None)
    made = tt.network_schedule(known)
    assert sorted(r["direction_id"] for r in made.collect()) == [0, 1]
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan


def test_feed_is_written_once_and_its_stream_built_once(spark, monkeypatch):
    rows = [("b1", "11", "1", "-4.4", "36.7", "100", f"2024-01-01 06:{m}:00") for m in (10, 19, 20, 40)]
    read, built = [], []

    def raw(spark, folder):
        read.append(folder)
        return spark.createDataFrame(rows, ["codBus", "codLinea", "sentido", "lon", "lat",
                                            "codParIni", "last_update"])

    def build(stream):
        built.append(1)
        return clean_stream(stream, "11")

    monkeypatch.setattr(catalog.fixtures, "gps_raw", raw)
    out = catalog._run_feed(spark, "none", build)
    assert sorted(r["last_update"] for r in out.collect()) == [r[-1] for r in rows]
    assert len(read) == 1 and len(built) == 1
