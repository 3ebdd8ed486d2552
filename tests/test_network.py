"""All lines at once: every line's part equals that line on its own."""

import pytest
from pyspark.sql import functions as F

from stopwise.operators import board, timetable as tt
from stopwise.operators.clean import clean_pings, dedup_pings
from stopwise.operators.position import route_position
from stopwise.plans import chains, fixtures
from stopwise.session import stage
from stopwise.sources import read_ping_stream
from stopwise.streaming import finish_vehicles, follow_vehicles, read_sink, run_available
from small import at, rows

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def timetable(spark):
    return fixtures.timetable(spark, SF)


@pytest.fixture(scope="module")
def network(spark, timetable):
    return stage(tt.network_schedule(timetable), "network")


@pytest.mark.parametrize("build", [
    tt.route_geometry, tt.route_stops, tt.schedule_distinct, tt.schedule_times, tt.schedule_arrays,
    lambda s: tt.stop_neighbours(tt.route_stops(s)), tt.line_stop_names, tt.trip_patterns,
    lambda s: tt.stop_timetable(s, "nation_2"),
    lambda s: tt.with_direction_fallback(tt.route_geometry(s))])
def test_every_operator_keeps_lines_apart(spark, timetable, network, build):
    whole = build(network)
    for name in ("11", "31"):
        own = build(tt.schedule_master(timetable, name))
        part = whole.filter(F.col("route_id") == name).drop("route_id")
        assert rows(part, *sorted(part.columns)) == rows(own, *sorted(own.columns))
        assert part.count() > 0


def test_replay_and_live_status_of_each_line(spark, timetable, network):
    raw = fixtures.gps_raw(spark, SF)

    def replay(pings, schedule):
        stops = tt.route_geometry(schedule)
        return chains.vehicle_replay(chains.enrich(dedup_pings(pings), stops, schedule), stops, schedule)

    def status(pings, schedule):
        return board.live_status(board.latest_ping(pings), tt.route_stops(schedule), schedule)

    everything = tt.with_route(clean_pings(raw))
    for chain in (replay, status):
        whole = chain(everything, network)
        for name in ("11", "31"):
            own = chain(clean_pings(raw, name), tt.schedule_master(timetable, name))
            columns = [F.round(c, 6).alias(c) if t == "double" else c for c, t in own.dtypes]
            assert rows(whole.filter(F.col("route_id") == name), *columns) == rows(own, *columns)


def test_routes_by_name_and_unknown_lines(spark, network):
    pings = spark.createDataFrame(
        [("1", "A", 0, 36.7, -4.45), ("2", "Z", 0, 36.7, -4.45), ("3", None, 0, 36.7, -4.45)],
        "codBus string, codLinea string, direction_id int, lat double, lon double").withColumn(
        "event_s", F.lit(1704265200).cast("long"))
    routes = spark.createDataFrame([("11", "A"), ("31", "B"), ("99", "A")], "route_id string, route_short_name string")
    named = tt.with_route(pings, routes)
    assert rows(named, "codBus", "route_id") == [("1", "11"), ("2", None), ("3", None)]
    placed = route_position(named, tt.route_stops(network))
    assert [r["codBus"] for r in placed.collect()] == ["1"]


def test_patterns(spark):
    given = [("t1", 1, "A"), ("t1", 2, "B"), ("t2", 1, "A"), ("t2", 2, "B"), ("t3", 1, "A"), ("t3", 2, "C"),
             ("t4", 2, "B"), ("t4", 1, "A")]
    schedule = spark.createDataFrame(given, "trip_id string, stop_sequence int, stop_id string").selectExpr(
        "*", "'11' AS route_id", "0 AS direction_id")
    got = tt.trip_patterns(schedule)
    assert rows(got, "n_trips", "n_stops", "first_trip", "canonical") == [
        (1, 2, "t3", False), (3, 2, "t1", True)]
    even = tt.trip_patterns(schedule.filter("trip_id IN ('t1', 't3')")).collect()
    assert [r["canonical"] for r in sorted(even, key=lambda r: r["pattern"])] == [True, False]


def test_a_bus_that_changes_its_route_does_not_arrive(spark, tmp_path):
    stops = spark.createDataFrame(
        [(r, 0, k, f"{r}{k}", f"stop {k}", 36.70 + 0.003 * (k - 1), -4.45) for r in ("11", "31") for k in range(1, 7)],
        "route_id string, direction_id int, stop_sequence int, stop_id string, stop_name string, "
        "stop_lat double, stop_lon double")
    schedule = spark.createDataFrame([("111", "11", 0, 25200)], "stop_id string, route_id string, direction_id int, service_s int")
    columns = ["codBus", "codLinea", "sentido", "lat", "lon", "codParIni", "last_update"]
    raw = spark.createDataFrame(
        [("1", line, "1", str(36.70 + 0.003 * (k - 1)), "-4.45", "1", at(f"07:0{n}:00"))
         for n, (line, k) in enumerate([("11", 1), ("11", 2), ("31.0", 4), ("31.0", 5), ("11", 6)])], columns)
    pings = tt.with_route(clean_pings(raw))
    tracked = chains.track(chains.enrich(pings, stops, schedule))
    want = [None, 1, None, 4, None]
    assert [r["passed_sequence"] for r in tracked.orderBy("event_s").collect()] == want
    raw.write.option("header", True).csv(f"{tmp_path}/feed")
    known = tt.with_route(clean_pings(read_ping_stream(spark, f"{tmp_path}/feed")))
    followed = follow_vehicles(chains.enrich(known, stops, schedule))
    run_available(followed, f"{tmp_path}/out", f"{tmp_path}/check", output_mode="update")
    assert [r["passed_sequence"] for r in read_sink(spark, f"{tmp_path}/out").orderBy("event_s").collect()] == want
