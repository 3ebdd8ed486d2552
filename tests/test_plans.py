"""Shapes of the physical plans, and the registered queries against their SQL."""

import contextlib
import io

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import compare, connect
from stopwise.operators import asof
from stopwise.plans import catalog, chains, fixtures

SF = "/root/testdata/sf0.001"

FAST = ("clean_pings", "dedup_pings", "ping_history", "timetable_scan", "latest_ping",
        "active_services", "active_trips", "active_trips_fallback", "schedule_master",
        "schedule_arrays", "route_geometry", "stop_timetable", "stop_neighbours", "haversine",
        "geodistance", "nearest_stop", "nearest_stop_grid", "route_position", "asof_next",
        "live_status", "training_set", "split_counts", "vehicle_replay", "board",
        "stream_dedup")


def plan(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", FAST)
def test_query_equals_sql(spark, con, name):
    assert compare(queries()[name](spark, SF), con, oracle_sql()[name]) is None


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", ["nearest_stop", "nearest_stop_grid", "asof_nearest",
                                  "vehicle_replay", "training_set", "live_status",
                                  "active_trips"])
def test_no_all_pairs_and_no_python(spark, name):
    text = plan(queries()[name](spark, SF))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "EvalPython",
                 "InPandas"):
        assert word not in text


def test_nearest_stop_does_not_shuffle_pings(spark):
    """Exchanges remain in the fixture (by user) and in the cached stop grid (by cell)."""
    stops = fixtures.stops(spark, SF).selectExpr("*", "1 AS stop_sequence")
    text = plan(catalog.nearest.nearest_stop(fixtures.pings(spark, SF), stops))
    keys = [line for line in text.splitlines() if "hashpartitioning(" in line]
    assert keys
    assert all("user_id" in k or "hashpartitioning(level" in k for k in keys)


def test_large_dimension_is_not_broadcast(spark):
    schedule = catalog._line(spark, SF)
    facts = spark.createDataFrame([("1", "1", 0, 3)], "codBus string, stop_id string, "
                                                      "direction_id int, event_s long")
    by = ["stop_id", "direction_id"]
    text = plan(asof.match_schedule(facts, asof.nearest_intervals(schedule, by), by, "event_s",
                                    max_rows=10))
    assert "rightHint" not in text and "salt" in text


def test_line_filter_reaches_the_scan(spark, tmp_path):
    from stopwise.operators.clean import clean_pings
    fixtures.gps_raw(spark, SF).write.parquet(f"{tmp_path}/raw")
    text = plan(clean_pings(spark.read.parquet(f"{tmp_path}/raw"), "11"))
    assert "In(codLinea, [11,11.0])" in text


def test_replay_stages_once_and_reads_narrow(spark):
    made, stops, schedule = catalog._enriched(spark, SF)
    text = plan(chains.track(made).select("codBus", "event_s", "speed_mps"))
    assert "enriched-" in text and "stop_name" not in text.split("ReadSchema")[1]


def test_replay_reads_its_arrivals_from_one_written_table(spark):
    text = plan(chains.vehicle_replay(*catalog._enriched(spark, SF)))
    assert "arrived-" in text and "enriched-" not in text


def test_stop_times_are_dealt_out_by_trip_once(spark):
    text = plan(fixtures.stop_times(spark, SF))
    keys = [line for line in text.splitlines() if "hashpartitioning(" in line]
    assert keys and all("hashpartitioning(trip_id" in k for k in keys)
