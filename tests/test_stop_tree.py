"""The quadtree of stops against all pairs."""

import numpy as np
import pytest
from pyspark.sql import Window, functions as F

from stopwise.functions.geo import GEODISTANCE, HAVERSINE
from stopwise.operators.joins import release_dimensions
from stopwise.operators.nearest import nearest_stop
from stopwise.operators.stop_tree import LEAF_STOPS, build_tree, far_stop, search_tree, z_codes
from small import STOPS, rows


def places(rng, n, spread):
    lat = np.clip(36.7 + rng.normal(0, spread, n), -90, 90)
    lon = (-4.4 + rng.normal(0, spread, n) + 180) % 360 - 180
    flat = np.cos(np.radians(lat))
    return lat, lon, 6371000.0 * np.stack([flat * np.cos(np.radians(lon)), flat * np.sin(np.radians(lon)),
                                           np.sin(np.radians(lat))], axis=1)


@pytest.mark.parametrize("n, spread", [(0, 1), (1, 1), (17, 0), (500, 0.1), (3000, 40)])
def test_search_finds_the_least_line_and_the_lowest_index(n, spread):
    rng = np.random.default_rng(n)
    lat, lon, own = places(rng, n, spread)
    if n > 100:
        own[n // 2:n // 2 + 40] = own[0]            # many stops at one place
        lat[n // 2:n // 2 + 40], lon[n // 2:n // 2 + 40] = lat[0], lon[0]
    tree = build_tree(own, z_codes(lat, lon))
    assert all(last - first <= max(LEAF_STOPS, 41) or tree["children"][k] or spread == 0
               for k, (first, last) in enumerate(tree["span"]))
    for at in [*places(rng, 40, 90)[2], *(own[:20] if n else []), np.array([6371000.0, 0, 0])]:
        found, seen = search_tree(tree, at)
        if not n:
            assert found == -1
            continue
        gap = own - at
        line = gap[:, 0] * gap[:, 0] + gap[:, 1] * gap[:, 1] + gap[:, 2] * gap[:, 2]
        assert found == int(np.argmin(line))


def test_a_far_search_visits_few_nodes():
    rng = np.random.default_rng(2)
    lat, lon, own = places(rng, 50_000, 0.2)
    tree = build_tree(own, z_codes(lat, lon))
    seen = [search_tree(tree, at)[1] for at in (np.array([6371000.0, 0, 0]), np.array([0, 6371000.0, 0]))]
    assert max(seen) < 0.02 * len(tree["span"])


def far_pings(spark):
    """Faults at (0, 0), each many times, the antipode, both sides of the date line, the poles."""
    spots = [(0.0, 0.0)] * 30 + [(-36.7, 175.6), (36.7, 179.9999), (36.7, -179.9999), (90.0, 0.0),
                                 (-90.0, 0.0), (36.7, -4.4), (38.9, -6.1), (0.0, 180.0), (0.0, -180.0)]
    return spark.createDataFrame([(str(k), k, k % 2, *spot) for k, spot in enumerate(spots)],
                                 "codBus string, event_s long, direction_id int, lat double, lon double")


def two_ways(spark):
    rng = np.random.default_rng(7)
    made = [(d, i, f"S{d}{i}", f"s{i}", float(36.7 + rng.normal(0, 0.05)), float(-4.4 + rng.normal(0, 0.05)))
            for d in (0, 1) for i in range(80)]
    made += [(0, 200, "FIJI", "f", 36.7, 179.9998), (1, 200, "FIJI2", "f", 36.7, -179.9997),
             (0, 201, "B", "b", 36.5, -4.5), (0, 201, "A", "a", 36.5, -4.5), (1, 202, "POLE", "p", 89.9, 10.0)]
    return spark.createDataFrame(made, STOPS)


@pytest.mark.parametrize("metric", [HAVERSINE, GEODISTANCE])
@pytest.mark.parametrize("options", [{}, {"levels": ()}, {"tree_stops": 0}, {"levels": (), "tree_stops": 0}])
def test_faults_find_their_stop(spark, metric, options):
    got = nearest_stop(far_pings(spark), two_ways(spark), metric=metric, by=["direction_id"], **options)
    here = [f"{sql} AS _{a}" for a, sql in zip("xyz", metric.place("lat", "lon"))]
    there = [f"{sql} AS {a}" for a, sql in zip("xyz", metric.place("stop_lat", "stop_lon"))]
    line = "pow(x - _x, 2) + pow(y - _y, 2) + pow(z - _z, 2)"
    pairs = far_pings(spark).selectExpr("*", *here).join(
        two_ways(spark).selectExpr("*", *there), "direction_id").withColumn("line", F.expr(line))
    w = Window.partitionBy("codBus").orderBy(F.round("line", 3), "stop_sequence", "stop_id")
    want = pairs.withColumn("rn", F.row_number().over(w)).filter("rn = 1")
    assert rows(got, "codBus", "stop_id") == rows(want, "codBus", "stop_id")


def test_no_stop_and_no_position(spark):
    nowhere = two_ways(spark).filter("false")
    for bound in (100, -1):
        assert nearest_stop(far_pings(spark), nowhere, tree_stops=bound).count() == 0
    lost = far_pings(spark).withColumn("lat", F.lit(None).cast("double"))
    assert nearest_stop(lost, two_ways(spark)).count() == 0


def test_no_array_or_group_of_all_stops(spark):
    """A far search builds neither; above the bound it goes by joins."""
    stops = two_ways(spark)
    for bound in (1000, 10):
        plan = nearest_stop(far_pings(spark), stops, levels=(), tree_stops=bound)._jdf.queryExecution().toString()
        assert "EvalPython" not in plan and "collect_" not in plan
    release_dimensions()


def test_a_stream_with_many_stops_searches_box_by_box(spark, tmp_path):
    from stopwise.streaming import read_sink, run_available
    far_pings(spark).write.parquet(f"{tmp_path}/pings")
    stream = spark.readStream.schema(far_pings(spark).schema).parquet(f"{tmp_path}/pings")
    found = nearest_stop(stream, two_ways(spark), by=["direction_id"], tree_stops=10)
    run_available(found, f"{tmp_path}/out", f"{tmp_path}/check")
    want = nearest_stop(far_pings(spark), two_ways(spark), by=["direction_id"])
    columns = ["codBus", "stop_id", F.round("distance_m", 6)]
    assert rows(read_sink(spark, f"{tmp_path}/out"), *columns) == rows(want, *columns)


def test_hot_faults_are_searched_once(spark):
    """Many pings at one faulty position reach the joins as one row."""
    many = spark.range(20_000).selectExpr("CAST(id AS string) AS codBus", "id AS event_s",
                                          "0 AS direction_id", "0D AS lat", "0D AS lon")
    got = nearest_stop(many, two_ways(spark), by=["direction_id"], tree_stops=0)
    assert got.select("stop_id").distinct().count() == 1 and got.count() == 20_000
