"""Scale forms against plain ones."""

import math
import random
import re

import pytest
from pyspark.sql import Window, functions as F

from stopwise.functions.geo import GEODISTANCE, HAVERSINE
from stopwise.functions.times import second_of_day_sql
from stopwise.operators import arrivals, asof
from stopwise.operators.joins import join_dimension
from stopwise.operators.motion import ewma_speed, link_pings
from stopwise.operators.nearest import nearest_stop
from stopwise.operators.sequences import number_within_key
from stopwise.plans import catalog, chains
from small import STOPS, rows, schedule

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def enriched(spark):
    made, stops, times = catalog._enriched(spark, SF)
    made = made.persist()
    return made, stops, times


def scattered(spark, n=400, seed=3):
    """Positions near, far and on the other side of the globe."""
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        spread = rnd.choice([0.01, 0.2, 3.0, 60.0])
        out.append((str(i), i, max(-89.0, min(89.0, 36.7 + rnd.gauss(0, spread))),
                    (rnd.gauss(-4.4, spread) + 180) % 360 - 180))
    out += [("e", 9000, 36.7, 179.9999), ("w", 9001, 36.7, -179.9999)]
    return spark.createDataFrame(out, "codBus string, event_s long, lat double, lon double")


def network(spark, seed=5):
    rnd = random.Random(seed)
    made = [(0, i, f"S{i}", f"s{i}", 36.7 + rnd.gauss(0, 0.03), -4.4 + rnd.gauss(0, 0.03))
            for i in range(60)]
    made += [(0, 100, "FIJI", "f", 36.7, 179.9998), (0, 101, "POLE", "p", 88.0, 10.0)]
    return spark.createDataFrame(made, STOPS)


@pytest.mark.parametrize("options", [{}, {"levels": (18, 14, 9, 6)}, {"levels": ()},
                                     {"max_rows": 0, "salts": 3}, {"tree_stops": 5},
                                     {"levels": (), "tree_stops": 0}])
def test_grid_equals_all_pairs(spark, options):
    found = nearest_stop(scattered(spark), network(spark), **options)
    sql = HAVERSINE.distance("p.lat", "p.lon", "s.stop_lat", "s.stop_lon")
    w = Window.partitionBy("codBus").orderBy("d", "stop_sequence", "stop_id")
    want = (scattered(spark).alias("p").crossJoin(network(spark).alias("s"))
            .withColumn("d", F.expr(sql)).withColumn("rn", F.row_number().over(w))
            .filter("rn = 1"))
    assert rows(found, "codBus", "stop_id", F.round("distance_m", 6)) == rows(
        want, "codBus", "stop_id", F.round("d", 6))


def vincenty(lat1, lon1, lat2, lon2):
    a, f = 6378137.0, 1 / 298.257223563
    b = a * (1 - f)
    u1, u2 = (math.atan((1 - f) * math.tan(math.radians(x))) for x in (lat1, lat2))
    span = lam = math.radians(lon2 - lon1)
    for _ in range(200):
        s = math.hypot(math.cos(u2) * math.sin(lam), math.cos(u1) * math.sin(u2)
                       - math.sin(u1) * math.cos(u2) * math.cos(lam))
        if s == 0:
            return 0.0
        c = math.sin(u1) * math.sin(u2) + math.cos(u1) * math.cos(u2) * math.cos(lam)
        sigma = math.atan2(s, c)
        sin_a = math.cos(u1) * math.cos(u2) * math.sin(lam) / s
        cos2 = 1 - sin_a ** 2
        mid = c - 2 * math.sin(u1) * math.sin(u2) / cos2 if cos2 else 0.0
        k = f / 16 * cos2 * (4 + f * (4 - 3 * cos2))
        before, lam = lam, span + (1 - k) * f * sin_a * (
            sigma + k * s * (mid + k * c * (2 * mid ** 2 - 1)))
        if abs(lam - before) < 1e-13:
            break
    u = cos2 * (a * a - b * b) / (b * b)
    big_a = 1 + u / 16384 * (4096 + u * (u * (320 - 175 * u) - 768))
    big_b = u / 1024 * (256 + u * (u * (74 - 47 * u) - 128))
    delta = big_b * s * (mid + big_b / 4 * (c * (2 * mid ** 2 - 1) - big_b / 6 * mid
                                            * (4 * s * s - 3) * (4 * mid ** 2 - 3)))
    return b * big_a * (sigma - delta)


def test_geodistance_against_geodesic(spark):
    rnd = random.Random(1)
    points = [(36.7 + rnd.uniform(-.05, .05), -4.4 + rnd.uniform(-.07, .07),
               36.7 + rnd.uniform(-.05, .05), -4.4 + rnd.uniform(-.07, .07))
              for _ in range(500)]
    df = spark.createDataFrame(points, "a double, b double, c double, d double")
    got = [r[0] for r in df.select(F.expr(GEODISTANCE.distance("a", "b", "c", "d"))).collect()]
    assert max(abs(g - vincenty(*p)) for g, p in zip(got, points)) < 0.005


@pytest.mark.parametrize("service_day", ["reference", "adjacent"])
@pytest.mark.parametrize("options", [{}, {"max_rows": 0, "salts": 4},
                                     {"max_rows": 0, "salts": 1, "stretch_s": 700}])
def test_asof_equals_brute_force(spark, service_day, options):
    rnd = random.Random(11)
    times = {(f"A{rnd.randint(1, 3)}", rnd.randint(0, 100_000)) for _ in range(150)}
    text = [(s, 0, f"{t // 3600}:{t // 60 % 60:02d}:{t % 60:02d}") for s, t in times]
    probes = [(str(i), f"A{rnd.randint(1, 4)}", 0, rnd.randint(0, 20 * 86400) + rnd.choice([0.0, .25]))
              for i in range(600)]
    facts = spark.createDataFrame(
        probes, "codBus string, stop_id string, direction_id int, event_s double")
    by = ["stop_id", "direction_id"]
    got = asof.match_schedule(
        facts, asof.nearest_intervals(schedule(spark, text), by, service_day=service_day), by,
        second_of_day_sql("event_s"), **options)
    want = []
    for bus, stop, _, x in probes:
        x = x % 86400
        moments = [t for s, t in times if s == stop]
        if service_day == "adjacent":
            moments = [t + d * 86400 for t in moments for d in (-1, 0, 1)]
        near = sorted((abs(t - x), t) for t in moments if abs(t - x) < 7200)
        want.append((bus, near[0][1] if near else None))
    assert rows(got, "codBus", "scheduled_s") == sorted(want, key=repr)


def test_salted_join_equals_broadcast(spark):
    facts = spark.range(5000).selectExpr("id", "if(id % 3 = 0, 7, id % 11) AS k")
    dim = spark.range(9).selectExpr("id AS k", "id * 10 AS v")
    plain = join_dimension(facts, dim, ["k"], salt_on=["id"])
    salted = join_dimension(facts, dim, ["k"], salt_on=["id"], max_rows=0, salts=5)
    assert rows(plain, "id", "v") == rows(salted, "id", "v")


@pytest.mark.parametrize("segment_s", [60, 600, 3600])
def test_segments_do_not_change_results(spark, enriched, segment_s):
    made, _, _ = enriched
    whole = link_pings(made, segment_s=10 ** 9)
    cut = link_pings(made, segment_s=segment_s)
    columns = ["codBus", "event_s", F.round("speed_mps", 9), "before.event_s"]
    assert rows(cut, *columns) == rows(whole, *columns)


@pytest.mark.parametrize("segment_s", [60, 300])
def test_smoothing_segments(spark, enriched, segment_s):
    linked = link_pings(enriched[0])
    got = ewma_speed(linked, segment_s=segment_s)
    state, want = {}, []
    for r in sorted(linked.collect(), key=lambda r: (r["codBus"], r["event_s"])):
        speed = state.get(r["codBus"], 5.5)
        if r["before"] is not None:
            b = r["before"]
            step = vincenty(b["lat"], b["lon"], r["lat"], r["lon"]) / (r["event_s"] - b["event_s"])
            if 0.1 < step < 25:
                speed = 0.2 * step + 0.8 * speed
        state[r["codBus"]] = speed
        want.append((r["codBus"], r["event_s"], speed))
    found = {(r["codBus"], r["event_s"]): r["speed_mps"] for r in got.collect()}
    assert len(found) == len(want)
    assert all(found[b, t] == pytest.approx(s, abs=1e-3) for b, t, s in want)


def test_replay_segments(spark, enriched):
    # A segment is longer than the age of a prediction, so 700 s is a hard case.
    cut = chains.vehicle_replay(*enriched, segment_s=700)
    whole = chains.vehicle_replay(*enriched, segment_s=10 ** 8)
    columns = ["bus_id", "last_update", "is_arrival_event", F.round("actual_delay", 6),
               F.round("final_math_error", 6)]
    assert rows(cut, *columns) == rows(whole, *columns)


def test_visit_segments(spark):
    matched = catalog._matched(spark, SF).persist()
    cut = arrivals.arrivals_by_visit(matched, segment_s=300)
    whole = arrivals.arrivals_by_visit(matched, segment_s=10 ** 9)
    assert rows(cut) == rows(whole)


def test_numbering_segments(spark):
    df = spark.range(3000).selectExpr("id * 3 AS id", "if(id % 3 = 0, 1, id % 7) AS k")
    got = number_within_key(df, "k", "id", "n", segment_rows=100)
    w = Window.partitionBy("k").orderBy("id")
    assert rows(got, "k", "id", "n") == rows(
        df.withColumn("n", F.row_number().over(w) - 1), "k", "id", "n")


@pytest.mark.parametrize("alpha", [0.001, 0.2, 0.9])
def test_smoothing_equals_a_plain_loop(spark, alpha):
    """Small weights need the whole history: many segments in several blocks."""
    rnd = random.Random(17)
    given, now, here = [], 0, 36.0
    for _ in range(500):
        now += rnd.choice([20, 30, 400])
        here += rnd.choice([0.0, 0.0005, 0.002, 0.2])
        given.append(("1", now, round(here, 6), -4.4))
    pings = spark.createDataFrame(given, "codBus string, event_s long, lat double, lon double")
    linked = link_pings(pings).withColumn("step_m", F.expr(GEODISTANCE.distance(
        "before.lat", "before.lon", "lat", "lon")))
    got = ewma_speed(linked, alpha=alpha, segment_s=60, block=7).orderBy("event_s").select(
        "event_s", "speed_mps", "step_m", "before.event_s").collect()
    speed = 5.5
    for now, found, metres, before in got:
        if before is not None and 0.1 < metres / (now - before) < 25.0:
            speed = alpha * metres / (now - before) + (1 - alpha) * speed
        assert found == pytest.approx(speed, rel=1e-9)


@pytest.mark.parametrize("build", [asof.nearest_intervals, asof.next_intervals])
def test_merged_schedule_equals_joined(spark, build):
    """At whole seconds, where rows and begins of intervals fall together."""
    rnd = random.Random(23)
    text = [(f"A{rnd.randint(1, 3)}", d, f"{rnd.randint(0, 25)}:{rnd.choice([0, 30]):02d}:00")
            for d in (0, 1) for _ in range(60)]
    probes = [(str(i), rnd.choice(["A1", "A2", "A9", None]), rnd.choice([0, 1]), 900 * rnd.randint(0, 200))
              for i in range(800)] + [("n", "A1", 0, None)]
    facts = spark.createDataFrame(probes, "codBus string, stop_id string, direction_id int, event_s long")
    by = ["stop_id", "direction_id"]
    for how in ("left", "inner"):
        joined, merged = (asof.match_schedule(
            facts, build(schedule(spark, text), by), by, second_of_day_sql("event_s"), how=how, **options)
            for options in ({}, {"max_rows": 0, "salts": 3, "stretch_s": 1800}))
        assert joined.columns == merged.columns
        assert rows(joined) == rows(merged)


def test_a_large_timetable_is_merged_in_rows_of_its_times(spark):
    """5,000 stops, two directions: no interval is repeated for the buckets it touches."""
    times = spark.range(5000).selectExpr("CAST(id AS string) AS stop_id").crossJoin(
        spark.range(2).selectExpr("CAST(id AS int) AS direction_id")).selectExpr(
        "*", "explode(sequence(18000, 79200, 1800)) AS service_s")
    by = ["stop_id", "direction_id"]
    facts = spark.createDataFrame([("1", "7", 0, 20_000), ("2", "4999", 1, 79_300), ("3", "5000", 1, 30_000)],
                                  "codBus string, stop_id string, direction_id int, event_s long")
    found = asof.match_schedule(facts, asof.nearest_intervals(times, by), by, "event_s", max_rows=1000, salts=1,
                                stretch_s=86_400)
    assert rows(found, "codBus", "scheduled_s") == [("1", 19800), ("2", 79200), ("3", None)]
    text = found._jdf.queryExecution().optimizedPlan().toString()
    assert "bucket" not in text


@pytest.mark.parametrize("options", [{}, {"max_rows": 1000}])
def test_a_dense_timetable_is_compared_and_copied_a_few_times(spark, monkeypatch, options):
    """A time every 2 s: narrow buckets when it is broadcast, few copies when it is merged."""
    monkeypatch.setattr(asof, "SALTED_ROWS", 20_000, raising=False)
    by = ["stop_id", "direction_id"]
    times = spark.range(10_000).selectExpr("if(id % 2 = 0, 'A1', 'A2') AS stop_id", "0 AS direction_id",
                                           "20000 + id - id % 2 AS service_s")
    probes = [(str(i), f"A{1 + i % 3}", 0, 19_000 + 37 * i + i % 4 * 0.25) for i in range(320)]
    facts = spark.createDataFrame(probes, "codBus string, stop_id string, direction_id int, event_s double")
    found = asof.match_schedule(facts, asof.nearest_intervals(times, by), by, "event_s", **options)
    want = [(bus, None if stop == "A3" else min(max(20_000, int((x - 1e-9 + 1) // 2 * 2)), 29_998))
            for bus, stop, _, x in probes]
    assert rows(found, "codBus", "scheduled_s") == sorted(want, key=repr)
    text = found._jdf.queryExecution().optimizedPlan().toString()
    if options:
        assert re.search(r"pmod\(xxhash64\([^)]*\), 2\)", text)
    else:
        assert "/ 900" not in text


@pytest.mark.parametrize("build", [asof.nearest_intervals, asof.next_intervals])
@pytest.mark.parametrize("service_day", ["reference", "adjacent"])
def test_packed_schedule_equals_merged(spark, build, service_day):
    """Up to eight times the broadcast bound a timetable is packed, and rows are not sorted for it."""
    rnd = random.Random(31)
    text = [(f"A{rnd.randint(1, 3)}", d, f"{rnd.randint(4, 26)}:{rnd.randint(0, 59):02d}:{rnd.randint(0, 59):02d}")
            for d in (0, 1) for _ in range(600)] + [("A4", 0, "12:00:00")]
    probes = [(str(i), rnd.choice(["A1", "A2", "A4", "A9", None]), rnd.choice([0, 1]),
               rnd.randint(0, 3 * 86400) + rnd.choice([0.0, 0.5, 0.26])) for i in range(2000)]
    probes += [("e", "A4", 0, 43200.0 + d) for d in (-7200, -7199.9, 0, 7199.9, 7200)] + [("n", "A1", 0, None)]
    facts = spark.createDataFrame(probes, "codBus string, stop_id string, direction_id int, event_s double")
    by = ["stop_id", "direction_id"]
    for how in ("left", "inner"):
        packed, merged = (asof.match_schedule(
            facts, build(schedule(spark, text), by, service_day=service_day), by, second_of_day_sql("event_s"),
            how=how, **options) for options in ({"max_rows": 900}, {"max_rows": 0, "salts": 1}))
        assert packed.schema == merged.schema
        assert rows(packed) == rows(merged)
        plan = packed._jdf.queryExecution().optimizedPlan().toString()
        assert "_value" in plan and "xxhash64" not in plan
