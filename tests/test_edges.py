"""Edge rows by hand."""

import pytest
from pyspark.sql import functions as F

from stopwise.functions.geo import HAVERSINE
from stopwise.functions.labels import delay_status, delay_status_3way, display_delay
from stopwise.functions.times import calendar_features, clock_text, service_seconds
from stopwise.operators import clean, timetable as tt
from stopwise.operators.nearest import nearest_stop
from stopwise.operators.position import route_position
from stopwise.plans import chains
from stopwise.schemas import PING_CSV
from stopwise.sources import load_model
from small import at, lat, line, one, pings, rows, schedule


def match(spark, clock, times, **options):
    ping = pings(spark, [("7", at(clock), lat(1), -4.45)])
    made = chains.enrich(ping, line(spark), schedule(spark, [("A1", 0, t) for t in times]),
                         **options)
    return one(made.withColumn("label", F.col("scheduled_time")), "label")


@pytest.mark.parametrize("clock, times, options, expected", [
    ("00:08:00", ["24:10:00"], {}, "N/A"),
    ("00:08:00", ["24:10:00"], {"service_day": "adjacent"}, "00:10:00"),
    ("23:59:00", ["00:02:00"], {}, "N/A"),
    ("23:59:00", ["00:02:00"], {"service_day": "adjacent"}, "00:02:00"),
    ("23:50:00", ["24:10:00"], {}, "00:10:00"),
    ("07:05:00", ["07:00:00", "07:10:00"], {}, "07:00:00"),
    ("07:00:00", ["09:00:00"], {}, "N/A"),
    ("07:00:00", ["08:59:59"], {}, "08:59:59"),
    ("07:00:00", ["6:55:00", "bad", "07:99:00"], {}, "06:55:00"),
    ("07:05:00", ["07:00:00", "07:10:00"], {"upcoming": True}, "07:10:00"),
    ("07:10:00", ["07:10:00", "07:20:00"], {"upcoming": True}, "07:10:00"),
    ("07:30:00", ["07:10:00", "07:20:00"], {"upcoming": True}, "N/A"),
    ("06:00:00", ["23:00:00"], {"upcoming": True}, "23:00:00"),
])
def test_schedule_match(spark, clock, times, options, expected):
    assert match(spark, clock, times, **options) == expected


def test_service_time_text(spark):
    texts = ["6:05:00", "24:10:00", "25:00:01", "12:60:00", "x:00:00", "12:00", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(service_seconds("t")).collect()]
    assert got == [21900, 87000, 90001, None, None, None, None, None]
    clock = spark.sql("SELECT 87000 AS s").select(clock_text("s")).first()[0]
    assert clock == "00:10:00"


def test_bad_values_are_skipped(spark):
    raw = spark.createDataFrame([
        ("1", "11.0", "1.0", "36.7", "-4.45", "1", at("07:00:00")),
        ("2", "11", "Ida", "36.7", "-4.45", "1", at("07:00:00")),
        ("3", "11", None, "36.7", "-4.45", "1", at("07:00:00")),
        ("4", "11", "2", "abc", "-4.45", "1", at("07:00:00")),
        ("5", "11", "2", "36.7", "-4.45", "1", "x"),
        (None, "11", "2", "36.7", "-4.45", "1", at("07:00:00")),
        ("6", "31.0", "2", "36.7", "-4.45", "1", at("07:00:00")),
    ], PING_CSV)
    assert rows(clean.clean_pings(raw, "11"), "codBus", "codLinea", "direction_id") == [
        ("1", "11", 0), ("2", "11", 0), ("3", "11", 1)]
    assert clean.clean_pings(raw).filter("codLinea = '31'").count() == 1


def test_header_names(spark):
    df = spark.createDataFrame([("1", "11", "36.7")], "CODBUS string, codLinea string, "
                                                      "Latitud string")
    named = clean.normalise_headers(df)
    assert named.columns == ["codBus", "codLinea", "lat"]
    wanted = clean.select_available(named, ["codBus", "lat", "lon"])
    assert rows(wanted) == [("1", "36.7", None)]


def test_distance_tie_takes_lower_sequence(spark):
    stops = spark.createDataFrame(
        [(0, 5, "B", "b", 36.7, -4.45), (0, 2, "C", "c", 36.7, -4.45),
         (0, 2, "A", "a", 36.7, -4.45)],
        line(spark).schema)
    found = nearest_stop(pings(spark, [("1", at("07:00:00"), 36.7001, -4.45)]), stops)
    assert rows(found, "stop_sequence", "stop_id") == [(2, "A")]


def test_direction_without_stops_uses_the_other(spark):
    stops = line(spark, direction=0)
    ping = pings(spark, [("1", at("07:00:00"), lat(3), -4.45, "2")])
    made = chains.enrich(ping, stops, schedule(spark, [("A3", 0, "07:00:00")]))
    # The stop comes from direction 0, the schedule is still asked for direction 1.
    assert rows(made, "stop_id", "scheduled_time") == [("A3", "N/A")]


def test_route_position_between_and_at_ends(spark):
    stops = line(spark, n=3)
    got = route_position(pings(spark, [
        ("at2", at("07:00:00"), lat(2, 0.0005), -4.45),
        ("gap", at("07:00:00"), lat(2, -0.0014), -4.45),
        ("before", at("07:00:00"), lat(1, -0.0020), -4.45),
        ("end", at("07:00:00"), lat(3, 0.0005), -4.45),
    ]), stops).withColumn("m", F.round("distance_m", 0))
    assert rows(got, "codBus", "current_stop_id", "stop_sequence", "next_stop_id", "m") == [
        ("at2", "A2", 2, "A3", 55.0), ("before", "A1", 1, "A2", 555.0),
        ("end", "A3", 3, None, 55.0), ("gap", "A1", 1, "A2", 155.0)]


def test_first_ping_jitter_arrival_and_repeats(spark):
    feed = pings(spark, [
        ("1", at("07:00:00"), lat(3), -4.45),
        ("1", at("07:00:10"), lat(3, 0.00003), -4.45),     # 3 m: speed kept
        ("1", at("07:00:10"), lat(4), -4.45),              # same second: dropped
        ("1", at("07:01:00"), lat(5), -4.45),
        ("1", at("07:20:00"), lat(4), -4.45),              # backwards: no arrival
        ("1", at("07:40:00"), lat(6), -4.45),              # predictions too old
    ])
    times = schedule(spark, [(f"A{i}", 0, f"07:0{i}:00") for i in range(1, 7)])
    stops = line(spark)
    enriched = chains.enrich(clean.dedup_pings(feed), stops, times)
    tracked = {r["last_update"][-8:]: r for r in chains.track(enriched).collect()}
    assert tracked["07:00:00"]["speed_mps"] == 5.5
    assert tracked["07:00:10"]["speed_mps"] == 5.5
    assert tracked["07:01:00"]["passed_sequence"] == 3
    out = {r["last_update"][-8:]: r
           for r in chains.vehicle_replay(enriched, stops, times).collect()}
    assert len(out) == 5
    assert [out[t]["is_arrival_event"] for t in sorted(out)] == [0, 0, 1, 0, 1]
    hit = out["07:01:00"]
    expected = [abs(out[t]["predicted_delay_math"] - hit["actual_delay"])
                for t in ("07:00:00", "07:00:10")]
    assert hit["final_math_error"] == pytest.approx(sum(expected) / 2)
    assert out["07:40:00"]["final_math_error"] == -1.0


def test_missing_schedule_modes(spark):
    stops, none = line(spark), schedule(spark, [("Z", 0, "07:00:00")])
    feed = pings(spark, [("1", at("07:00:00"), lat(1), -4.45), ("1", at("07:01:00"), lat(2), -4.45)])
    enriched = chains.enrich(feed, stops, none)
    tracked = chains.track(enriched)
    assert {r["predicted_delay_math"] for r in tracked.collect()} == {0.0}
    assert rows(tracked, "has_schedule") == [(False,), (False,)]
    loose = chains.evaluate_arrivals(tracked, stops, none).filter("passed_sequence IS NOT NULL")
    strict = chains.evaluate_arrivals(tracked, stops, none, strict=True).filter(
        "passed_sequence IS NOT NULL")
    assert one(loose, "actual_delay") == 0.0
    assert one(strict, "actual_delay") is None


def test_delay_labels(spark):
    df = spark.createDataFrame([(d,) for d in (-61.0, -60.0, 60.0, 61.0, 300.0, 301.0, None)],
                               "d double")
    got = df.select(delay_status(F.col("d")), delay_status_3way(F.col("d"))).collect()
    assert [tuple(r) for r in got] == [
        ("Early", "Early"), ("On Time", "On Time"), ("On Time", "On Time"),
        ("Delayed", "Late"), ("Delayed", "Late"), ("Very Late", "Late"), (None, None)]
    shown = spark.sql("SELECT 10D AS h, CAST(NULL AS double) AS m").select(
        display_delay("machine_learning", F.col("h"), F.col("m"))).first()[0]
    assert shown == 10.0
    with pytest.raises(ValueError):
        display_delay("other", F.col("h"), F.col("m"))


def test_weekday_numbers(spark):
    df = spark.sql("SELECT explode(array(timestamp '2024-01-07 13:05:00', "
                   "timestamp '2024-01-08 00:00:00', timestamp '2024-01-13 23:59:00')) AS t")
    got = [tuple(r) for r in df.select(*calendar_features("t").values()).collect()]
    assert got == [(13, 5, -1, 785), (0, 0, 0, 0), (23, 59, 5, 1439)]


def test_stops_sharing_a_sequence(spark):
    stops = spark.createDataFrame(
        [(0, 1, "A", "a", 36.70, -4.45), (0, 2, "B", "b", 36.71, -4.45),
         (0, 2, "C", "c", 36.71, -4.46), (0, 3, "D", "d", 36.72, -4.45)], line(spark).schema)
    got = tt.stop_neighbours(stops)
    assert rows(got, "stop_sequence", "before_stop_id", "toward_stop_id", "after_stop_id") == [
        (1, "A", "B", "B"), (2, "A", "B", "D"), (3, "C", "D", None)]


def test_missing_model_is_none(spark, tmp_path):
    assert load_model(None) is None
    assert load_model(str(tmp_path / "none")) is None


def test_default_metric_is_haversine(spark):
    ping = pings(spark, [("1", at("07:00:00"), 36.701, -4.45)])
    found = one(nearest_stop(ping, line(spark)), "distance_m")
    want = spark.sql(f"SELECT {HAVERSINE.distance('36.701D', '-4.45D', '36.7D', '-4.45D')}")
    assert found == pytest.approx(want.first()[0])


def test_replay_options_reach_the_operators(spark):
    """A bus that turns round, and an arrival at a stop without times."""
    stops = line(spark).unionByName(line(spark, direction=1))
    given = pings(spark, [("1", at("07:00:00"), lat(1), -4.45), ("1", at("07:01:00"), lat(3), -4.45),
                          ("1", at("07:02:00"), lat(4), -4.45, "2")])
    times = schedule(spark, [("A6", 0, "07:00:00")])
    made = chains.enrich(given, stops, times)
    for reset, passed in ((False, [None, 1, 3]), (True, [None, 1, None])):
        tracked = chains.track(made, reset_on_direction=reset).orderBy("event_s")
        assert [r["passed_sequence"] for r in tracked.collect()] == passed
    for strict, delay in ((False, [0.0, 0.0, 0.0]), (True, [0.0, None, None])):
        out = chains.vehicle_replay(made, stops, times, strict=strict).orderBy("last_update")
        assert [r["actual_delay"] for r in out.collect()] == delay


def test_two_digits_as_printf(spark):
    from stopwise.functions.times import two_digits
    df = spark.sql("SELECT explode(array(0L, 7, 10, 99, 100, -3, -12, NULL)) AS n")
    got = df.select(F.expr(two_digits("n")), F.expr("format_string('%02d', n)")).collect()
    assert [a for a, _ in got] == [b for _, b in got]


def test_service_seconds_of_odd_texts(spark):
    from stopwise.functions.times import service_seconds
    known = {" 6:05:00 ": 21900, "+6:05:00": 21900, "6: 5:00": 21900, "6:05": None, "6:05:00:": None, "::": None,
             "": None, "6:05:": None, "6:60:00": None, "-1:00:00": None, "25:00:01": 90001, None: None}
    df = spark.createDataFrame([(k,) for k in known], "t string").select("t", service_seconds("t").alias("s"))
    assert {r.t: r.s for r in df.collect()} == known
