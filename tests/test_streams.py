"""Streams against batch."""

import random
import time

import pytest
from pyspark.sql import functions as F

from stopwise.operators.clean import clean_pings, dedup_pings, stamp_snapshot
from stopwise.operators.evaluate import mae_summary
from stopwise.operators.model import fit_delay_model, score_live_status
from stopwise.operators.timetable import route_geometry
from stopwise.operators.training import clean_training
from stopwise.plans import catalog, chains, fixtures
from stopwise.sources import (load_model, read_ping_stream, read_training, save_model,
                              write_table)
from stopwise.streaming import (finish_vehicles, follow_vehicles, read_sink, run_available,
                                start_query)
from small import at, lat, line, pings, rows, schedule

SF = "/root/testdata/sf0.001"
RAW = ["codBus", "codLinea", "sentido", "lat", "lon", "codParIni", "last_update"]


def output(df):
    """Output rows with doubles rounded."""
    rounded = ["predicted_delay_math", "actual_delay", "final_math_error"]
    return rows(df, "bus_id", "last_update", "lat", "lon", "next_stop_name", "scheduled_time",
                "is_arrival_event", *[F.round(c, 5) for c in rounded])


@pytest.fixture(scope="module")
def network(spark):
    times = catalog._line(spark, SF)
    return route_geometry(times), times


@pytest.fixture(scope="module")
def raw(spark):
    return fixtures.gps_raw(spark, SF).select(*RAW).persist()


def land(df, feed):
    df.coalesce(1).write.mode("append").option("header", True).csv(feed)


def vehicles(spark, feed, network, **options):
    stops, times = network
    stream = chains.enrich(clean_pings(read_ping_stream(spark, feed), "11"), stops, times)
    return finish_vehicles(follow_vehicles(stream, **options), stops, times)


def replayed(spark, raw, network):
    stops, times = network
    single = dedup_pings(clean_pings(raw, "11"))
    return chains.vehicle_replay(chains.enrich(single, stops, times), stops, times)


@pytest.mark.parametrize("seed", [1, 2])
def test_random_file_splits_equal_replay(spark, raw, network, tmp_path, seed):
    """Every cut restarts the query from its checkpoint."""
    rnd = random.Random(seed)
    feed, out = f"{tmp_path}/feed", f"{tmp_path}/out"
    cuts = sorted(f"2024-01-01 06:{rnd.randint(1, 39):02d}:{rnd.choice(['00', '15'])}"
                  for _ in range(2)) + ["2024-01-01 23:58:00", "9"]
    since = "0"
    for until in cuts:
        land(raw.filter((F.col("last_update") >= since) & (F.col("last_update") < until)), feed)
        run_available(vehicles(spark, feed, network), out, f"{tmp_path}/check",
                      output_mode="update")
        since = until
    assert output(read_sink(spark, out)) == output(replayed(spark, raw, network))


def test_old_pings_change_nothing(spark, raw, network, tmp_path):
    feed, out = f"{tmp_path}/feed", f"{tmp_path}/out"
    early = raw.filter("last_update < '2024-01-01 06:10:00'")
    for part in (early, early.limit(200)):
        land(part, feed)
        run_available(vehicles(spark, feed, network), out, f"{tmp_path}/check",
                      output_mode="update")
    assert output(read_sink(spark, out)) == output(replayed(spark, early, network))


def test_repeated_batch_overwrites(spark, tmp_path):
    out = f"{tmp_path}/out"
    feed = f"{tmp_path}/feed"
    land(spark.createDataFrame([("1", "11", "1", "36.7", "-4.4", "1", at("07:00:00"))], RAW),
         feed)
    for check in ("a", "b"):  # a second checkpoint repeats batch 0
        run_available(read_ping_stream(spark, feed), out, f"{tmp_path}/{check}")
    assert read_sink(spark, out).count() == 1


def test_idle_vehicle_is_forgotten(spark, tmp_path):
    feed, out = f"{tmp_path}/feed", f"{tmp_path}/out"
    network = (line(spark), schedule(spark, [("A1", 0, "07:00:00")]))
    columns = ["codBus", "codLinea", "sentido", "lat", "lon", "codParIni", "last_update"]

    def ping(bus, clock, stop):
        land(spark.createDataFrame([(bus, "11", "1", str(lat(stop)), "-4.45", "1", at(clock))],
                                   columns), feed)

    ping("1", "07:00:00", 1)
    query = start_query(vehicles(spark, feed, network, idle_s=1, clock="processing"), out, f"{tmp_path}/check",
                        output_mode="update", every="1 seconds")
    try:
        limit, rows_left = time.time() + 60, None
        while time.time() < limit:
            progress = query.lastProgress
            if progress and progress["stateOperators"]:
                rows_left = progress["stateOperators"][0]["numRowsTotal"]
                if rows_left == 0 and progress["batchId"] > 0:
                    break
            time.sleep(0.5)
        assert rows_left == 0
        ping("1", "07:01:00", 3)  # starts afresh: no arrival although the sequence is higher
        limit = time.time() + 60  # an armed timeout keeps empty batches coming
        while time.time() < limit and read_sink(spark, out).count() < 2:
            time.sleep(0.5)
    finally:
        query.stop()
    assert rows(read_sink(spark, out), "last_update", "is_arrival_event") == [
        (at("07:00:00"), 0), (at("07:01:00"), 0)]


def test_model_in_stream_and_on_disk(spark, raw, network, tmp_path):
    table = write_table(catalog._training(spark, SF), f"{tmp_path}/training")
    training = clean_training(read_training(spark, table))
    path = save_model(fit_delay_model(training, num_trees=5, max_depth=4), f"{tmp_path}/model")
    model = load_model(path)
    scored = score_live_status(catalog._live(spark, SF), model)
    assert scored.columns[-1] == "predicted_delay_seconds"
    assert scored.filter("predicted_delay_seconds IS NULL").count() == 0

    stops, times = network
    feed, out = f"{tmp_path}/feed", f"{tmp_path}/out"
    land(raw.filter("last_update < '2024-01-01 06:10:00'"), feed)
    for name, used in (("with", model), ("without", None)):
        stream = chains.score_enriched(
            chains.enrich(clean_pings(read_ping_stream(spark, feed), "11"), stops, times), used)
        made = finish_vehicles(follow_vehicles(stream), stops, times)
        run_available(made, f"{out}-{name}", f"{tmp_path}/check-{name}", output_mode="update")
    with_model, without = (read_sink(spark, f"{out}-{n}") for n in ("with", "without"))
    assert with_model.filter("predicted_delay_ml IS NULL").count() == 0
    assert without.filter("predicted_delay_ml IS NOT NULL").count() == 0
    errors = {"heuristic": "final_math_error", "ml": "final_ml_error"}
    assert {r["predictor"] for r in mae_summary(with_model, errors).collect()} == set(errors)
    assert {r["predictor"] for r in mae_summary(without, errors).collect()} == {"heuristic"}
    # The model's errors in the stream are those of the batch replay.
    single = dedup_pings(clean_pings(raw.filter("last_update < '2024-01-01 06:10:00'"), "11"))
    batch = chains.vehicle_replay(
        chains.score_enriched(chains.enrich(single, stops, times), model), stops, times)
    columns = ["bus_id", "last_update", F.round("predicted_delay_ml", 6),
               F.round("final_ml_error", 6)]
    assert rows(with_model, *columns) == rows(batch, *columns)


def test_smoothed_speed_in_stream(spark, raw, network, tmp_path):
    stops, times = network
    feed, out = f"{tmp_path}/feed", f"{tmp_path}/out"
    land(raw.filter("last_update < '2024-01-01 06:20:00'"), feed)
    stream = chains.enrich(clean_pings(read_ping_stream(spark, feed), "11"), stops, times)
    run_available(follow_vehicles(stream, speed="ewma"), out, f"{tmp_path}/check",
                  output_mode="update")
    single = dedup_pings(clean_pings(raw.filter("last_update < '2024-01-01 06:20:00'"), "11"))
    batch = chains.track(chains.enrich(single, stops, times), speed="ewma")
    columns = ["codBus", "event_s", F.round("speed_mps", 6)]
    assert rows(read_sink(spark, out), *columns) == rows(batch, *columns)


def test_snapshot_stamp(spark, tmp_path):
    made = stamp_snapshot(pings(spark, [("1", at("07:00:00"), 36.7, -4.45)]))
    assert made.filter("snapshot_time IS NULL").count() == 0
    path = write_table(made.drop("snapshot_time"), f"{tmp_path}/t")
    read = stamp_snapshot(spark.read.parquet(path), "ingest_time", from_file=True)
    assert read.filter("ingest_time IS NULL").count() == 0


def test_the_follower_works_on_plain_rows():
    """One bus without Spark: no table is made per bus, and rows go in any order."""
    from pyspark.sql import Row
    from stopwise.streaming.vehicle import _follower

    class Kept:
        def __init__(self, value):
            self.value = value

        def get(self):
            return self.value

        def exists(self):
            return self.value is not None

        def update(self, value):
            self.value = value

        put = update

    class Handle:
        def getValueState(self, *_):
            return Kept(None)

        def getListState(self, *_):
            return Kept([])

    columns = ["codBus", "event_s", "lat", "lon", "direction_id", "distance_m", "scheduled_epoch_s",
               "stop_sequence", "predicted_delay_ml"]
    row = Row(*columns)
    bus = _follower(columns, 5.5, 5.0, 1.0, 600, None, "event", False)
    bus.init(Handle())
    first = [row("b", 130, 36.703, -4.45, 0, 11.0, 150, 2, 7.0), row("b", 100, 36.7, -4.45, 0, 55.0, None, 1, None),
             row("b", 100, 36.9, -4.45, 0, 55.0, None, 5, None)]
    out = list(bus.handleInputRows(("b",), iter(first), None))
    assert [(r.event_s, r.passed_sequence) for r in out] == [(100, None), (130, 1)]
    assert (out[0].speed_mps, out[0].seconds_to_scheduled, out[0].predicted_delay_math) == (5.5, 10.0, 0.0)
    assert out[1].speed_mps == pytest.approx(11.1, abs=0.05) and out[1].seconds_to_scheduled == 20.0
    assert out[1].recent_math == [0.0]
    later = list(bus.handleInputRows(("b",), iter([first[0], row("b", 160, 36.706, -4.45, 0, 0.0, 160, 3, 7.0)]), None))
    assert [(r.event_s, r.passed_sequence, r.recent_ml) for r in later] == [(160, 2, [7.0])]
