"""Tables kept by micro-batches, compaction of the history, and state that event time expires."""

import random

import pytest
from pyspark.sql import functions as F

from stopwise.operators.clean import clean_pings, dedup_pings
from stopwise.operators.evaluate import ERROR_SUMS, error_sums, mean_errors, mae_summary
from stopwise.operators.timetable import route_geometry
from stopwise.plans import catalog, chains, fixtures
from stopwise.session import new_folder
from stopwise.sources import read_ping_stream
from stopwise.streaming import (KeptTable, compact_sink, follow_vehicles, newest, read_sink,
                                run_available, start_query, totals)
from small import at, lat, line, rows, schedule

SCHEMA = "bus_id string, last_update string, lat double, note string"


def batches(seed, n=8, buses=40):
    rng = random.Random(seed)
    return [[(f"b{rng.randrange(buses)}", f"2024-01-01 06:{rng.randrange(60):02d}:{rng.randrange(60):02d}",
              rng.random(), rng.choice(["x", None])) for _ in range(rng.randrange(0, 60))]
            for _ in range(n)]


def board_of(spark, folder, buckets=4):
    return KeptTable(spark, folder, SCHEMA, ["bus_id"], newest(["bus_id"], ["last_update", "lat"]), buckets)


def want(parts):
    best = {}
    for row in (r for part in parts for r in part):
        if row[0] not in best or row[1:3] > best[row[0]][1:3]:
            best[row[0]] = row
    return sorted(map(str, best.values()))


def got(table, before=None):
    return sorted(str(tuple(r)) for r in table.read(before).collect())


def test_newest_rows_over_batches_and_repeats(spark):
    table = board_of(spark, new_folder(spark, "board"))
    parts = batches(1)
    assert got(table) == []
    for k, part in enumerate(parts):
        frame = spark.createDataFrame(part, SCHEMA)
        table.fold(frame, k)
        assert got(table) == want(parts[:k + 1])
        if k % 2:
            table.fold(frame, k)        # a batch that runs again
            assert got(table) == want(parts[:k + 1])


def test_totals_do_not_count_a_repeated_batch_twice(spark):
    table = KeptTable(spark, new_folder(spark, "sums"), ERROR_SUMS, ["predictor"],
                      totals(["predictor"], ["samples", "error_sum"]), buckets=1)
    arrivals = spark.createDataFrame(
        [(float(k), None if k % 3 else float(-k)) for k in range(60)], "a double, b double")
    errors = {"first": "a", "second": "b", "none": "c"}
    arrivals = arrivals.withColumn("c", F.lit(None).cast("double"))
    for k in range(6):
        part = arrivals.filter((F.col("a") >= 10 * k) & (F.col("a") < 10 * k + 10))
        for _ in range(2):
            table.fold(error_sums(part, errors), k)
    assert rows(mean_errors(table.read())) == rows(mae_summary(arrivals, errors))


def test_a_batch_that_failed_half_way_starts_from_the_same_rows(spark, monkeypatch):
    folder = new_folder(spark, "board")
    table, parts = board_of(spark, folder), batches(3)
    for k in range(4):
        table.fold(spark.createDataFrame(parts[k], SCHEMA), k)
    # a part of batch 4 is there: some of its buckets were replaced, then the driver died
    half = [r for r in parts[4] if hash(r[0]) % 2]
    board_of(spark, folder).fold(spark.createDataFrame(half, SCHEMA), 4)
    assert got(table, before=4) == want(parts[:4])
    table.fold(spark.createDataFrame(parts[4], SCHEMA), 4)
    assert got(table) == want(parts[:5])


def test_a_batch_rewrites_only_the_buckets_it_touches(spark):
    folder = new_folder(spark, "board")
    table = board_of(spark, folder, buckets=8)
    table.fold(spark.createDataFrame([(f"b{k}", "2024", 0.0, None) for k in range(200)], SCHEMA), 0)
    table.fold(spark.createDataFrame([("b7", "2025", 1.0, None)], SCHEMA), 1)
    stored = spark.read.parquet(folder)
    assert stored.filter("written_by = 1").select("bucket", "slot").distinct().count() == 1
    assert stored.filter("written_by = 0").select("bucket").distinct().count() == 8
    assert table.read().count() == 200 and table.read().filter("last_update = '2025'").count() == 1
    plan = table.read(buckets=[3])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "bucket" in plan.split("PartitionFilters")[1]


def land(df, feed):
    df.coalesce(1).write.mode("append").option("header", True).csv(feed)


def test_stream_keeps_tables_without_a_history(spark, tmp_path):
    feed, out = f"{tmp_path}/feed", f"{tmp_path}/board"
    columns = ["codBus", "codLinea", "sentido", "lat", "lon", "codParIni", "last_update"]
    parts = [[(f"{b}", "11", "1", f"{36 + k / 10}", "-4.4", "1", at(f"07:{k:02d}:{b:02d}"))
              for b in range(5)] for k in (1, 3, 2)]
    table = KeptTable(spark, out, "codBus string, last_update string, lat string", ["codBus"],
                      newest(["codBus"], ["last_update"]), 2)
    for part in parts:
        land(spark.createDataFrame(part, columns), feed)
        run_available(read_ping_stream(spark, feed), None, f"{tmp_path}/check",
                      keep=[(table, lambda batch: batch)])
    assert rows(table.read(), "codBus", "lat") == [(f"{b}", "36.3") for b in range(5)]
    files = {f.split("/board/")[1].split("/")[0] for f in spark.read.parquet(out).inputFiles()}
    assert all(f.startswith("bucket=") for f in files)


def test_board_and_errors_never_read_the_history(spark, monkeypatch):
    """Their plans read the state alone, whatever the number of batches."""
    sf = "/root/testdata/sf0.001"
    for name in ("stream_board", "stream_mae"):
        plan = catalog.queries()[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
        read = [p for p in plan.split("FileScan parquet") if "sink-" in p.split("\n")[0]]
        assert read and all("written_by" in p.split("\n")[0] or "bucket" in p.split("\n")[0] for p in read)
        assert "batch_id" not in plan


def test_compaction_keeps_every_row_once(spark, tmp_path):
    path = f"{tmp_path}/sink"
    want_rows = []
    for k in range(12):
        part = [(k, f"r{k}-{j}") for j in range(3)]
        want_rows += [(b, r) for b, r in part]
        spark.createDataFrame([(r,) for _, r in part], "row string").write.parquet(f"{path}/batch_id={k}")
        if k in (5, 8, 11):
            compact_sink(spark, path, newest=2)
        assert rows(read_sink(spark, path), "batch_id", "row") == sorted(want_rows, key=repr)
    assert compact_sink(spark, path, newest=2) == 9
    left = {f.split("/sink/")[1].split("/")[0] for f in read_sink(spark, path).inputFiles()}
    assert left == {"through=9", "batch_id=10", "batch_id=11"}
    # a compaction that died is not read, and is done again
    import os
    os.remove(f"{path}/through=9/_SUCCESS")
    with pytest.raises(Exception):
        read_sink(spark, f"{tmp_path}/nothing").count()


def test_an_unfinished_compaction_is_ignored(spark, tmp_path):
    path = f"{tmp_path}/sink"
    for k in range(5):
        spark.createDataFrame([(f"r{k}",)], "row string").write.parquet(f"{path}/batch_id={k}")
    spark.createDataFrame([("half", 0)], "row string, batch_id long").write.parquet(f"{path}/through=3")
    import os
    os.remove(f"{path}/through=3/_SUCCESS")
    assert rows(read_sink(spark, path), "row") == [(f"r{k}",) for k in range(5)]
    assert compact_sink(spark, path, newest=1) == 3
    assert rows(read_sink(spark, path), "row") == [(f"r{k}",) for k in range(5)]


# --- expiry by event time ---------------------------------------------------------------

def followed(spark, feed, out, check, parts, idle_s, network, late="10 minutes"):
    stops, times = network
    columns = ["codBus", "codLinea", "sentido", "lat", "lon", "codParIni", "last_update"]
    progress = None
    for part in parts:
        land(spark.createDataFrame(part, columns), feed)
        known = clean_pings(read_ping_stream(spark, feed), "11").withWatermark("timestamp", late)
        query = start_query(follow_vehicles(chains.enrich(known, stops, times), idle_s=idle_s),
                            out, check, output_mode="update")
        query.awaitTermination()
        progress = query.lastProgress or progress
    return progress


def ping(bus, clock, stop):
    return (bus, "11", "1", str(lat(stop)), "-4.45", "1", at(clock))


@pytest.mark.parametrize("together", [True, False])
def test_a_gap_starts_a_bus_afresh_in_any_batch(spark, tmp_path, together):
    network = (line(spark), schedule(spark, [("A1", 0, "07:00:00")]))
    pings = [ping("1", "07:00:00", 1), ping("1", "07:00:30", 2), ping("1", "07:01:29", 3),
             ping("1", "07:02:29", 5), ping("1", "07:02:50", 4), ping("2", "07:00:10", 1),
             ping("2", "07:00:40", 2)]
    parts = [pings] if together else [[p] for p in pings[:5]] + [pings[5:]]
    followed(spark, f"{tmp_path}/feed", f"{tmp_path}/out", f"{tmp_path}/check", parts, 60, network)
    found = read_sink(spark, f"{tmp_path}/out").orderBy("codBus", "event_s").collect()
    assert [r["passed_sequence"] for r in found] == [None, 1, 2, None, None, None, 1]
    assert [r["speed_mps"] == 5.5 for r in found] == [True, False, False, True, False, True, False]


def test_a_timer_frees_a_silent_bus_and_a_repeated_ping_re_arms_it(spark, tmp_path):
    network = (line(spark), schedule(spark, [("A1", 0, "07:00:00")]))
    # bus 1 falls silent; bus 2 goes on, which moves the watermark past bus 1's timer
    parts = [[ping("1", "07:00:00", 1), ping("2", "07:00:00", 1)],
             [ping("1", "07:00:40", 1), ping("1", "07:00:40", 1)],
             [ping("2", "07:00:50", 2)], [ping("2", "07:01:35", 3)]]
    state = []
    for k in range(len(parts)):
        progress = followed(spark, f"{tmp_path}/feed", f"{tmp_path}/out", f"{tmp_path}/check",
                            parts[k:k + 1], 60, network, late="0 seconds")
        state.append(progress["stateOperators"][0]["customMetrics"].get("numValueStateVars"))
    found = read_sink(spark, f"{tmp_path}/out").orderBy("codBus", "event_s").collect()
    # 07:00:40 re-armed bus 1 until 07:01:40, so it was still known at 07:01:35
    followed(spark, f"{tmp_path}/feed", f"{tmp_path}/out", f"{tmp_path}/check",
             [[ping("1", "07:01:39", 2)]], 60, network, late="0 seconds")
    again = read_sink(spark, f"{tmp_path}/out").filter("codBus = '1'").orderBy("event_s").collect()
    assert [r["passed_sequence"] for r in again] == [None, None, 1]
    assert len(found) == 5
    progress = followed(spark, f"{tmp_path}/feed", f"{tmp_path}/out", f"{tmp_path}/check",
                        [[ping("2", "07:05:00", 4)], [ping("3", "07:10:00", 1)]], 60, network,
                        late="0 seconds")
    # only the last bus, its list and its timer are left
    left = read_sink(spark, f"{tmp_path}/out")
    assert left.filter("codBus = '2' AND speed_mps = 5.5").count() == 2
    assert progress["stateOperators"][0]["numRowsTotal"] <= 6


def test_backlog_in_many_files_equals_replay(spark, tmp_path):
    """A bus whose pings lie unsorted in many files of one batch."""
    network = (line(spark), schedule(spark, [("A1", 0, "07:00:00"), ("A3", 0, "07:20:00")]))
    rng = random.Random(8)
    pings = [ping("1", f"07:{k // 60:02d}:{k % 60:02d}", 1 + k // 100) for k in range(0, 500, 3)]
    pings += rng.sample(pings, 40)
    rng.shuffle(pings)
    columns = ["codBus", "codLinea", "sentido", "lat", "lon", "codParIni", "last_update"]
    raw = spark.createDataFrame(pings, columns).repartition(20)
    feed = f"{tmp_path}/feed"
    raw.write.option("header", True).csv(feed)
    stops, times = network
    known = clean_pings(read_ping_stream(spark, feed), "11")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        run_available(follow_vehicles(chains.enrich(known, stops, times)), f"{tmp_path}/out",
                      f"{tmp_path}/check", output_mode="update")
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    batch = chains.track(chains.enrich(dedup_pings(clean_pings(raw, "11")), stops, times))
    columns = ["event_s", F.round("speed_mps", 6), F.round("predicted_delay_math", 6), "passed_sequence"]
    assert rows(read_sink(spark, f"{tmp_path}/out"), *columns) == rows(batch, *columns)
