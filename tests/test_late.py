"""Late and repeated rows: every landed row is accepted, late or repeated."""

import random

import pytest
from pyspark.sql import functions as F

from stopwise.session import new_folder
from stopwise.streaming import LateRows, read_sink, run_available
from small import rows

SCHEMA = "codBus string, event_s bigint, lat double, lon double, direction_id int"


def feed(seed, n=6):
    rng = random.Random(seed)
    parts = []
    for k in range(n):
        low = 1000 + 300 * k - rng.choice([0, 0, 900])
        parts.append([(f"b{rng.randrange(6)}", low + 10 * rng.randrange(60), round(rng.random(), 3), 0.0, 0)
                      for _ in range(rng.randrange(0, 80))])
    parts[1].append(("b0", None, 0.5, 0.0, 0))
    return parts


def plain(parts, allowance):
    seen, top, accepted, late, counts = set(), None, [], [], []
    for part in parts:
        mark = None if top is None else top - allowance
        fresh, old, again = {}, [], 0
        for row in sorted(part, key=lambda r: (r[0], r[1] or 0, r[2])):
            if row[1] is None or mark is not None and row[1] < mark:
                old.append(row)
            elif row[:2] in seen or row[:2] in fresh:
                again += 1
            else:
                fresh[row[:2]] = row
        seen |= set(fresh)
        top = max([top or 0, *(k[1] for k in fresh)]) or None
        accepted += fresh.values()
        late += old
        counts.append((len(part), len(fresh), len(old), again))
    return accepted, late, counts


@pytest.mark.parametrize("seed", [1, 2])
def test_accepted_late_and_repeated_make_up_what_landed(spark, tmp_path, seed):
    folder, out, allowance = new_folder(spark, "late"), f"{tmp_path}/out", 400
    parts = feed(seed)
    for part in parts:
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/feed")
        # a split of its own each time: what it knows is in its tables
        run_available(spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/feed"), out, f"{tmp_path}/check",
                      late=LateRows(spark, folder, allowance, buckets=2))
    accepted, late, counts = plain(parts, allowance)
    split = LateRows(spark, folder, allowance, buckets=2)
    got = read_sink(spark, out)
    assert rows(got.drop("batch_id")) == sorted(accepted, key=repr)
    assert rows(read_sink(spark, split.late_path).drop("batch_id")) == sorted(late, key=repr)
    told = split.counts.read().orderBy("batch_id").collect()
    assert [tuple(r)[1:] for r in told] == [c for c in counts if c[0]]
    assert all(r["landed"] == r["accepted"] + r["late"] + r["repeated"] for r in told)
    newest = max(r[1] for r in accepted)
    assert split.seen.read().agg(F.min("event_s")).first()[0] >= newest - 2 * allowance - 900


def test_a_batch_that_runs_again_is_split_alike(spark):
    split = LateRows(spark, new_folder(spark, "late"), 100, buckets=2)
    first = spark.createDataFrame([("a", 1000, 0.1, 0.0, 0), ("a", 1000, 0.2, 0.0, 0)], SCHEMA)
    second = spark.createDataFrame([("a", 1000, 0.3, 0.0, 0), ("a", 800, 0.0, 0.0, 0), ("b", 1500, 0.0, 0.0, 0)], SCHEMA)
    for batch_id, batch, want in ((0, first, ["accepted", "repeated"]), (1, second, ["accepted", "late", "repeated"])):
        for _ in range(2):
            marked, told = split.split(batch, batch_id)
            marked = marked.persist()
            assert sorted(r["state"] for r in marked.collect()) == want
            split.remember(marked.filter("state = 'accepted'").drop("state"), told.get, batch_id)


def test_labelled_rows_are_made_once_for_all_queries_of_the_model(spark, monkeypatch):
    """Range, mean, hold-out and fit read the same rows."""
    from stopwise.plans import catalog
    made = []

    def training(spark, folder):
        made.append(folder)
        return spark.sql("""SELECT timestamp '2024-01-01 06:00:00' + make_interval(0,0,0,0,0,0,id) AS timestamp,
            36.7D AS lat, -4.45D + id / 1000D AS lon, 'A1' AS stop_id, 1 AS stop_sequence, 10D AS distance_m,
            timestamp '2024-01-01 06:05:00' AS scheduled_time, timestamp '2024-01-01 06:04:00' AS actual_time,
            300 - id AS seconds_to_scheduled, CAST(id AS bigint) AS true_delay_seconds FROM range(50)""")

    monkeypatch.setattr(catalog, "_training", training)
    rows = catalog._clean_split(spark, "made-up")
    assert rows.count() == 50 and 0 < rows.filter("is_train").count() < 50
    assert catalog._clean_split(spark, "made-up").count() == 50
    assert made == ["made-up"]
