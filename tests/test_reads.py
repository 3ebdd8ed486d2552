"""What the queries of matched pings read, and how their stop times are compiled."""

import io
import re
from contextlib import redirect_stdout

from pyspark.sql import functions as F

from stopwise.functions.times import service_seconds, two_digits
from stopwise.operators.arrivals import arrivals_by_visit
from stopwise.operators.nearest import nearest_stop

JIT_BYTES = 8000        # the JVM only interprets longer methods


def counted(spark, df):
    """The frame, and how many of its rows were made so far."""
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    return df.mapInArrow(count, df.schema), made


def stops(spark):
    return spark.range(9).selectExpr(
        "CAST(id AS string) AS stop_id", "concat('S', id) AS stop_name", "36.7D + id / 100 AS stop_lat",
        "-4.4D + id / 100 AS stop_lon", "CAST(id AS int) AS stop_sequence")


def pings(spark):
    return spark.range(40).selectExpr(
        "CAST(id % 4 AS string) AS codBus", "1704088800 + 400 * id AS event_s",
        "timestamp_seconds(1704088800 + 400 * id) AS timestamp", "36.7D + (id % 9) / 100 AS lat",
        "-4.4D + (id % 9) / 100 AS lon")


def test_a_made_text_is_read_by_methods_that_are_compiled(spark):
    s = "(id * 45 + id % 10 + 18000)"
    clock = ", ".join(two_digits(p) for p in (f"{s} DIV 3600", f"{s} DIV 60 % 60", f"{s} % 60"))
    made = spark.range(5).selectExpr("id", f"concat_ws(':', {clock}) AS arrival_time")
    early = made.withColumn("service_s", service_seconds("arrival_time")).filter("service_s < 86400")
    text = io.StringIO()
    with redirect_stdout(text):
        early.explain("codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text.getvalue())]
    assert sizes and max(sizes) < JIT_BYTES
    assert [r["service_s"] for r in early.orderBy("id").collect()] == [18000 + 46 * i for i in range(5)]


def test_service_seconds_of_odd_texts(spark):
    want = {"06:05:04": 21904, " 6:5:4 ": 21904, "25:00:00": 90000, "6:05": None, "a:b:c": None, "::": None,
            "1:60:00": None, "1:00:60": None, "1:2:3:4": None, "-1:00:00": None, "": None, "6: 5 :4": 21904,
            "6:5:": None, "6::4": None, "99999999999:0:0": None, None: None}
    df = spark.createDataFrame([(t,) for t in want], "t string").withColumn("s", service_seconds("t"))
    assert {r["t"]: r["s"] for r in df.collect()} == want
    assert dict(df.dtypes)["s"] == "int"


def test_nearest_stop_reads_its_stops_once(spark):
    watched, made = counted(spark, stops(spark))
    got = nearest_stop(pings(spark), watched).select("codBus", "event_s", "stop_id").collect()
    assert len(got) == 40 and made.value == 9


def test_visits_read_matched_pings_once(spark):
    matched = nearest_stop(pings(spark), stops(spark))
    watched, made = counted(spark, matched.select("codBus", "stop_id", "timestamp", "event_s", "distance_m"))
    staged = arrivals_by_visit(watched, staged=True)
    assert sorted(map(tuple, staged.collect())) == sorted(map(tuple, arrivals_by_visit(matched).collect()))
    assert made.value == 40 and staged.count() > 4
    assert staged.agg(F.min("actual_time")).first()[0] is not None
