"""Registered queries: every operator over the fixture views."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.geo import geodistance_m, haversine_m
from ..functions.labels import delay_status, delay_status_3way, display_delay
from ..functions.times import calendar_features, service_seconds
from ..operators import arrivals, board as live, clean, evaluate, model, nearest
from ..operators import position, timetable as tt, training
from ..operators.joins import join_dimension
from ..session import new_folder, stage
from ..settings import LINE
from ..sources import (load_model, read_live_status, read_ping_history, read_ping_stream,
                       read_timetable, save_model, write_table)
from ..sources.pings import FEED_HEADER
from ..streaming import (KeptTable, LateRows, finish_vehicles, follow_vehicles, newest, read_sink,
                         run_available, totals)
from ..streaming.ingest import clean_stream, dedup_stream
from . import chains, fixtures

Query = Callable[[SparkSession, str], DataFrame]

_ALL: dict[str, Query] = {}

DATE = "20240101"

_MODELS: dict[tuple[str, str], str] = {}      # saved models of this application, by folder
_SPLITS: dict[tuple[str, str], DataFrame] = {}      # its labelled rows, written once by folder


def query(fn: Query) -> Query:
    _ALL[fn.__name__] = fn
    return fn


def queries() -> dict[str, Query]:
    return dict(_ALL)


def shown(df: DataFrame, **digits: int) -> DataFrame:
    """Round doubles and write timestamps as text, so that results compare exactly."""
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.DoubleType) and f.name not in ("lat", "lon"):
            c = F.round(c, digits.get(f.name, 3)) + 0.0
        elif isinstance(f.dataType, T.TimestampType):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        out.append(c.alias(f.name))
    return df.select(*out)


_DEGREES = {c: 6 for c in ("stop_lat", "stop_lon", "next_stop_lat", "next_stop_lon",
                           "next_lat", "next_lon")}


_TEXTS = ("arrival_time", "trip_headsign")      # of a schedule; no lookup made from it reads them


def _schedule(spark: SparkSession, sf: str) -> DataFrame:
    return tt.schedule_master(fixtures.timetable(spark, sf), LINE)


def _line(spark: SparkSession, sf: str) -> DataFrame:
    """The line's schedule, written once for the queries that take several tables from it."""
    return stage(_schedule(spark, sf).drop(*_TEXTS), "schedule")


def _single(spark: SparkSession, sf: str) -> DataFrame:
    return clean.dedup_pings(fixtures.pings(spark, sf))


def _matched(spark: SparkSession, sf: str, schedule: DataFrame | None = None) -> DataFrame:
    schedule = schedule if schedule is not None else _schedule(spark, sf)
    stops = tt.route_stops(tt.schedule_valid(schedule)).drop("direction_id").distinct()
    return nearest.match_snapshots(fixtures.pings(spark, sf), stops)


def _enriched(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    schedule = _line(spark, sf)
    stops = tt.route_geometry(schedule)
    return chains.enrich(_single(spark, sf), stops, schedule), stops, schedule


def _tracked(spark: SparkSession, sf: str) -> DataFrame:
    return chains.track(_enriched(spark, sf)[0])


def _arrived(spark: SparkSession, sf: str) -> DataFrame:
    enriched, stops, schedule = _enriched(spark, sf)
    return chains.evaluate_arrivals(chains.track(enriched), stops, schedule)


def _training(spark: SparkSession, sf: str, schedule: DataFrame | None = None) -> DataFrame:
    schedule = schedule if schedule is not None else _line(spark, sf)
    return chains.training_set(_matched(spark, sf, schedule), schedule)


# --- sources and cleaning ---------------------------------------------------------------

_PING = ("codBus", "codLinea", "direction_id", "lat", "lon", "codParIni", "last_update",
         "timestamp", "event_s")


@query
def clean_pings(spark, sf):
    return shown(fixtures.pings(spark, sf).select(*_PING))


@query
def dedup_pings(spark, sf):
    return _single(spark, sf).select("codBus", "event_s", "lat", "lon", "direction_id")


@query
def ping_history(spark, sf):
    """Snapshots in the feed's order of columns, half of them in its older spelling."""
    raw, folder = fixtures.gps_raw(spark, sf).select(*FEED_HEADER), new_folder(spark, "history")
    older = F.col("last_update") < "2024-01-01 06:20:00"
    write_table(raw.filter(~older), f"{folder}/new", "csv")
    write_table(raw.filter(older).withColumnsRenamed(
        {"lat": "latitud", "lon": "longitud", "codLinea": " codlinea"}), f"{folder}/old", "csv")
    read = read_ping_history(spark, [f"{folder}/new/*.csv", f"{folder}/old/*.csv"])
    return shown(clean.clean_pings(read, LINE).select(*_PING))


@query
def timetable_scan(spark, sf):
    made, folder = fixtures.timetable(spark, sf), new_folder(spark, "timetable")
    for name in ("stops", "trips", "stop_times"):
        write_table(getattr(made, name), f"{folder}/{name}.csv", "csv")
    read = read_timetable(spark, folder, with_calendar=False)
    return (read.stop_times.join(read.trips, "trip_id")
            .select("trip_id", "route_id", "service_id", "direction_id", "trip_headsign",
                    "stop_id", "stop_sequence", "arrival_time"))


@query
def sink_roundtrip(spark, sf):
    status = _live(spark, sf)
    path = write_table(status, new_folder(spark, "status"), partition_by=("direction_id",))
    return shown(read_live_status(spark, path).select(*status.columns))


@query
def latest_ping(spark, sf):
    return live.latest_ping(fixtures.pings(spark, sf)).select(
        "codBus", "event_s", "lat", "lon", "direction_id")


@query
def calendar_features_(spark, sf):
    return fixtures.pings(spark, sf).select(
        "codBus", "event_s", *[c.alias(n) for n, c in
                               calendar_features("timestamp").items()])


# --- timetable --------------------------------------------------------------------------

@query
def active_services(spark, sf):
    return tt.active_services(fixtures.calendar_dates(spark, sf), DATE)


@query
def active_trips(spark, sf):
    return tt.active_trips(fixtures.trips(spark, sf), fixtures.calendar_dates(spark, sf), DATE)


@query
def active_trips_fallback(spark, sf):
    return tt.active_trips(fixtures.trips(spark, sf), fixtures.calendar_dates(spark, sf),
                           "20250101")


@query
def line_trips(spark, sf):
    return tt.line_trips(fixtures.trips(spark, sf), LINE)


@query
def schedule_master(spark, sf):
    return shown(_schedule(spark, sf).drop("service_s"), **_DEGREES)


@query
def schedule_distinct(spark, sf):
    return tt.schedule_distinct(_schedule(spark, sf))


@query
def schedule_valid(spark, sf):
    return tt.schedule_valid(_schedule(spark, sf)).select(
        "trip_id", "stop_id", "stop_sequence", "arrival_time")


@query
def schedule_times(spark, sf):
    return tt.schedule_times(_schedule(spark, sf))


@query
def schedule_arrays(spark, sf):
    """Times as one text per stop and direction, each with its number of trips."""
    one = F.transform("times", lambda t: F.concat(t["arrival_time"], F.lit("x"),
                                                  t["n_trips"].cast("string")))
    return tt.schedule_arrays(_schedule(spark, sf)).withColumn("times", F.array_join(one, " "))


@query
def service_seconds_(spark, sf):
    return (fixtures.stop_times(spark, sf).select("arrival_time").distinct()
            .withColumn("service_s", service_seconds("arrival_time")))


@query
def route_geometry(spark, sf):
    return shown(tt.route_geometry(_schedule(spark, sf))
                 .orderBy("direction_id", "stop_sequence"), **_DEGREES)


@query
def route_stops(spark, sf):
    return shown(tt.route_stops(_schedule(spark, sf)), **_DEGREES)


@query
def headsigns(spark, sf):
    return tt.headsigns(tt.line_trips(fixtures.trips(spark, sf), LINE))


@query
def line_stop_names(spark, sf):
    return tt.line_stop_names(_schedule(spark, sf))


@query
def stop_timetable(spark, sf):
    return (tt.stop_timetable(_schedule(spark, sf), "Nation_2")
            .withColumn("times", F.array_join("times", " ")))


@query
def stop_neighbours(spark, sf):
    return tt.stop_neighbours(tt.route_stops(_schedule(spark, sf))).select(
        "direction_id", "stop_sequence", "previous_stop_id", "after_stop_id")


# --- space ------------------------------------------------------------------------------

def _first_stop_distance(spark, sf, metric):
    stops = fixtures.stops(spark, sf).select("stop_id", "stop_lat", "stop_lon")
    own = (F.col("codParIni").try_cast("int") - 100).cast("string")
    pairs = join_dimension(fixtures.pings(spark, sf).withColumn("_stop", own), stops,
                           {"stop_id": "_stop"}, "inner", salt_on=["codBus", "event_s"])
    distance = metric("lat", "lon", "stop_lat", "stop_lon")
    return shown(pairs.select("codBus", "event_s", "lat", "lon", F.col("_stop").alias("stop_id"),
                              distance.alias("distance_m")))


@query
def haversine(spark, sf):
    """Distance of each ping to the stop its line starts at."""
    return _first_stop_distance(spark, sf, haversine_m)


@query
def geodistance(spark, sf):
    return _first_stop_distance(spark, sf, geodistance_m)


@query
def nearest_stop(spark, sf):
    return shown(_matched(spark, sf).select("codBus", "timestamp", "lat", "lon", "stop_id",
                                            "stop_name", "stop_sequence", "distance_m"))


@query
def nearest_stop_dir(spark, sf):
    stops = tt.with_direction_fallback(tt.route_geometry(_schedule(spark, sf)))
    return shown(nearest.nearest_stop(_single(spark, sf), stops, by=["direction_id"]).select(
        "codBus", "event_s", "direction_id", "stop_id", "stop_sequence", "distance_m"))


@query
def nearest_stop_far(spark, sf):
    """Faulty positions, at (0, 0) or on another continent: none is near a stop."""
    fault = "event_s % 3 = 0"
    faulty = fixtures.pings(spark, sf).selectExpr(
        "codBus", "event_s", f"if({fault}, 0D, lat - 60D) AS lat", f"if({fault}, 0D, lon + 120D) AS lon")
    found = nearest.nearest_stop(faulty.distinct(), tt.route_stops(_line(spark, sf))
                                 .drop("direction_id").distinct())
    return shown(found.select("codBus", "event_s", "lat", "lon", "stop_id", "distance_m"))


@query
def nearest_stop_grid(spark, sf):
    """Every line against every stop of the network, one row per distinct position."""
    pings = fixtures.pings(spark, sf, None).select(
        "codBus", "codLinea", "event_s", "lat", "lon").distinct()
    stops = fixtures.stops(spark, sf).withColumn("stop_sequence", F.lit(0))
    return shown(nearest.nearest_stop(pings, stops).select(
        "codBus", "codLinea", "event_s", "lat", "lon", "stop_id", "distance_m"))


@query
def route_position(spark, sf):
    pings = fixtures.pings(spark, sf).dropDuplicates(["codBus", "event_s", "lat", "lon"])
    return shown(position.route_position(pings, tt.route_stops(_schedule(spark, sf))).select(
        "codBus", "event_s", "lat", "lon", "direction_id", "current_stop_id",
        "current_stop_name", "stop_sequence", "next_stop_id", "next_stop_name", "distance_m"))


# --- time -------------------------------------------------------------------------------

@query
def asof_nearest(spark, sf):
    return _enriched(spark, sf)[0].select("codBus", "event_s", "stop_id", "direction_id",
                                          "scheduled_epoch_s", "scheduled_time")


def _upcoming(enriched: DataFrame) -> DataFrame:
    wait = F.coalesce(F.col("scheduled_epoch_s") - F.col("event_s"), F.lit(0)).cast("double")
    return enriched.select("codBus", "event_s", "stop_id", "direction_id",
                           wait.alias("seconds_to_scheduled"),
                           F.col("scheduled_time").alias("scheduled_arrival"))


@query
def asof_next(spark, sf):
    schedule = _line(spark, sf)
    return _upcoming(chains.enrich(_single(spark, sf), tt.route_geometry(schedule), schedule,
                                   upcoming=True))


@query
def true_delay(spark, sf):
    schedule = _line(spark, sf)
    found = arrivals.arrivals_by_radius(_matched(spark, sf, schedule))
    return shown(training.true_delay(found, schedule))


def _live(spark: SparkSession, sf: str) -> DataFrame:
    schedule = _line(spark, sf)
    return live.live_status(live.latest_ping(fixtures.pings(spark, sf)),
                            tt.route_stops(schedule), schedule)


@query
def live_status(spark, sf):
    return shown(_live(spark, sf))


@query
def seconds_to_scheduled(spark, sf):
    return _live(spark, sf).select("codBus", (
        F.unix_seconds("next_scheduled_time") - F.unix_seconds("timestamp"))
        .alias("seconds_to_scheduled"))


# --- motion and arrivals ----------------------------------------------------------------

@query
def speed_instant(spark, sf):
    return shown(_tracked(spark, sf).select("codBus", "event_s", "speed_mps"))


@query
def speed_ewma(spark, sf):
    tracked = chains.track(_enriched(spark, sf)[0], speed="ewma")
    return shown(tracked.select("codBus", "event_s", "speed_mps"))


@query
def heuristic_delay(spark, sf):
    return shown(_tracked(spark, sf).select("codBus", "event_s", "seconds_to_scheduled",
                                            "predicted_delay_math", "has_schedule"))


@query
def delay_status_(spark, sf):
    delay = F.col("predicted_delay_math")
    return (_tracked(spark, sf).select(delay_status(delay).alias("status"),
                                       delay_status_3way(delay).alias("status_3way"))
            .groupBy("status", "status_3way").agg(F.count("*").alias("pings")))


@query
def display_delay_(spark, sf):
    """Both display modes, with half the heuristic standing in for the model at even stops."""
    heuristic = F.col("predicted_delay_math")
    ml = F.when(F.col("stop_sequence") % 2 == 0, heuristic / 2)
    return shown(_tracked(spark, sf).select(
        "codBus", "event_s",
        display_delay("machine_learning", heuristic, ml).alias("delay_machine_learning"),
        display_delay("heuristic", heuristic, ml).alias("delay_heuristic")))


@query
def arrivals_radius(spark, sf):
    return shown(arrivals.arrivals_by_radius(_matched(spark, sf)))


@query
def arrivals_visit(spark, sf):
    return shown(arrivals.arrivals_by_visit(_matched(spark, sf), staged=True))


@query
def arrivals_seq(spark, sf):
    return (_tracked(spark, sf).filter(F.col("passed_sequence").isNotNull())
            .select("codBus", "event_s", "passed_sequence", "stop_sequence"))


@query
def arrival_backproject(spark, sf):
    return shown(_arrived(spark, sf).filter(F.col("passed_sequence").isNotNull())
                 .select("codBus", "event_s", "passed_stop_id", "arrival_s"))


@query
def actual_delay(spark, sf):
    return shown(_arrived(spark, sf).filter(F.col("passed_sequence").isNotNull())
                 .select("codBus", "event_s", "passed_stop_id", "actual_delay"))


@query
def vehicle_replay(spark, sf):
    return shown(chains.vehicle_replay(*_enriched(spark, sf)), **_DEGREES)


@query
def arrival_mae(spark, sf):
    replayed = chains.vehicle_replay(*_enriched(spark, sf))
    return shown(replayed.filter(F.col("final_math_error") >= 0).select(
        F.col("bus_id").alias("codBus"),
        F.unix_seconds(F.to_timestamp("last_update")).alias("event_s"), "final_math_error"))


@query
def mae_summary(spark, sf):
    replayed = chains.vehicle_replay(*_enriched(spark, sf))
    return shown(evaluate.mae_summary(replayed, {"heuristic": "final_math_error"}))


def _board(vehicles: DataFrame, spark, sf) -> DataFrame:
    newest = live.latest_ping(
        vehicles.withColumn("codBus", F.col("bus_id"))
        .withColumn("event_s", F.unix_seconds(F.to_timestamp("last_update"))))
    return live.board(newest, tt.headsigns(tt.line_trips(fixtures.trips(spark, sf), LINE)))


@query
def board(spark, sf):
    return shown(_board(chains.vehicle_replay(*_enriched(spark, sf)), spark, sf), **_DEGREES)


# --- the network ------------------------------------------------------------------------

def _network(spark: SparkSession, sf: str) -> DataFrame:
    """The schedule of all lines at once, written once."""
    return stage(tt.network_schedule(fixtures.timetable(spark, sf)).drop(*_TEXTS), "network")


def _network_pings(spark: SparkSession, sf: str) -> DataFrame:
    return tt.with_route(fixtures.pings(spark, sf, None))


@query
def schedule_stopless(spark, sf):
    """Stop times of all lines where the timetable describes every second stop only."""
    known = fixtures.timetable(spark, sf)
    known = replace(known, stops=known.stops.filter("CAST(stop_id AS int) % 2 = 0"))
    return tt.network_schedule(known, keep_stopless=True).select(
        "trip_id", "route_id", "direction_id", "stop_id", "stop_sequence", "stop_name")


@query
def trip_patterns(spark, sf):
    return tt.trip_patterns(tt.network_schedule(fixtures.timetable(spark, sf)))


@query
def route_geometry_all(spark, sf):
    return shown(tt.route_geometry(tt.network_schedule(fixtures.timetable(spark, sf))), **_DEGREES)


@query
def live_status_all(spark, sf):
    schedule = _network(spark, sf)
    return shown(live.live_status(live.latest_ping(_network_pings(spark, sf)),
                                  tt.route_stops(schedule), schedule))


@query
def vehicle_replay_all(spark, sf):
    schedule = _network(spark, sf)
    stops = tt.route_geometry(schedule)
    pings = clean.dedup_pings(_network_pings(spark, sf))
    return shown(chains.vehicle_replay(chains.enrich(pings, stops, schedule), stops, schedule),
                 **_DEGREES)


@query
def stream_vehicles_all(spark, sf):
    """The vehicle stream over every line; a bus keeps to the stops of its route."""
    schedule = _network(spark, sf)
    stops = tt.route_geometry(schedule)

    def build(raw):
        known = tt.with_route(clean_stream(raw))
        return finish_vehicles(follow_vehicles(chains.enrich(known, stops, schedule)), stops, schedule)

    return shown(_run_feed(spark, sf, build, output_mode="update").drop(
        "predicted_delay_ml", "final_ml_error"), **_DEGREES)


# --- training and model -----------------------------------------------------------------

@query
def label_window(spark, sf):
    schedule = _line(spark, sf)
    matched = _matched(spark, sf, schedule)
    delays = training.true_delay(arrivals.arrivals_by_radius(matched), schedule)
    return shown(training.label_window(matched, delays).select(
        "codBus", "timestamp", "stop_id", "stop_sequence", "actual_time",
        "true_delay_seconds"))


@query
def training_set(spark, sf):
    return shown(_training(spark, sf))


@query
def train_clean(spark, sf):
    return shown(training.clean_training(_training(spark, sf)).select(
        "timestamp", "lat", "lon", "stop_id", "stop_sequence", "distance_m", "hour", "minute",
        "weekday", "time_of_day", "seconds_to_scheduled", "true_delay_seconds"))


def _row_key():
    text = "yyyy-MM-dd HH:mm:ss"
    return F.concat_ws("|", F.date_format("timestamp", text), "stop_id",
                       F.date_format("actual_time", text),
                       F.round(F.col("lat") * 1000000).cast("bigint").cast("string"))


@query
def split_counts(spark, sf):
    return (training.hash_split(_training(spark, sf), _row_key())
            .groupBy("is_train").agg(F.count("*").alias("n_rows"),
                                     F.sum("true_delay_seconds").alias("sum_delay")))


def _clean_split(spark, sf, schedule=None):
    """Labelled rows of a data folder with their side of the split, written once.

    ``schedule`` is the line's, of a query that has written it already.
    """
    key = (spark.sparkContext.applicationId, sf)
    if key not in _SPLITS:
        given = () if schedule is None else (schedule,)
        _SPLITS[key] = stage(training.hash_split(
            training.clean_training(_training(spark, sf, *given)), _row_key()), "labelled")
    return _SPLITS[key]


def _model(spark, sf, schedule=None):
    """The delay model of a data folder, fitted once on all its training rows, saved and loaded from
    there on."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _MODELS:
        rows = _clean_split(spark, sf, schedule).filter("is_train")
        _MODELS[key] = save_model(model.fit_delay_model(rows), new_folder(spark, "model"))
    return load_model(_MODELS[key])


@query
def score_batch(spark, sf):
    return model.score_live_status(_live(spark, sf), _model(spark, sf))


def _in_range(spark, sf, column: str):
    """A forest averages labels of its training rows, so it stays between them."""
    low, high = _clean_split(spark, sf).filter("is_train").agg(
        F.min(model.LABEL), F.max(model.LABEL)).first()
    return F.coalesce(F.col(column).between(low, high), F.lit(False))


@query
def score_batch_keys(spark, sf):
    """The rows of ``score_batch``, with whether each prediction is one of a fitted forest."""
    return shown(score_batch(spark, sf).select(
        "codBus", "timestamp", "stop_sequence", "seconds_to_scheduled",
        _in_range(spark, sf, "predicted_delay_seconds").alias("in_range")))


@query
def model_metrics(spark, sf):
    """Hold-out error of the forest."""
    held_out = model.score(_clean_split(spark, sf).filter("NOT is_train"), _model(spark, sf))
    return evaluate.mae_rmse(held_out, F.col(model.LABEL), F.col("predicted_delay_seconds"))


@query
def feature_importance(spark, sf):
    return model.feature_importance(_model(spark, sf))


@query
def feature_importance_sum(spark, sf):
    """Importances are shares: none below 0, together 1."""
    return feature_importance(spark, sf).agg(
        F.count("*").alias("n_features"), F.round(F.sum("importance"), 6).alias("total"),
        (F.min("importance") >= 0).alias("all_shares"))


@query
def model_metrics_bounds(spark, sf):
    """The hold-out error beside that of the mean label of the training rows."""
    rows = _clean_split(spark, sf)
    mean = rows.filter("is_train").agg(F.avg(model.LABEL)).first()[0]
    scored = model.score(rows.filter("NOT is_train"), _model(spark, sf))
    label = F.col(model.LABEL)
    mean_miss = F.avg(F.abs(label - F.lit(mean)))
    return shown(scored.agg(
        F.count("*").alias("n_rows"), F.sum(F.abs(label)).alias("sum_abs_delay"),
        mean_miss.alias("mean_label_mae"),
        (F.avg(F.abs(label - F.col("predicted_delay_seconds"))) < mean_miss).alias("beats_mean")))


@query
def metric_mae_rmse(spark, sf):
    made = _arrived(spark, sf).filter(F.col("passed_sequence").isNotNull())
    return shown(evaluate.mae_rmse(made, F.col("actual_delay"), F.col("predicted_delay_math")))


@query
def metric_mape(spark, sf):
    made = _arrived(spark, sf).filter(F.col("passed_sequence").isNotNull())
    return shown(evaluate.mape(made, F.col("actual_delay"), F.col("predicted_delay_math")))


# --- streams ----------------------------------------------------------------------------

EARLY = "2024-01-01 06:20:00"       # the feed lands in two parts, cut here


def _run_feed(spark, sf, build, fmt="csv", keep=None, **options) -> DataFrame:
    """Land the feed in two parts, running the stream after each, and read its sink.

    With ``keep``, which makes a kept table and what goes into it from a folder and the
    stream, there is no history and the table is read.

    Both parts are taken from pings that are written once, and the second run goes on with the
    stream of the first, whose lookups are held.
    """
    feed, out = new_folder(spark, "feed"), new_folder(spark, "sink")
    raw = stage(fixtures.gps_raw(spark, sf).select(*FEED_HEADER), "raw")   # lon before lat, as the feed
    early, table, made = F.col("last_update") < EARLY, None, None
    for part in (early, ~early):
        raw.filter(part).write.mode("append").format(fmt).option("header", True).save(feed)
        if made is None:
            made = build(read_ping_stream(spark, feed, fmt))
        if keep:
            table, rows = keep(out, made)
            options["keep"] = [(table, rows)]
        run_available(made, None if keep else out, f"{out}-checkpoint", **options)
    return table.read() if keep else read_sink(spark, out).drop("batch_id")


@query
def stream_ping_csv(spark, sf):
    return shown(_run_feed(spark, sf, lambda raw: clean_stream(raw, LINE)).select(*_PING))


@query
def stream_ping_json(spark, sf):
    columns = [c for c in _PING if c != "codParIni"]
    return shown(_run_feed(spark, sf, lambda raw: clean_stream(raw, LINE), "json")
                 .select(*columns))


@query
def stream_dedup(spark, sf):
    once = _run_feed(spark, sf, lambda raw: dedup_stream(clean_stream(raw, LINE)))
    return shown(once.select("codBus", "timestamp"))


@query
def stream_late(spark, sf):
    """What becomes of the rows when the later part of the feed lands first."""
    feed, out = new_folder(spark, "feed"), new_folder(spark, "sink")
    raw = fixtures.gps_raw(spark, sf).select(*FEED_HEADER)
    split = LateRows(spark, new_folder(spark, "late"), 600)
    early = F.col("last_update") < EARLY
    for part in (~early, early):
        raw.filter(part).write.mode("append").option("header", True).csv(feed)
        run_available(clean_stream(read_ping_stream(spark, feed), LINE), out, f"{out}-checkpoint",
                      late=split)
    late = read_sink(spark, split.late_path).select("codBus", "event_s", F.lit("late").alias("state"))
    return read_sink(spark, out).select("codBus", "event_s", F.lit("accepted").alias("state")).unionByName(late)


@query
def stream_enrich(spark, sf):
    schedule = _line(spark, sf)
    stops = tt.route_geometry(schedule)
    out = _run_feed(spark, sf, lambda raw: chains.enrich(
        clean_stream(raw, LINE), stops, schedule, upcoming=True))
    return _upcoming(clean.dedup_pings(out))


@query
def stream_score(spark, sf):
    schedule = _line(spark, sf)
    stops, fitted = tt.route_geometry(schedule), _model(spark, sf, schedule)
    out = _run_feed(spark, sf, lambda raw: chains.score_enriched(
        chains.enrich(clean_stream(raw, LINE), stops, schedule), fitted))
    return out.select("codBus", "timestamp", "stop_sequence", "predicted_delay_ml")


@query
def stream_score_keys(spark, sf):
    """The rows of ``stream_score``, with whether each prediction is one of a fitted forest."""
    return stream_score(spark, sf).groupBy("codBus", "timestamp").agg(
        F.min("stop_sequence").alias("stop_sequence"),
        F.min(_in_range(spark, sf, "predicted_delay_ml")).alias("in_range")).withColumn(
        "timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"))


@query
def stream_microbatch(spark, sf):
    """Live status of the buses of each micro-batch; either part of the feed is one."""
    schedule = _line(spark, sf)
    stops = tt.route_stops(schedule)
    return shown(_run_feed(spark, sf, lambda raw: clean_stream(raw, LINE),
                           step=lambda batch: live.live_status(live.latest_ping(batch), stops,
                                                               schedule)))


def _run_vehicles(spark, sf, keep=None) -> DataFrame:
    schedule = _line(spark, sf)
    stops = tt.route_geometry(schedule)

    def build(raw):
        followed = follow_vehicles(chains.enrich(clean_stream(raw, LINE), stops, schedule))
        return finish_vehicles(followed, stops, schedule)

    return _run_feed(spark, sf, build, keep=keep, output_mode="update")


@query
def stream_vehicle_state(spark, sf):
    return shown(_run_vehicles(spark, sf).drop("predicted_delay_ml", "final_ml_error"),
                 **_DEGREES)


IDLE_S = 60


@query
def stream_timeout(spark, sf):
    """Vehicle state that event time expires: after a silence of a minute a bus starts afresh."""
    schedule = _line(spark, sf)
    stops = tt.route_geometry(schedule)

    def build(raw):
        known = clean_stream(raw, LINE).withWatermark("timestamp", "10 minutes")
        return follow_vehicles(chains.enrich(known, stops, schedule), idle_s=IDLE_S)

    return shown(_run_feed(spark, sf, build, output_mode="update").select(
        "codBus", "event_s", "speed_mps", "predicted_delay_math", "passed_sequence"))


@query
def stream_mae(spark, sf):
    """Running errors, folded into one row per predictor with each batch."""

    def keep(folder, made):
        errors = {"heuristic": "final_math_error"}
        table = KeptTable(spark, folder, evaluate.ERROR_SUMS, ["predictor"],
                          totals(["predictor"], ["samples", "error_sum"]), buckets=1)
        return table, lambda batch: evaluate.error_sums(batch, errors)

    return shown(evaluate.mean_errors(_run_vehicles(spark, sf, keep)))


@query
def stream_board(spark, sf):
    """The board from a table that keeps each bus's newest row."""

    def keep(folder, made):
        table = KeptTable(spark, folder, made.schema, ["bus_id"],
                          newest(["bus_id"], ["last_update", "lat", "lon"]))
        return table, lambda batch: batch

    return shown(_board(_run_vehicles(spark, sf, keep), spark, sf), **_DEGREES)


for _name in ("calendar_features_", "service_seconds_", "delay_status_", "display_delay_"):
    _ALL[_name.rstrip("_")] = _ALL.pop(_name)
