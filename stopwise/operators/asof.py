"""As-of matching of instants against the timetable.

Each distinct scheduled time of a stop owns the interval of seconds it answers for.
Intervals of one key do not overlap. While they are few enough to broadcast, a join on (key,
time bucket) with the interval as residual gives at most one match per row. Up to
``PACKED_INTERVALS`` times as many are broadcast packed, a row per key and bucket with its
intervals as short arrays of integers, in which a row looks its own up. Beyond that rows
and intervals are merged: both are sorted by time within their key and stretch of the day, and a
row takes the last interval that began before it, with one row for each interval, and one more
for each stretch that it reaches into.

Buckets and stretches follow the mean length of the intervals, so that a row is compared with a
few of them however dense the timetable is. The denser it is, the more groups there are and the
less they need salt: the salted intervals stay near ``SALTED_ROWS``.

Result column: ``scheduled_s``, seconds after the midnight of the row's own day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.times import same_day_seconds
from ..settings import ASOF_BUCKET_S, BROADCAST_ROWS, DAY_S, SALTS, SCHEDULE_HORIZON_S
from .joins import Dimension, hold, join_dimension

PACKED_INTERVALS = 8    # packed intervals that take the room of one broadcast row
PACKED_BUCKET = 32      # mean number of them in a packed row
STRETCH_S = 3600        # of the day at most, in which the rows of a key are merged together
BUCKET_INTERVALS = 8    # mean number of a key's intervals in a bucket, where they are short
STRETCH_INTERVALS = 256     # the same in a stretch
SALTED_ROWS = 4_000_000     # salted copies of all intervals, unless one copy is more


def _candidates(schedule: DataFrame, by: list[str], service_day: str) -> DataFrame:
    """Distinct scheduled moments per key, relative to the midnight of the probed day."""
    timed = schedule.filter("service_s IS NOT NULL")
    if service_day == "reference":
        moments = timed.select(*by, same_day_seconds("service_s").alias("scheduled_s"))
    elif service_day == "adjacent":
        moments = timed.select(*by, "service_s").distinct().selectExpr(
            *by, f"explode(array(service_s - {DAY_S}, service_s, service_s + {DAY_S})) "
                 "AS scheduled_s")
    else:
        raise ValueError(f"unknown service_day {service_day!r}")
    return moments.distinct()


_LOW = "greatest(own_from, 0D)"
_HIGH = f"least(own_to, own_before, {DAY_S - 0.000001}D)"


def _within_day(intervals: DataFrame) -> DataFrame:
    return intervals.filter(f"{_LOW} <= {_HIGH}")


def _bucketed(intervals: DataFrame, bucket_s: int) -> DataFrame:
    """Repeat each interval once per bucket it touches."""
    return intervals.selectExpr(
        "*", f"explode(sequence(floor({_LOW} / {bucket_s}), floor({_HIGH} / {bucket_s}))) AS bucket")


def _packed(intervals: DataFrame, keys: dict[str, str], value: str, bucket_s: int) -> DataFrame:
    """One row per key and bucket: its intervals in time order, ends in half seconds."""
    ends = ", ".join(f"CAST(2 * {c} AS int) AS {c}" for c in ("own_to", "own_from", "own_before"))
    own = F.array_sort(F.collect_list(F.expr(f"struct({ends}, CAST({value} AS int) AS value)")))
    return (_bucketed(intervals, bucket_s).groupBy(*keys, "bucket").agg(own.alias("_own"))
            .selectExpr(*keys, "bucket", "_own.own_to AS _to", "_own.own_from AS _from",
                        "_own.own_before AS _until", "_own.value AS _value"))


def _unpack(found: DataFrame, kept: list[str], value: str, kind: str, how: str) -> DataFrame:
    """Of the bucket's intervals the first that ends at or after the row, if it owns it."""
    twice = "2D * _second"
    placed = found.selectExpr(*kept, "_to", "_from", "_until", "_value",
                              f"size(filter(_to, t -> t < {twice})) AS _i")
    owned = f"{twice} > get(_from, _i) AND {twice} <= get(_to, _i) AND {twice} < get(_until, _i)"
    out = placed.selectExpr(*kept, f"CASE WHEN {owned} THEN CAST(get(_value, _i) AS {kind}) END AS {value}")
    return out.filter(f"{value} IS NOT NULL") if how == "inner" else out


def nearest_intervals(schedule: DataFrame, by: list[str], *,
                      horizon_s: int | None = SCHEDULE_HORIZON_S,
                      service_day: str = "reference") -> DataFrame:
    """Seconds for which each time is the nearest, strictly within the horizon. A tie
    belongs to the earlier time."""
    over = f"OVER (PARTITION BY {', '.join(by)} ORDER BY scheduled_s)"
    reach = horizon_s if horizon_s is not None else 3 * DAY_S
    owned = _candidates(schedule, by, service_day).selectExpr(
        *by, "scheduled_s",
        f"CAST(greatest((lag(scheduled_s) {over} + scheduled_s) / 2, "
        f"scheduled_s - {reach}) AS double) AS own_from",
        f"CAST(coalesce((scheduled_s + lead(scheduled_s) {over}) / 2, "
        f"scheduled_s + {reach}) AS double) AS own_to",
        f"CAST(scheduled_s + {reach} AS double) AS own_before",
    )
    return _within_day(owned)


def next_intervals(schedule: DataFrame, by: list[str], *, wrap: bool = False,
                   service_day: str = "reference") -> DataFrame:
    """Seconds for which each time is the next one at or after. With ``wrap`` the first
    time of the day, one day later, serves the seconds after the last."""
    times = _candidates(schedule, by, service_day)
    if wrap:
        first = times.groupBy(*by).agg({"scheduled_s": "min"}).selectExpr(
            *by, f"`min(scheduled_s)` + {DAY_S} AS scheduled_s")
        times = times.unionByName(first).distinct()
    over = f"OVER (PARTITION BY {', '.join(by)} ORDER BY scheduled_s)"
    owned = times.selectExpr(
        *by, "scheduled_s",
        f"CAST(coalesce(lag(scheduled_s) {over}, -1) AS double) AS own_from",
        "CAST(scheduled_s AS double) AS own_to",
        f"{2.0 * DAY_S + 1}D AS own_before",
    )
    return _within_day(owned)


def match_schedule(
    facts: DataFrame,
    intervals: DataFrame,
    keys: dict[str, str] | list[str],
    second_of_day: str,
    *,
    how: str = "left",
    salt_on: list[str] | None = None,
    bucket_s: int = ASOF_BUCKET_S,
    max_rows: int = BROADCAST_ROWS,
    salts: int | None = None,
    stretch_s: int | None = None,
) -> DataFrame:
    """Add ``scheduled_s`` of the owning interval, null when no time answers.

    Beyond ``max_rows`` bucketed intervals they are packed, and beyond ``PACKED_INTERVALS`` times
    as many the rows are merged with them, or, on a stream, which cannot be sorted, joined by a
    salted shuffle. Buckets are ``bucket_s`` wide or less.
    """
    if not isinstance(keys, dict):
        keys = {k: k for k in keys}
    salt_on = salt_on or ["codBus", "event_s"]
    facts = facts.selectExpr("*", f"CAST({second_of_day} AS double) AS _second")
    owns = "_second > own_from AND _second <= own_to AND _second < own_before"
    intervals = hold(intervals)
    value = next(c for c in intervals.columns if c not in (*keys, "own_from", "own_to", "own_before"))
    whole = " AND ".join(f"2 * {c} = floor(2 * {c}) AND abs({c}) < 1e9"
                         for c in ("own_from", "own_to", "own_before", value))
    count, owned, packs = intervals.selectExpr(
        "count(*)", f"coalesce(sum({_HIGH} - {_LOW}), 0D)", f"coalesce(every({whole}), true)").first()
    mean_s = owned / max(count, 1)
    wide_s = _width(mean_s, PACKED_BUCKET, 1, bucket_s)
    bucket_s = _width(mean_s, BUCKET_INTERVALS, 1, bucket_s)
    salts = salts or max(1, min(SALTS, SALTED_ROWS // max(count, 1)))
    bucketed = None
    if count <= max_rows or facts.isStreaming and count > PACKED_INTERVALS * max_rows:
        bucketed = Dimension(_bucketed(intervals, bucket_s))
    if (bucketed is None or bucketed.rows > max_rows) and packs and count <= PACKED_INTERVALS * max_rows:
        packed = Dimension(_packed(intervals, keys, value, wide_s))
        if packed.rows <= max_rows:
            kind = intervals.schema[value].dataType.simpleString()
            found = join_dimension(facts, packed, {**keys, "bucket": f"floor(_second / {wide_s})"}, how,
                                   salt_on=salt_on, max_rows=max_rows)
            return _unpack(found, facts.columns, value, kind, how).drop("_second")
    merged = (bucketed is None or bucketed.rows > max_rows) and not facts.isStreaming
    if bucketed is None and not merged:
        bucketed = Dimension(_bucketed(intervals, bucket_s))
    if merged:
        stretch_s = stretch_s or _width(mean_s, STRETCH_INTERVALS, 60, STRETCH_S)
        matched = _merge(facts, intervals, keys, how, salt_on, owns, stretch_s, salts)
    else:
        matched = join_dimension(
            facts, bucketed, {**keys, "bucket": f"floor(_second / {bucket_s})"}, how,
            salt_on=salt_on, condition=owns, max_rows=max_rows, salts=salts)
    return matched.drop("_second", "own_from", "own_to", "own_before")


def _width(mean_s: float, intervals: int, least: int, most: int) -> int:
    """Whole seconds that hold ``intervals`` of the mean length."""
    return min(most, max(least, int(intervals * mean_s)))


def _merge(facts: DataFrame, intervals: DataFrame, keys: dict[str, str], how: str,
           salt_on: list[str], owns: str, stretch_s: int, salts: int) -> DataFrame:
    """The last interval that began before each row, by sorting both within key and stretch.

    An interval stands in its own stretch, and in those after it up to the next interval's as
    far as it reaches. Rows of one key and stretch are dealt out over ``salts`` tasks.
    """
    own = [c for c in intervals.columns if c not in keys]
    names = [f"_key_{k}" for k in keys]
    along = f"OVER (PARTITION BY {', '.join(keys)} ORDER BY own_from)"
    reach = f"least({_HIGH}, coalesce(lead(own_from) {along}, {_HIGH}))"
    placed = intervals.selectExpr("*", f"floor({reach} / {stretch_s}) AS _last").selectExpr(
        *[f"{k} AS _key_{k}" for k in keys], f"struct({', '.join(own)}) AS _own",
        "own_from AS _at", "1 AS _kind",
        f"explode(sequence(floor({_LOW} / {stretch_s}), greatest(_last, floor({_LOW} / {stretch_s})))) "
        "AS _stretch").selectExpr("*", f"explode(sequence(0L, {salts - 1}L)) AS _salt")
    rows = facts.selectExpr(
        *[f"{sql} AS _key_{k}" for k, sql in keys.items()],
        f"struct({', '.join(f'`{c}`' for c in facts.columns)}) AS _row", "_second AS _at", "0 AS _kind",
        f"floor(_second / {stretch_s}) AS _stretch",
        f"pmod(xxhash64({', '.join(salt_on)}), {salts}) AS _salt")
    # a time owns what is strictly after its interval's begin, so rows come before equal begins
    before = Window.partitionBy(*names, "_salt", "_stretch").orderBy("_at", "_kind").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    found = rows.unionByName(placed, allowMissingColumns=True).withColumn(
        "_found", F.last("_own", ignorenulls=True).over(before)).filter("_kind = 0")
    flat = found.selectExpr("_row.*", *(f"_found.{c} AS {c}" for c in own))
    kept = flat.selectExpr(*facts.columns, *(
        f"CASE WHEN {owns} THEN {c} END AS {c}" for c in own))
    return kept.filter("own_from IS NOT NULL") if how == "inner" else kept
