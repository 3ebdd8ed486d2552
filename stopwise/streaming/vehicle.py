"""Keyed vehicle state on a stream.

Everything that does not depend on the vehicle's past (nearest stop, schedule, model)
is added before the stateful step, and everything that only needs its output (passed
stop, actual delay, errors) after it. Per bus the state has one value (last position,
time, speed, sequence) and one list (the predictions of the past ten minutes), both kept
by RocksDB, so a change of one bus writes that bus only.

A silent bus is forgotten by event time or by the clock. By event time (``clock="event"``)
a timer stands at its last ping plus ``idle_s`` and fires when the watermark passes it. Since
no later ping of the bus can be older than the watermark, the rule is the same as the one
the rows themselves follow: a ping ``idle_s`` or more after the previous one starts afresh.
So the output does not depend on batches, and a replay from history gives the same rows.
By the clock (``clock="processing"``) both states live for ``idle_s`` after the last
input of the bus, repeated pings included.
"""

from __future__ import annotations

import math
from collections import deque
from operator import itemgetter

from pyspark.sql import DataFrame, Row, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor

from ..operators.arrivals import mean_absolute_error
from ..plans.chains import evaluate_arrivals, vehicle_output
from ..settings import DEFAULT_SPEED_MPS, MIN_MOVE_M, MIN_SPEED_MPS, PREDICTION_AGE_S

_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

_LAST = "lat double, lon double, ts bigint, speed double, seq int, route string, timer bigint"
_RECENT = "ts bigint, math double, ml double"

_ADDED = [
    T.StructField("speed_mps", T.DoubleType()),
    T.StructField("seconds_to_scheduled", T.DoubleType()),
    T.StructField("predicted_delay_math", T.DoubleType()),
    T.StructField("passed_sequence", T.IntegerType()),
    T.StructField("recent_math", T.ArrayType(T.DoubleType())),
    T.StructField("recent_ml", T.ArrayType(T.DoubleType())),
]

_ORDER = ["event_s", "lat", "lon", "direction_id"]


def _follower(columns: list[str], default_speed: float, min_move_m: float, min_speed: float,
              age_s: int, idle_s: int | None, clock: str, ewma: bool) -> StatefulProcessor:
    """The processor of one bus. Its class is local, so that workers get it by value and
    need no imports of this package. It works on rows: a bus has too few of them in a batch for
    a table of their own to pay."""

    def metres(lat_a, lon_a, lat_b, lon_b):
        flattening = 1 / 298.257223563
        ecc2 = flattening * (2 - flattening)
        mid = math.radians((lat_a + lat_b) / 2)
        w = 1 - ecc2 * math.sin(mid) ** 2
        normal = 6378137.0 / math.sqrt(w)
        north = normal * (1 - ecc2) / w * math.radians(lat_b - lat_a)
        east = normal * math.cos(mid) * math.radians((lon_b - lon_a + 180.0) % 360.0 - 180.0)
        return math.sqrt(north * north + east * east)

    def next_speed(distance, seconds, speed):
        if ewma:
            step = distance / seconds
            return 0.2 * step + 0.8 * speed if 0.1 < step < 25.0 else speed
        return distance / seconds if distance > min_move_m else speed

    Followed = Row(*columns, *(f.name for f in _ADDED))
    has_route = "route_id" in columns
    used = [*_ORDER, "distance_m", "scheduled_epoch_s", "stop_sequence", "predicted_delay_ml",
            *(["route_id"] if has_route else [])]

    def rank(found):
        """Nulls and NaN come after every number."""
        return [(True, 0) if v is None or v != v else (False, v) for v in found[0][:4]]

    def facts(rows):
        """What is used of each row, and the row's own columns."""
        of = whole = None
        for row in rows:
            if of is None:
                names = row.__fields__
                of = itemgetter(*map(names.index, used))
                whole = itemgetter(*map(names.index, columns))
            yield of(row), whole(row)

    class Follower(StatefulProcessor):
        def init(self, handle):
            life = 1000 * idle_s if idle_s and clock == "processing" else None
            self.handle = handle
            self.last = handle.getValueState("last", _LAST, life)
            self.recent = handle.getListState("recent", _RECENT, life)

        def handleInputRows(self, key, rows, timerValues):
            last = self.last.get()
            if last is not None:
                lat, lon, ts, speed, seq, route, timer = last
                recent = deque(self.recent.get())
            else:
                lat = lon = ts = route = timer = None
                speed, seq, recent = default_speed, -1, deque()
            known = ts
            fresh = (f for f in facts(rows) if known is None or f[0][0] > known)
            for (now, here_lat, here_lon, _, distance, due, stop, ml, *on), own in sorted(fresh, key=rank):
                if ts is not None and now <= ts:
                    continue
                on = on[0] if on else None
                if on != route:         # sequences of two routes do not compare
                    seq, route = -1, on
                if idle_s and ts is not None and now - ts >= idle_s and clock == "event":
                    lat = lon = ts = None
                    speed, seq = default_speed, -1
                    recent.clear()
                if ts is not None:
                    speed = next_speed(metres(lat, lon, here_lat, here_lon), now - ts, speed)
                eta = distance / max(speed, min_speed)
                wait = eta if due is None else float(due - now)
                while recent and now - recent[0][0] >= age_s:
                    recent.popleft()
                arrived = stop > seq >= 0
                yield Followed(*own, speed, wait, eta - wait,
                               seq if arrived else None,
                               [b[1] for b in recent] if arrived else None,
                               [b[2] for b in recent] if arrived else None)
                if arrived:
                    recent.clear()
                recent.append((now, eta - wait, float("nan") if ml is None else ml))
                lat, lon, ts, seq = here_lat, here_lon, now, stop
            if ts is not None and (ts != known or clock == "processing"):
                self._keep((lat, lon, ts, speed, seq, route), timer, recent)

        def _keep(self, last, timer, recent):
            ts = last[2]
            if idle_s and clock == "event" and timer != 1000 * (ts + idle_s):
                if timer is not None:
                    self.handle.deleteTimer(timer)
                timer = 1000 * (ts + idle_s)
                self.handle.registerTimer(timer)
            self.last.update((*last, timer))
            self.recent.put(list(recent))

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            self.last.clear()
            self.recent.clear()
            return iter([])

        def close(self):
            pass

    return Follower()


def follow_vehicles(
    enriched: DataFrame,
    *,
    speed: str = "instant",
    default_speed: float = DEFAULT_SPEED_MPS,
    min_move_m: float = MIN_MOVE_M,
    idle_s: int | None = None,
    clock: str = "event",
) -> DataFrame:
    """Speed, heuristic delay and stop advance per bus on a stream of enriched pings.

    Pings not newer than the last one of their bus are dropped. ``idle_s`` are the seconds
    after which a silent bus is forgotten; None keeps it for good. With ``clock="event"`` the
    stream needs a watermark on ``timestamp``; ``"processing"`` keeps a query over the
    available files from ending before its states have.
    """
    if clock not in ("event", "processing"):
        raise ValueError(f"unknown clock {clock!r}")
    enriched.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", _ROCKSDB)
    if "predicted_delay_ml" not in enriched.columns:
        enriched = enriched.withColumn("predicted_delay_ml", F.lit(None).cast("double"))
    kept = list(enriched.schema.fields)
    follower = _follower([f.name for f in kept], float(default_speed), float(min_move_m),
                         MIN_SPEED_MPS, PREDICTION_AGE_S, idle_s, clock, speed == "ewma")
    mode = "none" if not idle_s else "eventTime" if clock == "event" else "processingTime"
    return enriched.groupBy("codBus").transformWithState(
        follower, T.StructType(kept + _ADDED), "update", mode)


def finish_vehicles(followed: DataFrame, stops: DataFrame, schedule: DataFrame,
                    **options) -> DataFrame:
    """Actual delay and prediction errors of the arrivals a stream has emitted."""
    arrived = evaluate_arrivals(followed, stops, schedule, **options)

    def no_nan(values):
        return F.transform(values, lambda v: F.when(~F.isnan(v), v))

    scored = arrived.withColumns({
        "final_math_error": F.when(F.col("passed_stop_id").isNotNull(), mean_absolute_error(
            F.col("recent_math"), F.col("actual_delay"))),
        "final_ml_error": F.when(F.col("passed_stop_id").isNotNull(), mean_absolute_error(
            no_nan(F.col("recent_ml")), F.col("actual_delay"))),
    })
    return vehicle_output(scored)
