"""Nearest stop of positions that are far from every stop, by a quadtree.

Stops are sorted along a Z-curve of their positions. A node is a run of them that shares the
first bits of its code, with the box around its places in space; it has up to four children and
splits while it has more than ``LEAF_STOPS``. A search goes on from the box that is nearest and
ends when no box can hold a stop as near as the best one, so it visits a few nodes however many
stops there are, and its answer is exact.

Up to ``TREE_STOPS`` stops the tree is broadcast as arrays of nodes, and the search is SQL over
them: at each level a position keeps the boxes whose nearest corner is no farther than the nearest
farthest corner. Beyond that the levels are tables, and the distinct positions go down by joins
in the same way; a stream, which cannot regroup its rows, searches a broadcast tree box by box in
Arrow batches. No group of Spark's ever holds all stops.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.geo import Metric
from ..settings import BROADCAST_ROWS
from .joins import Dimension, hold, join_dimension

LEAF_STOPS = 16
CODE_LEVELS = 24                      # a cell of the finest level is about two metres wide
TREE_STOPS = 20_000                   # stops of a tree in arrays, which go with each far ping
LEVELS = (3, 6, 9, 12, 15, 18)        # levels that are tables when the tree is too large

STOP = ("stop_sequence", "stop_id", "stop_name", "stop_lat", "stop_lon")
STOP_TYPE = ("stop_sequence int, stop_id string, stop_name string, stop_lat double, "
             "stop_lon double")
_AXES = ("x", "y", "z")


def z_codes(lat: np.ndarray, lon: np.ndarray) -> np.ndarray:
    """Row and column of the finest cell, bit by bit in turn."""
    side = 1 << CODE_LEVELS
    y = np.clip(((lat + 90.0) / 180.0 * side).astype(np.int64), 0, side - 1)
    x = np.clip(((lon + 180.0) % 360.0 / 360.0 * side).astype(np.int64), 0, side - 1)
    code = np.zeros(len(lat), np.int64)
    for bit in range(CODE_LEVELS):
        code |= (x >> bit & 1) << 2 * bit | (y >> bit & 1) << 2 * bit + 1
    return code


def build_tree(places: np.ndarray, codes: np.ndarray) -> dict[str, np.ndarray | list]:
    """The nodes over stops that come in the order that decides between equal distances."""
    index = np.argsort(codes, kind="stable")
    places, codes = places[index], codes[index]
    low, high, span, children = [], [], [], []
    todo = [(0, len(codes), CODE_LEVELS, -1)] if len(codes) else []
    while todo:
        first, last, level, parent = todo.pop()
        node = len(span)
        low.append(places[first:last].min(axis=0))
        high.append(places[first:last].max(axis=0))
        span.append((first, last))
        children.append([])
        if parent >= 0:
            children[parent].append(node)
        if last - first <= LEAF_STOPS:
            continue
        while level:        # down to the first level at which the stops part
            level -= 1
            cuts = np.flatnonzero(np.diff(codes[first:last] >> 2 * level)) + first + 1
            if len(cuts):
                edges = [first, *cuts.tolist(), last]
                todo += [(a, b, level, node) for a, b in zip(edges, edges[1:])]
                break
    return {"places": places, "index": index, "low": np.array(low), "high": np.array(high),
            "span": span, "children": children}


def search_tree(tree: dict, place: np.ndarray) -> tuple[int, int]:
    """The nearest stop and the number of nodes visited; equal distances go to the lower index."""
    import heapq

    def squared(gaps):      # summed as the joins do, so that ties are the same
        return gaps[..., 0] * gaps[..., 0] + gaps[..., 1] * gaps[..., 1] + gaps[..., 2] * gaps[..., 2]

    best, seen = (float("inf"), -1), 0
    heap = [(0.0, 0)] if len(tree["span"]) else []
    while heap and heap[0][0] <= best[0]:
        node = heapq.heappop(heap)[1]
        seen += 1
        below = tree["children"][node]
        if below:
            gaps = np.maximum(np.maximum(tree["low"][below] - place, place - tree["high"][below]), 0.0)
            for lower, child in zip(squared(gaps).tolist(), below):
                if lower <= best[0]:
                    heapq.heappush(heap, (lower, child))
            continue
        first, last = tree["span"][node]
        lines = squared(tree["places"][first:last] - place)
        least = lines.min()
        found = int(tree["index"][first:last][lines == least].min())
        best = min(best, (float(least), found)) if best[1] >= 0 else (float(least), found)
    return best[1], seen


def _rank(row) -> tuple:
    return tuple((v is not None, v.encode() if isinstance(v, str) else v or 0)
                 for v in (row[c] for c in STOP))


def _with_place(stops: DataFrame, by: list[str], metric: Metric) -> DataFrame:
    places = [f"{sql} AS {axis}" for axis, sql in zip(_AXES, metric.place("stop_lat", "stop_lon"))]
    return stops.selectExpr(*by, *STOP, *places)


def far_stop(stops: DataFrame, by: list[str], metric: Metric, bound: int = TREE_STOPS,
             **join):
    """A function that adds the nearest stop, as a struct, where a condition holds.

    It takes a frame with ``_x``, ``_y``, ``_z`` and ``by``, the condition as SQL and the name of
    the new column, which is null elsewhere and where no stop shares the values of ``by``.
    """
    placed = _with_place(stops, by, metric).distinct()
    rows = placed.limit(bound + 1).collect()
    if len(rows) > bound:
        return lambda df, where, name: (_visit if df.isStreaming else _descend)(
            df, placed, by, where, name)
    trees = _trees(rows, by)
    return lambda df, where, name: _look_up(df, stops.sparkSession, stops.schema, trees, by,
                                            where, name, **join)


def _trees(rows: list, by: list[str]) -> dict[tuple, dict]:
    groups: dict[tuple, list] = {}
    for row in sorted(rows, key=_rank):
        groups.setdefault(tuple(row[c] for c in by), []).append(row)
    trees = {}
    for key, own in groups.items():
        lat, lon = (np.array([r[c] for r in own], float) for c in ("stop_lat", "stop_lon"))
        trees[key] = build_tree(np.array([[r[a] for a in _AXES] for r in own]),
                                z_codes(lat, lon)) | {"stops": own}
    return trees


# -- a tree in arrays -----------------------------------------------------------------------

_NODE = ("struct<low_x:double,low_y:double,low_z:double,high_x:double,high_y:double,high_z:double,"
         "child:int,n:int,first:int,stops:int>")
_STOP_PLACE = ("struct<x:double,y:double,z:double,stop_sequence:int,stop_id:string,stop_name:string,"
               "stop_lat:double,stop_lon:double>")


def _level_order(tree: dict) -> tuple[list[tuple], int]:
    """The nodes, children side by side, and how many levels lie below the root."""
    order, depth, begins, level = [0], 0, {}, [0]
    while level:
        below = []
        for node in level:
            begins[node] = len(order)
            order += tree["children"][node]
            below += tree["children"][node]
        depth, level = depth + bool(below), below
    nodes = []
    for node in order:
        first, last = tree["span"][node]
        nodes.append((*tree["low"][node].tolist(), *tree["high"][node].tolist(),
                      begins[node], len(tree["children"][node]), first, last - first))
    return nodes, depth


def _look_up(df: DataFrame, spark, schema, trees: dict, by: list[str], where: str, name: str,
             **join) -> DataFrame:
    kept, table, depth = df.columns, [], 0
    for key, tree in trees.items():
        nodes, levels = _level_order(tree)
        depth = max(depth, levels)
        own = [tree["stops"][k] for k in tree["index"]]
        table.append((*key, True, nodes, [tuple(r[c] for c in (*_AXES, *STOP)) for r in own]))
    keys = "".join(f"{c} {schema[c].dataType.simpleString()}, " for c in by)
    arrays = spark.createDataFrame(
        table, f"{keys}far boolean, nodes array<{_NODE}>, stops array<{_STOP_PLACE}>")
    asked = {"far": f"CASE WHEN {where} THEN true END", **{c: c for c in by}}
    joined = join_dimension(df, Dimension(arrays, "size(stops)"), asked,
                            salt_on=["codBus", "event_s"], **join)
    kids = ("flatten(transform(f, i -> if(nodes[i].n > 0, "
            "sequence(nodes[i].child, nodes[i].child + nodes[i].n - 1), array(i))))")
    boxes = (f"transform({kids}, k -> struct(k AS k, ({_gap('nearest', 'nodes[k].')}) * (1 - 1e-9) AS lower, "
             f"({_gap('farthest', 'nodes[k].')}) * (1 + 1e-9) AS upper))")
    step = (f"transform(array({boxes}), b -> transform(filter(b, c -> "
            "c.lower <= array_min(transform(b, u -> u.upper))), c -> c.k))[0]")
    leaves = f"aggregate(sequence(1, {depth}), array(0), (f, r) -> {step})" if depth else "array(0)"
    line = " + ".join(f"(s.{a} - _{a}) * (s.{a} - _{a})" for a in _AXES)
    near = f"flatten(transform({leaves}, i -> slice(stops, nodes[i].first + 1, nodes[i].stops)))"
    best = (f"array_min(transform({near}, s -> struct({line} AS line, "
            f"{', '.join(f's.{c} AS {c}' for c in STOP)})))")
    found = f"CASE WHEN nodes IS NOT NULL AND _x IS NOT NULL AND _y IS NOT NULL THEN {best} END"
    joined = joined.selectExpr(*kept, f"{found} AS _best")
    return joined.selectExpr(*kept, "CASE WHEN _best IS NOT NULL THEN "
                             f"struct({', '.join(f'_best.{c} AS {c}' for c in STOP)}) END AS {name}")


# -- a broadcast tree, box by box ------------------------------------------------------------

def _visit(df: DataFrame, stops: DataFrame, by: list[str], where: str, name: str) -> DataFrame:
    """For streams with more stops than arrays should carry; up to BROADCAST_ROWS of them."""
    rows = stops.limit(BROADCAST_ROWS + 1).collect()
    if len(rows) > BROADCAST_ROWS:
        raise ValueError(f"more than {BROADCAST_ROWS} stops: search a stream's pings per batch")
    shared = stops.sparkSession.sparkContext.broadcast({
        key: tree | {"stops": [tuple(r[c] for c in STOP) for r in tree["stops"]]}
        for key, tree in _trees(rows, by).items()})
    hold(shared)

    @F.arrow_udf(STOP_TYPE)
    def nearest(spots: pa.Array) -> pa.Array:
        known: dict[tuple, tuple | None] = {}
        found = []
        for spot in spots.to_pylist():
            key = tuple(spot.values()) if spot else ()
            if key not in known:
                tree = shared.value.get(key[3:]) if key and None not in key[:3] else None
                at = search_tree(tree, np.array(key[:3]))[0] if tree else -1
                known[key] = tree["stops"][at] if at >= 0 else None
            found.append(known[key])
        kinds = (pa.int32(), pa.string(), pa.string(), pa.float64(), pa.float64())
        return pa.StructArray.from_arrays(
            [pa.array([None if row is None else row[k] for row in found], kind)
             for k, kind in enumerate(kinds)], names=list(STOP),
            mask=pa.array([row is None for row in found], pa.bool_()))

    return df.withColumn(name, nearest(F.when(F.expr(where), F.struct("_x", "_y", "_z", *by))))


# -- a tree of tables ---------------------------------------------------------------------

def _cell(lat: str, lon: str, level: int) -> Column:
    """The cell of a level, as one number."""
    side = 1 << level
    y = f"least(CAST(floor(({lat} + 90D) / 180D * {side}) AS bigint), {side - 1})"
    x = f"least(CAST(floor(pmod({lon} + 180D, 360D) / 360D * {side}) AS bigint), {side - 1})"
    return F.expr(f"{y} * {side} + {x}")


def _parent(cell: str, level: int, above: int) -> str:
    down, side = level - above, 1 << level
    return f"shiftright({cell} DIV {side}, {down}) * {1 << above} + shiftright({cell} % {side}, {down})"


def _gap(corner: str, box: str = "") -> str:
    """Squared distance of a position from the nearest or farthest corner of a box."""
    one = {"nearest": "greatest({b}low_{a} - _{a}, _{a} - {b}high_{a}, 0D)",
           "farthest": "greatest(abs({b}low_{a} - _{a}), abs({b}high_{a} - _{a}))"}[corner]
    return " + ".join(f"pow({one.format(a=a, b=box)}, 2)" for a in _AXES)


def _boxes(stops: DataFrame, by: list[str], level: int, above: int) -> DataFrame:
    boxes = stops.groupBy(*by, _cell("stop_lat", "stop_lon", level).alias("cell")).agg(
        *(F.min(a).alias(f"low_{a}") for a in _AXES), *(F.max(a).alias(f"high_{a}") for a in _AXES))
    return boxes.withColumn("above", F.expr(_parent("cell", level, above)))


def _descend(df: DataFrame, stops: DataFrame, by: list[str], where: str, name: str) -> DataFrame:
    """The search by joins, for stops that are too many to broadcast."""
    spot = ["_x", "_y", "_z", *by]
    # faults repeat: a position is searched once
    frontier = df.filter(where).select(*spot).distinct().withColumn("above", F.lit(0).cast("bigint"))
    before = 0
    for level in LEVELS:
        boxes = _boxes(stops, by, level, before)
        # sums of squares may round differently from the lines they bound
        reached = frontier.join(boxes, [*by, "above"]).selectExpr(
            *spot, "cell", f"({_gap('nearest')}) * (1 - 1e-9) AS lower", f"({_gap('farthest')}) * (1 + 1e-9) AS upper")
        nearest = F.min("upper").over(Window.partitionBy(*spot))
        frontier = reached.withColumn("least", nearest).filter("lower <= least").select(
            *spot, F.col("cell").alias("above"))
        before = level
    own = stops.withColumn("above", _cell("stop_lat", "stop_lon", before))
    line = " + ".join(f"({a} - _{a}) * ({a} - _{a})" for a in _AXES)
    found = frontier.join(own, [*by, "above"]).groupBy(*spot).agg(F.min(F.struct(
        F.expr(line).alias("line"), *STOP)).alias("_best")).select(
        *(F.col(c).alias(f"_at_{c}") for c in spot), F.struct(*(f"_best.{c}" for c in STOP)).alias(name))
    keys = [F.expr(where), *(F.col(c).eqNullSafe(F.col(f"_at_{c}")) for c in spot)]
    return df.join(found, reduce(Column.__and__, keys), "left").drop(*(f"_at_{c}" for c in spot))
