"""Hard negatives against scoring every pair in plain Python."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F, types as T

from stopwise.llm import hard_negatives as hn

SCHEMA = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())),
    T.StructField("label", T.LongType()), T.StructField("row", T.StringType()),
    T.StructField("rank", T.StringType()), T.StructField("bucket", T.StringType())])
LONG = (1 << 63) - 1


def frame(spark, rows):
    return spark.createDataFrame([(*r, "row", "rank", "bucket") for r in rows], SCHEMA).repartition(3)


def plain(rows, scale=256.0, positives=5, negatives=3, low=50, high=95):
    """(anchor, positive, rank, negative, scores) by scoring all pairs; ties only by vec_id."""
    own = [(i, v, [math.floor(min(max(x * scale, -1e300), 1e300)) for x in e], lab)
           for i, (v, e, lab) in enumerate(rows)
           if lab is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)]
    order = lambda x: (-x[0], x[1] is None, x[1] or 0)
    out = []
    for i, v, e, lab in own:
        if v is None or v % 50:
            continue
        scored = [(max(-LONG, min(LONG, sum(a * b for a, b in zip(e, f)))), w, k, m)
                  for k, w, f, m in own if k != i]
        best = sorted((x for x in scored if x[3] == lab), key=order)[:positives]
        for p in best:
            fit = sorted((x for x in scored if x[3] != lab and low * p[0] <= 100 * x[0] <= high * p[0]),
                         key=order)[:negatives]
            out += [(v, p[1], k, x[1], p[0], x[0]) for k, x in enumerate(fit, 1)]
    return sorted(out, key=str)


def mined(spark, rows, **options):
    got = hn.mine(frame(spark, rows), F.col("vec_id") % 50 == 0, **options)
    return sorted((tuple(r)[:6] for r in got.collect()), key=str)


def vectors(n, dim, seed, labels=4, spread=0.3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(labels, dim))
    out = []
    for k in range(n):
        label = int(rng.integers(labels))
        x = centres[label] * spread + rng.normal(size=dim) * 0.2
        out.append((k, (x / np.linalg.norm(x)).tolist(), label))
    return out


@pytest.mark.parametrize("dim", [1, 8, 64, 70])
def test_against_all_pairs(spark, dim):
    rows = vectors(600, dim, dim)
    assert mined(spark, rows, row_block=50, anchor_block=4) == plain(rows)


def test_block_sizes_do_not_change_rows(spark):
    rows = vectors(500, 64, 9, labels=40)
    want = plain(rows)
    assert mined(spark, rows) == want
    assert mined(spark, rows, row_block=7, anchor_block=1) == want


def test_edge_rows(spark):
    rows = vectors(120, 16, 1, labels=3)
    rows += [(200, None, 1), (250, [1.0, None], 1), (300, [math.nan] * 16, 1), (350, [math.inf] * 16, 0),
             (400, [], 1), (450, [0.0] * 16, 2), (None, rows[3][1], 1), (201, [0.5], 0), (202, [0.5] * 20, 1),
             (203, rows[5][1], None), (-50, rows[7][1], 0), (500, rows[50][1], 1), (501, rows[50][1], 2)]
    assert mined(spark, rows) == plain(rows)
    # a repeated anchor is mined twice, and each finds the other first
    got = mined(spark, [*rows, rows[50]])
    twice = [r for r in got if r[0] == 50]
    assert len(twice) == 2 * len(set(twice)) and {r[1] for r in twice} >= {50}


def test_very_large_components(spark):
    rng = random.Random(4)
    rows = [(k, [rng.uniform(-1, 1) * 10 ** rng.choice([0, 5, 9, 200, 308]) for _ in range(6)], k % 2)
            for k in range(101)]
    rows += [(1000 + k, [rng.uniform(-1, 1) * 3e6 for _ in range(6)], k % 2) for k in range(60)]
    assert mined(spark, rows, row_block=20) == plain(rows)


def test_empty_and_without_anchors(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, [0.5, 0.5], 1), (2, [0.5, 0.5], 2)]) == []
    assert mined(spark, [(50, [0.5, 0.5], 1)]) == []


def test_ties_go_to_the_smaller_id(spark):
    rows = [(k, [0.5, 0.25], k % 2) for k in range(300)] + [(1000 + k, [0.25, 0.25], k % 2) for k in range(40)]
    assert mined(spark, rows, row_block=30, anchor_block=2) == plain(rows)


def block(rows):
    return hn.Block({"n": len(rows), "dim": len(rows[0][1]),
                     "vectors": np.floor(np.array([r[1] for r in rows]) * 256).astype("<f8").tobytes(),
                     "ids": np.array([r[0] for r in rows], "<i8").tobytes(),
                     "rows": np.array([r[0] for r in rows], "<i8").tobytes(),
                     "labels": np.array([r[2] for r in rows], "<i8").tobytes()})


def test_bounds_hold_and_skip_work():
    rng = np.random.default_rng(0)
    smooth = np.repeat(rng.normal(size=(4000, 8)), 8, axis=1) + rng.normal(size=(4000, 64)) * 0.05
    rows = [(k, v.tolist(), 0) for k, v in enumerate(smooth)]
    whole = block(rows)
    for segments in (4, 16):
        mean, deviation = whole.summary(64, segments)
        exact = whole.vectors[:50] @ whole.vectors.T
        middle, spread = mean[:50] @ mean.T, deviation[:50] @ deviation.T
        assert (np.abs(exact - middle) <= spread + 1e-3).all()
    n = 40
    anchors = block(rows[:n])
    best = hn.Best(np.full((n, 1), -LONG), np.full((n, 1), LONG), 5)
    scored = hn.score_tile(anchors, whole, (0, n), (0, len(rows)), True, best)
    assert scored < 0.3 * n * len(rows)
    exact = anchors.vectors @ whole.vectors.T
    exact[np.arange(n), np.arange(n)] = -np.inf
    assert (np.sort(exact, axis=1)[:, :-6:-1] == best.score).all()
