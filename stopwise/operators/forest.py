"""Random forest for regression that is fitted on all rows, however many nodes its trees get.

Features are cut into at most 32 bins, the cuts taken from all rows. Rows of the same bins and label
are counted: a bootstrap draws each row by itself, and Poisson counts of equal rows add up to one of
their number. A task holds every such row as one number of bins, its label and count, draws a bootstrap
for each of its trees and grows them level by level with histograms over the bins. Trees are written as they are made and never meet in the
driver's heap; a scorer has them as flat arrays of a few bytes a node.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..session import new_folder

BINS = 32                    # of a feature, at most
_BITS = 5                    # of one bin in a row's code
_LEAF = 255                  # in place of a leaf's feature
_NODES = 4096                # whose histograms are made at a time
_PATHS = 1 << 19             # pairs of row and tree that go down together
_TREE = "tree int, feature binary, cut binary, child binary, value binary, importance array<double>"


def known(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows with all columns given, as doubles that are numbers."""
    return df.filter(" AND ".join(f"`{c}` IS NOT NULL AND NOT isnan(CAST(`{c}` AS double))" for c in columns))


def _doubles(columns: list[str]) -> list:
    return [F.col(c).cast("double").alias(c) for c in columns]


def _values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The least values of each feature in a task, one more than there are bins."""
    seen = None
    for batch in batches:
        own = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(batch.num_columns)]
        seen = [np.unique(np.concatenate(x))[:BINS + 1] for x in zip(seen or [[]] * len(own), own)]
    for k, values in enumerate(seen or []):
        yield pa.record_batch({"k": pa.array([k] * len(values), pa.int32()), "v": pa.array(values)})


def _above(cuts: list[np.ndarray]):
    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The least value above each cut, in a task."""
        found = [np.full(len(c), np.inf) for c in cuts]
        for batch in batches:
            for k, cut in enumerate(cuts):
                values = np.sort(batch.column(k).to_numpy(zero_copy_only=False))
                at = np.searchsorted(values, cut, side="right")
                values = np.append(values, np.inf)
                np.minimum(found[k], values[at], out=found[k])
        for k, values in enumerate(found):
            yield pa.record_batch({"k": pa.array([k] * len(values), pa.int32()),
                                   "i": pa.array(range(len(values)), pa.int32()),
                                   "v": pa.array(values, pa.float64())})
    return least


def find_cuts(rows: DataFrame, features: list[str]) -> list[np.ndarray]:
    """Cuts of each feature: halfway between its values, of which quantiles are taken beyond 32."""
    given = rows.select(*_doubles(features))
    few: list[list[float]] = [[] for _ in features]
    for r in given.mapInArrow(_values, "k int, v double").distinct().collect():
        few[r["k"]].append(r["v"])
    shares = [i / BINS for i in range(1, BINS)]
    ranks = given.agg(*[F.percentile_approx(f, shares, 100_000).alias(f) for f in features]).first()
    below = [np.array(sorted(few[k])[:-1]) if len(few[k]) <= BINS else np.unique(ranks[f])
             for k, f in enumerate(features)]
    next_up = given.mapInArrow(_above(below), "k int, i int, v double").groupBy("k", "i").agg(F.min("v").alias("v"))
    cuts = [np.full(len(b), np.inf) for b in below]
    for k, i, v in next_up.collect():
        cuts[k][i] = below[k][i] + (v - below[k][i]) / 2
    return [np.unique(c[np.isfinite(c)]) for c in cuts]


def _bins(cuts: list[np.ndarray], columns: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(c, x, side="left").astype(np.uint8)
                     for c, x in zip(cuts, columns)], axis=1)


def _coded(cuts: list[np.ndarray]):
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shift = np.arange(len(cuts), dtype=np.int64) * _BITS
        for batch in batches:
            columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(len(cuts))]
            codes = (_bins(cuts, columns).astype(np.int64) << shift).sum(axis=1)
            yield pa.record_batch({"code": pa.array(codes), "label": batch.column(len(cuts))})
    return code


def _best_cuts(bins, w, wy, node, n, s, rng, tried: int, min_instances: int):
    """Best gain, feature and cut of each node, among as many features as are ``tried``."""
    m = len(n)
    own = np.argsort(rng.random((m, bins.shape[1])), axis=1)[:, :tried]
    gain, feature, cut = np.full(m, -np.inf), np.zeros(m, np.uint8), np.zeros(m, np.uint8)
    every, whole = np.arange(m), s * s / n
    for j in range(tried):
        key = node * BINS + np.take_along_axis(bins, own[node, j][:, None], axis=1)[:, 0]
        left = np.bincount(key, w, m * BINS).reshape(m, BINS).cumsum(axis=1)[:, :-1]
        total = np.bincount(key, wy, m * BINS).reshape(m, BINS).cumsum(axis=1)[:, :-1]
        right = n[:, None] - left
        with np.errstate(divide="ignore", invalid="ignore"):
            score = total * total / left + (s[:, None] - total) ** 2 / right
        score[(left < min_instances) | (right < min_instances)] = -np.inf
        at = score.argmax(axis=1)
        made = score[every, at] - whole
        better = made > gain
        gain[better], feature[better], cut[better] = made[better], own[better, j], at[better]
    return gain, feature, cut


def grow_tree(bins: np.ndarray, label: np.ndarray, count: np.ndarray, rng: np.random.Generator, *,
              max_depth: int, min_instances: int, tried: int) -> dict[str, np.ndarray]:
    """A tree on a bootstrap of the rows, its nodes level by level.

    ``child`` is the left one, before the right one, or a leaf's place in ``value``. A node is
    cut where that lessens the squared error most, if at all.
    """
    weight = rng.poisson(count)
    if not weight.any():
        weight = count
    rows = np.flatnonzero(weight)
    w, middle = weight[rows].astype(float), np.average(label, weights=count)
    node = np.zeros(len(rows), np.int64)
    features, cuts, children, values = [], [], [], []
    importance = np.zeros(bins.shape[1])
    m, placed, leaves, depth = 1, 0, 0, 0
    while m:
        y = label[rows]
        wy = w * (y - middle)
        n, s = np.bincount(node, w, m), np.bincount(node, wy, m)
        squares = np.bincount(node, wy * (y - middle), m)
        gain, feature, cut = np.zeros(m), np.full(m, _LEAF, np.uint8), np.zeros(m, np.uint8)
        if depth < max_depth:
            for a in range(0, m, _NODES):
                b = min(a + _NODES, m)
                i, j = np.searchsorted(node, [a, b])
                gain[a:b], feature[a:b], cut[a:b] = _best_cuts(
                    bins[rows[i:j]], w[i:j], wy[i:j], node[i:j] - a, n[a:b], s[a:b], rng, tried,
                    min_instances)
        cuttable = gain > 1e-9 * squares
        np.add.at(importance, feature[cuttable], gain[cuttable])
        feature[~cuttable] = _LEAF
        rank = np.cumsum(cuttable) - 1
        placed += m
        children.append(np.where(cuttable, placed + 2 * rank, leaves + np.cumsum(~cuttable) - 1).astype(np.int32))
        values.append((np.bincount(node, w * y, m) / n)[~cuttable])
        features.append(feature)
        cuts.append(cut)
        leaves += len(values[-1])
        go = cuttable[node]
        rows, w, node = rows[go], w[go], node[go]
        right = bins[rows, feature[node]] > cut[node]
        node = 2 * rank[node] + right
        order = np.argsort(node, kind="stable")
        rows, w, node = rows[order], w[order], node[order]
        m, depth = 2 * int(cuttable.sum()), depth + 1
    return {"feature": np.concatenate(features), "cut": np.concatenate(cuts),
            "child": np.concatenate(children), "value": np.concatenate(values),
            "importance": importance}


def _grown(n_features: int, num_trees: int, blocks: int, seed: int, **options):
    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The trees of a block, one at a time, from all rows in the order of their values."""
        codes, labels, counts, block = [], [], [], None
        for batch in batches:
            if batch.num_rows:
                block = batch.column(0)[0].as_py()
                codes.append(batch.column(1).to_numpy().copy())
                labels.append(batch.column(2).to_numpy().copy())
                counts.append(batch.column(3).to_numpy().copy())
        if block is None:
            return
        code, label, count = np.concatenate(codes), np.concatenate(labels), np.concatenate(counts)
        del codes, labels, counts
        order = np.lexsort((label, code))
        code, label, count = code[order], label[order], count[order]
        bins = np.empty((len(code), n_features), np.uint8)
        for k in range(n_features):
            bins[:, k] = code >> (_BITS * k) & (BINS - 1)
        del code, order
        for tree in range(block, num_trees, blocks):
            made = grow_tree(bins, label, count, np.random.default_rng([seed, tree]), **options)
            yield pa.record_batch({
                "tree": pa.array([tree], pa.int32()),
                **{c: pa.array([made[c].tobytes()], pa.binary()) for c in ("feature", "cut", "child", "value")},
                "importance": pa.array([made["importance"].tolist()], pa.list_(pa.float64()))})
    return grow


def _scorer(trees: Broadcast, cuts: list[np.ndarray]):
    def predict(columns: list[np.ndarray]) -> np.ndarray:
        """Mean of the trees' values, whose order is that of the trees for every row."""
        forest, bins = trees.value, _bins(cuts, columns)
        feature, cut, child, value, roots = (forest[c] for c in ("feature", "cut", "child", "value", "root"))
        out, step = np.empty(len(bins)), max(1, _PATHS // len(roots))
        for a in range(0, len(bins), step):
            part = bins[a:a + step]
            at = np.repeat(roots[:, None], len(part), axis=1).ravel()
            row = np.tile(np.arange(len(part)), len(roots))
            live = np.flatnonzero(feature[at] != _LEAF)
            while len(live):
                here = at[live]
                at[live] = child[here] + (part[row[live], feature[here]] > cut[here])
                live = live[feature[at[live]] != _LEAF]
            reached = value[child[at]].reshape(len(roots), len(part))
            out[a:a + step] = np.add.reduce(reached, axis=0) / len(roots)
        return out
    return predict


class DelayForest:
    """A forest in a folder: ``trees``, one row each, and ``metadata``."""

    def __init__(self, spark: SparkSession, path: str, metadata: dict):
        self.spark, self.path, self.metadata = spark, path.rstrip("/"), metadata
        self.features = metadata["features"]
        self.cuts = [np.array(c, float) for c in metadata["cuts"]]
        self._packed: Broadcast | None = None

    @property
    def trees(self) -> DataFrame:
        return self.spark.read.schema(_TREE).parquet(f"{self.path}/trees")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> DelayForest:
        text = "".join(r["value"] for r in spark.read.text(f"{path.rstrip('/')}/metadata").collect())
        return cls(spark, path, json.loads(text))

    def save(self, path: str) -> str:
        self.trees.write.mode("overwrite").parquet(f"{path.rstrip('/')}/trees")
        self._describe(path)
        return path

    def _describe(self, path: str) -> None:
        (self.spark.createDataFrame([(json.dumps(self.metadata),)], "value string").coalesce(1)
         .write.mode("overwrite").text(f"{path.rstrip('/')}/metadata"))

    def importances(self) -> np.ndarray:
        """Mean over the trees of each feature's share in a tree's gain, together 1."""
        gains = np.array([r["importance"] for r in
                          self.trees.select("tree", "importance").orderBy("tree").collect()])
        totals = gains.sum(axis=1, keepdims=True)
        shares = np.divide(gains, totals, out=np.zeros_like(gains), where=totals > 0).sum(axis=0)
        return shares / shares.sum() if shares.sum() > 0 else shares

    def packed(self) -> Broadcast:
        """All trees as flat arrays; the driver reads them a file at a time."""
        if self._packed is None:
            kinds = {"feature": np.uint8, "cut": np.uint8, "child": np.int32, "value": np.float64}
            made = sorted(((r["tree"], {c: np.frombuffer(bytes(r[c]), t) for c, t in kinds.items()})
                           for r in self.trees.drop("importance").toLocalIterator()), key=lambda x: x[0])
            sizes = [(len(t["feature"]), len(t["value"])) for _, t in made]
            starts = np.cumsum([(0, 0), *sizes], axis=0)[:-1]
            wide = np.int32 if sum(nodes for nodes, _ in sizes) < 1 << 31 else np.int64
            for (_, t), (node, leaf) in zip(made, starts):
                t["child"] = (t["child"] + np.where(t["feature"] == _LEAF, leaf, node)).astype(wide)
            self._packed = self.spark.sparkContext.broadcast(
                {"root": starts[:, 0], **{c: np.concatenate([t[c] for _, t in made]) for c in kinds}})
        return self._packed

    def transform(self, df: DataFrame, name: str = "prediction") -> DataFrame:
        """Add the prediction; rows that lack a feature are left out. Runs on a stream too."""
        predict = _scorer(self.packed(), self.cuts)

        @F.pandas_udf(T.DoubleType())
        def predicted(rows):
            import pandas as pd
            return pd.Series(predict([rows[c].to_numpy(float) for c in rows.columns]))

        return known(df, self.features).withColumn(name, predicted(F.struct(*_doubles(self.features))))


def fit_forest(training: DataFrame, features: list[str], label: str, *, num_trees: int, max_depth: int,
               min_instances: int, seed: int) -> DelayForest:
    """Fit on every row that has all features and a label.

    As many blocks of trees as there are cores get all rows once each, in one order, so
    that the same rows and cuts give the same trees, however they lie.
    """
    spark = training.sparkSession
    rows = known(training, [*features, label]).select(*_doubles([*features, label]))
    cuts = find_cuts(rows, features)
    blocks = min(num_trees, spark.sparkContext.defaultParallelism)
    dealt = (rows.mapInArrow(_coded(cuts), "code bigint, label double")
             .groupBy("code", "label").agg(F.count("*").alias("n"))
             .select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "code", "label", "n")
             .repartitionById(blocks, "block"))
    path = new_folder(spark, "forest")
    tried = -(-len(features) // 3)
    dealt.mapInArrow(_grown(len(features), num_trees, blocks, seed, max_depth=max_depth,
                            min_instances=min_instances, tried=tried), _TREE).write.parquet(f"{path}/trees")
    forest = DelayForest(spark, path, {"features": list(features), "cuts": [c.tolist() for c in cuts]})
    if forest.trees.isEmpty():
        raise ValueError("no rows to fit on: every row lacks a feature or its label")
    forest._describe(path)
    return forest
