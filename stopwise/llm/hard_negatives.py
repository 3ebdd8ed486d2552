"""Hard-negative mining by exact inner products, filtered by segment summaries.

Vectors are cut into equal segments. A segment's mean and deviation bound the inner product of
two vectors: the sum over segments of ``n * mean * mean``, plus or minus ``n * deviation *
deviation``. A tile of anchors and rows is first bounded with few segments; what may still
enter some anchor's best is bounded again with finer segments, and the rest is scored exactly.
The bounds only skip work, so results are those of scoring every pair.

Anchors are a stated query set against all rows. Both are packed into blocks by a hash of the
row number. Every anchor block meets every row block: for a pair of an anchor block and a group of
row blocks, one task keeps the best rows of each anchor while the row blocks stream by, so it
holds one anchor block, one row block and ``anchors * kept`` results. Rows go out once for each
anchor block, results once for each anchor and group; the best of the groups are merged by a
ranked window. The first pass finds the positives among rows of the anchor's label, run by run
of equal labels; the second finds the negatives between the limits that the positives set.

Rows. A row without a label or a vector, or with a null or non-finite component, takes no part.
Components become floor(scale * x) as doubles; scores are exact integers, held within a long.
A vector shorter than another counts as filled with zeros, so an empty one scores 0. Rows of
equal vec_id, and repeated rows, are rows of their own: a repeated anchor is mined twice, and each
is the other's candidate. Order is by score, vec_id (null last), then the row's number. An
empty table, or one without anchors, gives no rows. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import stage

ANCHOR_BLOCK = 8192      # anchors of a block, about; blocks are dealt by hash
ROW_BLOCK = 2048         # rows of a block, about
GROUP_BLOCKS = 64        # row blocks that one task scores against an anchor block
SLICE = 512              # rows scored at once
SEGMENTS = (4, 16)       # segments of a vector, coarse to fine
FEW = 0.04               # share of pairs left below which they are scored one by one
EXACT = float(1 << 53)   # doubles hold integers below this
LONG = (1 << 63) - 1
NULL_ID = 1 << 62        # added to the number of a row without vec_id
LARGEST = 1e300          # components beyond are held at it; their scores are beyond a long

_BLOCK = "bucket long, part long, n int, dim int, vectors binary, ids binary, rows binary, labels binary"
_COLUMNS = [c.split()[0] for c in _BLOCK.split(", ")]


def _matrix(lists: pa.ListArray) -> np.ndarray:
    lengths = np.asarray(pc.list_value_length(lists)).astype(np.int64)
    out = np.zeros((len(lengths), int(lengths.max())))
    out[np.arange(out.shape[1]) < lengths[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def _blocks(size: int, scale: float):
    """Packs the rows of a bucket, which come sorted by bucket and label.

    A bucket may exceed its usual size by chance, so it is cut into blocks of ``size``.
    """

    def pack(held: list[pa.RecordBatch], bucket: int, part: int) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).combine_chunks()
        with np.errstate(over="ignore"):
            vectors = np.clip(np.floor(
                _matrix(rows.column("vector").chunk(0)) * scale), -LARGEST, LARGEST)
        n, dim = vectors.shape
        if not vectors.size or np.abs(vectors).max() < 1 << 24:
            vectors = vectors.astype("<f4")
        ids = rows.column("vec_id")
        null = np.asarray(pc.is_null(ids))
        number = np.asarray(rows.column("row")) + np.where(null, NULL_ID, 0)
        ids = np.asarray(pc.fill_null(ids, LONG))
        label = np.asarray(rows.column("label"))
        return pa.RecordBatch.from_arrays(
            [pa.array([bucket]), pa.array([part]), pa.array([n], pa.int32()),
             pa.array([dim], pa.int32()),
             *(pa.array([x.tobytes()], pa.binary()) for x in (
                 vectors, ids.astype("<i8"), number.astype("<i8"), label.astype("<i8")))],
            _COLUMNS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, bucket, part = [], 0, None, 0
        for batch in batches:
            of = np.asarray(batch.column("bucket"))
            edges = [0, *(np.flatnonzero(np.diff(of)) + 1).tolist(), len(of)]
            for first, last in zip(edges, edges[1:]):
                if first < last and of[first] != bucket:
                    if held:
                        yield pack(held, bucket, part)
                    held, n, bucket, part = [], 0, int(of[first]), 0
                while first < last:
                    step = min(size - n, last - first)
                    held.append(batch.slice(first, step))
                    n, first = n + step, first + step
                    if n == size:
                        yield pack(held, bucket, part)
                        held, n, part = [], 0, part + 1
        if held:
            yield pack(held, bucket, part)

    return run


class Block:
    """Vectors with their ids, numbers and labels, sorted by label."""

    def __init__(self, row: dict) -> None:
        n, dim = row["n"], row["dim"]
        kind = "<f8" if len(row["vectors"]) == 8 * n * dim else "<f4"
        self.vectors = np.frombuffer(row["vectors"], kind).reshape(n, dim).astype(np.float64)
        self.ids, self.rows, self.labels = (
            np.frombuffer(row[c], "<i8") for c in ("ids", "rows", "labels"))
        self.most = float(np.abs(self.vectors).max()) if self.vectors.size else 0.0
        self.summaries = {}

    def summary(self, dim: int, segments: int) -> tuple[np.ndarray, np.ndarray]:
        """Means and deviations of the segments, both times the root of a segment's length."""
        if (dim, segments) not in self.summaries:
            length = -(-dim // segments)
            padded = np.zeros((len(self.vectors), length * segments))
            padded[:, :self.vectors.shape[1]] = self.vectors
            cut = padded.reshape(len(padded), segments, length)
            mean = cut.mean(axis=2)
            deviation = np.sqrt(((cut - mean[:, :, None]) ** 2).mean(axis=2))
            root = np.sqrt(length)
            self.summaries[dim, segments] = mean * root, deviation * root
        return self.summaries[dim, segments]

    def runs(self) -> Iterator[tuple[int, int]]:
        """Runs of rows of one label."""
        edges = np.flatnonzero(np.diff(self.labels)) + 1
        yield from zip([0, *edges.tolist()], [*edges.tolist(), len(self.labels)])


def _wide(vectors: np.ndarray, dim: int) -> np.ndarray:
    if vectors.shape[1] == dim:
        return vectors
    return np.pad(vectors, ((0, 0), (0, dim - vectors.shape[1])))


def _exact(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products of vectors whose sums a double cannot hold, kept within a long."""
    whole = np.frompyfunc(int, 1, 1)
    product = whole(left) @ whole(right).T
    return np.clip(product, -LONG, LONG).astype(np.int64)


class Best:
    """The best rows of every slot so far; an anchor has one slot for each pair of limits."""

    def __init__(self, low: np.ndarray, high: np.ndarray, kept: int) -> None:
        self.low, self.high, self.kept = low, high, kept            # anchors x slots
        slots = low.size
        self.score = np.full((slots, kept), -LONG, np.int64)
        self.id = np.full((slots, kept), LONG, np.int64)
        self.row = np.full((slots, kept), -1, np.int64)
        self.bar = low.copy()                                       # what a newcomer must reach
        self.top = high.max(axis=1).astype(np.float64)

    def need(self) -> np.ndarray:
        """The least score that may still matter, by anchor; infinite without open slots."""
        return np.where(self.low <= self.high, self.bar, np.inf).min(axis=1)

    def add(self, anchor: np.ndarray, score: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        width = self.low.shape[1]
        for w in range(width):
            ok = (score >= self.bar[anchor, w]) & (score <= self.high[anchor, w])
            if ok.any():
                self._merge(anchor[ok] * width + w, score[ok], ids[ok], rows[ok])

    def _merge(self, slot, score, ids, rows) -> None:
        touched = np.unique(slot)
        old = self.row[touched] >= 0
        slot = np.concatenate([slot, np.repeat(touched, self.kept)[old.ravel()]])
        score = np.concatenate([score, self.score[touched][old]])
        ids = np.concatenate([ids, self.id[touched][old]])
        rows = np.concatenate([rows, self.row[touched][old]])
        order = np.lexsort((rows, ids, -score, slot))
        slot, score, ids, rows = slot[order], score[order], ids[order], rows[order]
        first = np.searchsorted(slot, slot)
        rank = np.arange(len(slot)) - first
        stays = rank < self.kept
        at = slot[stays], rank[stays]
        self.score[at], self.id[at], self.row[at] = score[stays], ids[stays], rows[stays]
        full = at[0][at[1] == self.kept - 1]
        width = self.low.shape[1]
        self.bar[full // width, full % width] = self.score[full, self.kept - 1]

    def found(self, anchors: Block) -> pa.RecordBatch:
        slot, place = np.nonzero(self.row >= 0)
        width = self.low.shape[1]
        row, ids = self.row[slot, place], self.id[slot, place]
        null = row >= NULL_ID
        return pa.RecordBatch.from_arrays(
            [pa.array(anchors.rows[slot // width] % NULL_ID), pa.array(slot % width + 1, pa.int32()),
             pa.array(self.score[slot, place]), pa.array(ids, mask=null),
             pa.array(np.where(null, row - NULL_ID, row))],
            ["anchor_row", "slot", "score", "vec_id", "row"])


def score_tile(anchors: Block, rows: Block, span: tuple[int, int], run: tuple[int, int],
               same_label: bool, best: Best) -> int:
    """Offers ``best`` the rows ``run`` for the anchors ``span``; returns the pairs it scored.

    ``span`` and ``run`` have one label if only rows of the anchor's label count.
    """
    scored = 0
    dim = max(anchors.vectors.shape[1], rows.vectors.shape[1])
    for start in range(run[0], run[1], SLICE):
        a = np.arange(*span)
        r = np.arange(start, min(start + SLICE, run[1]))
        need = best.need()
        a = a[need[a] < np.inf]
        if not len(a):
            break
        allowed = (anchors.labels[a][:, None] == rows.labels[r]) == same_label
        if same_label:
            allowed &= anchors.rows[a][:, None] != rows.rows[r]
        small = anchors.most * rows.most * max(dim, 1) < EXACT
        for segments in SEGMENTS if small else ():
            if 3 * segments > dim:
                break
            mean_a, dev_a = (x[a] for x in anchors.summary(dim, segments))
            mean_r, dev_r = (x[r] for x in rows.summary(dim, segments))
            middle, spread = mean_a @ mean_r.T, dev_a @ dev_r.T
            spread += 0.25 + 1e-9 * np.abs(middle)      # more than rounding can take away
            allowed &= middle + spread >= need[a][:, None]
            allowed &= middle - spread <= best.top[a][:, None]
            a_left, r_left = allowed.any(axis=1), allowed.any(axis=0)
            a, r, allowed = a[a_left], r[r_left], allowed[a_left][:, r_left]
            if not allowed.size or allowed.mean() < FEW:
                break
        if not allowed.size:
            continue
        if not small:
            i, j = np.nonzero(allowed)
            scored += allowed.size
            score = _exact(_wide(anchors.vectors[a], dim), _wide(rows.vectors[r], dim))[i, j]
        elif allowed.mean() < FEW:
            i, j = np.nonzero(allowed)
            scored += len(i)
            score = np.einsum("ij,ij->i", _wide(anchors.vectors[a], dim)[i],
                              _wide(rows.vectors[r], dim)[j]).astype(np.int64)
        else:
            scored += allowed.size
            scores = _wide(anchors.vectors[a], dim) @ _wide(rows.vectors[r], dim).T
            allowed &= (scores >= need[a][:, None]) & (scores <= best.top[a][:, None])
            i, j = np.nonzero(allowed)
            score = scores[i, j].astype(np.int64)
        if len(i):
            best.add(a[i], score, rows.ids[r[j]], rows.rows[r[j]])
    return scored


def _scan(kept: int, same_label: bool):
    """Streams blocks sorted by anchor block and group, the anchors of a group first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k].as_py() for c in batch.schema.names}
                now = row["anchor_block"], row["block_group"]
                if now != key:
                    for anchors, best in held:
                        yield best.found(anchors)
                    key, held = now, []
                block = Block(row)
                if not row["is_row"]:
                    n = len(block.rows)
                    limits = np.frombuffer(row["limits"], "<i8").reshape(2, n, -1)
                    held.append((block, Best(limits[0], limits[1], kept)))
                    continue
                for anchors, best in held:
                    if not same_label:
                        score_tile(anchors, block, (0, len(anchors.rows)), (0, len(block.rows)),
                                   False, best)
                        continue
                    for first, last in block.runs():
                        span = [int(np.searchsorted(anchors.labels, block.labels[first], side))
                                for side in ("left", "right")]
                        score_tile(anchors, block, span, (first, last), True, best)
        for anchors, best in held:
            yield best.found(anchors)

    return run


_FOUND = "anchor_row long, slot int, score long, vec_id long, row long"


def _packed(rows: DataFrame, n: int, size: int, scale: float) -> tuple[DataFrame, int]:
    buckets = max(1, -(-n // size))
    bucket = F.pmod(F.xxhash64("row"), F.lit(buckets)).cast("long")
    dealt = rows.withColumn("bucket", bucket).repartition(buckets, "bucket")
    # a few rows over the usual size stay in one block
    return dealt.sortWithinPartitions("bucket", "label", "row").mapInArrow(
        _blocks(size + size // 4, scale), _BLOCK), buckets


def _open(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds one slot that takes any score to every anchor."""
    for batch in batches:
        limits = [np.repeat(np.array([-LONG, LONG], "<i8"), n).tobytes()
                  for n in batch.column("n").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(limits, pa.binary())], [*batch.schema.names, "limits"])


def _limits(anchors: DataFrame, slots: int) -> DataFrame:
    """Adds the limits of every anchor to its block: lows, then highs; empty slots exclude all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k].as_py() for c in batch.schema.names}
                number = np.frombuffer(row["rows"], "<i8") % NULL_ID
                low = np.full((len(number), slots), LONG, np.int64)
                high = np.full((len(number), slots), -LONG, np.int64)
                at = {int(x): i for i, x in enumerate(number)}
                for x in row["windows"] or ():
                    i = at.get(x["anchor_row"])
                    if i is not None:
                        low[i, x["slot"] - 1], high[i, x["slot"] - 1] = x["low"], x["high"]
                one = batch.slice(k, 1)
                yield pa.RecordBatch.from_arrays(
                    [*(one.column(c) for c in batch.schema.names if c != "windows"),
                     pa.array([np.stack([low, high]).tobytes()], pa.binary())],
                    [*(c for c in batch.schema.names if c != "windows"), "limits"])

    return anchors.mapInArrow(run, f"{_BLOCK}, limits binary")


def _best_rows(anchors: DataFrame, anchor_buckets: int, blocks: DataFrame, row_buckets: int,
               kept: int, same_label: bool) -> DataFrame:
    """The ``kept`` best rows of every slot: anchor_row, slot, rank, score, vec_id, row."""
    spark = blocks.sparkSession
    cores = spark.sparkContext.defaultParallelism
    groups = min(row_buckets, max(-(-row_buckets // GROUP_BLOCKS), -(-2 * cores // anchor_buckets)))
    columns = [*_COLUMNS, "limits"]
    left = anchors.select(F.col("bucket").alias("anchor_block"), F.explode(F.sequence(
        F.lit(0), F.lit(groups - 1))).alias("block_group"), F.lit(False).alias("is_row"), *columns)
    right = blocks.withColumn("limits", F.lit(None).cast("binary")).select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(anchor_buckets - 1).cast("long")))
        .alias("anchor_block"),
        F.pmod("bucket", F.lit(groups)).cast("int").alias("block_group"),
        F.lit(True).alias("is_row"), *columns)
    tiles = left.unionByName(right).repartition(anchor_buckets * groups, "anchor_block", "block_group")
    found = tiles.sortWithinPartitions("anchor_block", "block_group", "is_row", "bucket", "part") \
        .mapInArrow(_scan(kept, same_label), _FOUND)
    order = Window.partitionBy("anchor_row", "slot").orderBy(
        F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= kept)


def mine(vectors: DataFrame, anchor: Column, vec_id: str = "vec_id", vector: str = "embedding",
         label: str = "label", positives: int = 5, negatives: int = 3, low: int = 50,
         high: int = 95, scale: float = 256.0, row_block: int = ROW_BLOCK,
         anchor_block: int = ANCHOR_BLOCK) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score, and row numbers.

    Anchors are the rows where ``anchor`` holds. A negative of a positive of score p has a score
    n with ``low * p <= 100 * n <= high * p``.
    """
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (
        F.abs(x.cast("double")) < float("inf")))
    rows = stage(vectors.filter(F.col(label).isNotNull() & F.col(vector).isNotNull() & finite).select(
        F.monotonically_increasing_id().alias("row"), F.col(vec_id).cast("long").alias("vec_id"),
        F.col(label).cast("long").alias("label"), F.col(vector).cast("array<double>").alias("vector"),
        F.coalesce(anchor, F.lit(False)).alias("is_anchor")), "vectors")
    n, n_anchors = rows.agg(F.count("*"), F.count_if("is_anchor")).first()
    packed = ("row", "vec_id", "label", "vector")
    blocks, row_buckets = _packed(rows.select(*packed), n, row_block, scale)
    blocks = stage(blocks, "row-blocks")
    chosen, anchor_buckets = _packed(
        rows.filter("is_anchor").select(*packed), n_anchors, anchor_block, scale)
    chosen = stage(chosen, "anchor-blocks")

    best = _best_rows(chosen.mapInArrow(_open, f"{_BLOCK}, limits binary"), anchor_buckets,
                      blocks, row_buckets, positives, True)
    names = rows.filter("is_anchor").select(
        F.col("row").alias("anchor_row"), F.col("vec_id").alias("anchor_id"))
    best = stage(best.select(
        "anchor_row", F.col("rank").alias("slot"), F.col("score").alias("positive_score"),
        F.col("vec_id").alias("positive_id"), F.col("row").alias("positive_row")), "positives")

    p = F.col("positive_score").cast("decimal(38,0)")
    windows = best.select(
        F.pmod(F.xxhash64(F.col("anchor_row")), F.lit(anchor_buckets)).cast("long").alias("of"),
        F.struct("anchor_row", "slot", F.ceil(p * low / 100).cast("long").alias("low"),
                 F.floor(p * high / 100).cast("long").alias("high")).alias("window"))
    # one list for a bucket, which has about anchor_block anchors
    windows = windows.groupBy("of").agg(F.collect_list("window").alias("windows"))
    limited = _limits(chosen.join(windows, F.col("bucket") == F.col("of")).drop("of"), positives)
    worst = _best_rows(limited, anchor_buckets, blocks, row_buckets, negatives, False).select(
        "anchor_row", "slot", "rank", F.col("score").alias("negative_score"),
        F.col("vec_id").alias("negative_id"), F.col("row").alias("negative_row"))
    return worst.join(best, ["anchor_row", "slot"]).join(names, "anchor_row").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score",
        "anchor_row", "positive_row", "negative_row")
