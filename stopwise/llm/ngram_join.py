"""Self-join of documents on the Jaccard similarity of their word n-grams.

MinHash values are cut into bands, as many and as long as the target recall asks for.
Documents with equal n-gram sets are one node from the start. Nodes that share a band hash
meet in a bucket; buckets with the same members are looked at once. A bucket is dealt out
as tiles of two blocks of nodes, so that a bucket of any size is worked on in parts, and
every tile compares full n-gram sets. A pair is counted in the first band that it shares,
so a pair that meets in many buckets counts once. What leaves a tile is, per node, its
number of links and one node of its connected part; pairs are never written out.

Null text counts as empty. Documents without words are in no class but their own and have
no links. Equal texts are linked like others. Repeated rows are documents like others; a
null doc_id takes part, and a class of nulls only has a null id.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import stage
from .components import components
from .pretoken import portions
from .shingles import PORTION_CHARS, WORDS, band_hashes, set_keys, shingle_sets
from .tables import free_name, keyed, numbered, without

THRESHOLD = 0.8
RECALL = 0.999               # of a pair at the threshold
MAX_HASHES = 64
BLOCK = 512                  # nodes of a bucket that are compared in one piece
BROADCAST_ROWS = 1_000_000   # ids of 8 bytes; more are joined by a shuffle
COLUMNS = 4096               # n-grams that are multiplied out together


def choose_bands(threshold: float = THRESHOLD, recall: float = RECALL,
                 max_hashes: int = MAX_HASHES) -> tuple[int, int]:
    """``(bands, rows)`` with the longest bands that reach the recall within the hashes."""
    best = None
    for rows in range(1, max_hashes + 1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold ** rows))
        if bands * rows <= max_hashes:
            best = (bands, rows)
    if best is None:
        raise ValueError("more hashes are needed for this recall")
    return best


def _sign(bands: int, rows: int, words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for a, b in portions(texts, PORTION_CHARS):
                sets = shingle_sets(texts[a:b], words)
                full = [k for k, s in enumerate(sets) if len(s)]
                hashes = band_hashes([sets[k] for k in full], bands, rows)
                lists: list = [None] * len(sets)
                for k, row in zip(full, hashes.view(np.int64)):
                    lists[k] = row
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(set_keys(sets), pa.binary()),
                     pa.array(lists, pa.list_(pa.int64()))], ["doc_id", "node", "bands"])

    return run


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(0).to_pylist()]
            for a, b in portions(texts, PORTION_CHARS):
                sets = shingle_sets(texts[a:b], words)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(set_keys(sets), pa.binary()),
                     pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))],
                    ["node", "grams"])

    return run


def _common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, by a product of incidence matrices in pieces."""
    if len(left) * len(right) <= 16:
        return np.array([[len(np.intersect1d(a, b, assume_unique=True)) for b in right]
                         for a in left])
    sizes = [np.fromiter(map(len, s), np.int64, len(s)) for s in (left, right)]
    grams = [np.concatenate(s) for s in (left, right)]
    shared = np.intersect1d(np.unique(grams[0]), np.unique(grams[1]), assume_unique=True)
    places = []
    for g, n in zip(grams, sizes):
        at = np.minimum(np.searchsorted(shared, g), max(len(shared) - 1, 0))
        hit = shared[at] == g if len(shared) else np.zeros(len(g), bool)
        row, col = np.repeat(np.arange(len(n)), n)[hit], at[hit]
        order = np.argsort(col, kind="stable")
        places.append((row[order], col[order]))
    out = np.zeros((len(left), len(right)), np.float32)
    for first in range(0, len(shared), COLUMNS):
        piece = []
        for (row, col), n in zip(places, sizes):
            a, b = np.searchsorted(col, [first, first + COLUMNS])
            m = np.zeros((len(n), COLUMNS), np.float32)
            m[row[a:b], col[a:b] - first] = 1
            piece.append(m)
        out += piece[0] @ piece[1].T
    return out.astype(np.int64)


def _compare(band: int, same: bool, nodes: list[bytes], block: np.ndarray, bands: np.ndarray,
             copies: np.ndarray, grams: list[np.ndarray], threshold: float):
    """Links of one tile: ``(node, number of linked documents, a node of the same part)``."""
    left = np.arange(len(nodes)) if same else np.flatnonzero(block == block.min())
    right = left if same else np.flatnonzero(block != block.min())
    sizes = np.fromiter(map(len, grams), np.int64, len(grams))
    common = _common([grams[k] for k in left], [grams[k] for k in right])
    union = sizes[left][:, None] + sizes[right][None, :] - common
    i, j = np.nonzero(common >= np.ceil(threshold * union - 1e-9))
    i, j = left[i], right[j]
    if same:
        i, j = i[i < j], j[i < j]
    if not len(i):
        return
    links = np.zeros(len(nodes), np.int64)
    for a in range(0, len(i), 1 << 16):        # counted where the pair first meets
        x, y = i[a:a + (1 << 16)], j[a:a + (1 << 16)]
        here = (bands[x] == bands[y]).argmax(axis=1) == band
        np.add.at(links, x[here], copies[y[here]])
        np.add.at(links, y[here], copies[x[here]])
    head = np.arange(len(nodes))
    while True:
        low = np.minimum(head[i], head[j])
        moved = head.copy()
        np.minimum.at(moved, i, low)
        np.minimum.at(moved, j, low)
        moved = moved[moved]
        if (moved == head).all():
            break
        head = moved
    for k in np.unique(np.concatenate([i, j])):
        yield nodes[k], int(links[k]), nodes[head[k]]


def _tiles(threshold: float):
    """Walks over rows that are sorted by tile and compares each tile when it is complete."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []

        def finish():
            seen = {r["node"]: r for r in held}
            rows = [seen[k] for k in sorted(seen)]
            bands = np.array([r["bands"] for r in rows])
            found = list(_compare(
                held[0]["band"], held[0]["tile"][0] == held[0]["tile"][1],
                [r["node"] for r in rows], np.array([r["block"] for r in rows]), bands,
                np.array([r["copies"] for r in rows]), [r["grams"] for r in rows], threshold))
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([f[0] for f in found], pa.binary()),
                 pa.array([f[1] for f in found], pa.int64()),
                 pa.array([f[2] for f in found], pa.binary())], ["node", "links", "head"])

        for batch in batches:
            names = batch.schema.names
            columns = {c: batch.column(names.index(c)) for c in names}
            plain = {c: columns[c].to_pylist() for c in
                     ("bucket", "band", "low", "high", "block", "node", "copies")}
            lists = {c: (np.asarray(columns[c].flatten()),
                         np.concatenate([[0], np.cumsum(np.asarray(columns[c].value_lengths()))]))
                     for c in ("bands", "grams")}
            for k in range(batch.num_rows):
                key = (plain["bucket"][k], plain["low"][k], plain["high"][k])
                if held and held[0]["key"] != key:
                    yield finish()
                row = {c: plain[c][k] for c in ("band", "block", "node", "copies")}
                for c, (values, ends) in lists.items():
                    row[c] = values[ends[k]:ends[k + 1]].copy()
                held.append(row | {"key": key, "tile": key[1:]})
        if held:
            yield finish()

    return run


def _links(docs: DataFrame, nodes: DataFrame, doc_id: str, text: str, threshold: float,
           words: int, block: int) -> DataFrame:
    """``(node, links, head)`` rows of all tiles."""
    keys = nodes.filter("bands IS NOT NULL").select(
        "node", F.posexplode("bands").alias("band", "hash"))
    buckets = (keys.groupBy("band", "hash").agg(
        F.count("*").alias("members"), F.sum(F.xxhash64("node").cast("decimal(20)")).alias("sum"),
        F.min("node").alias("least")).filter("members > 1")
        .groupBy("members", "sum", "least").agg(F.min(F.struct("band", "hash")).alias("first"))
        .select(F.col("first.band").alias("band"), F.col("first.hash").alias("hash"), "members"))
    members = stage(keys.join(buckets, ["band", "hash"]).select(
        "node", "band", F.col("hash").alias("bucket"),
        F.ceil(F.col("members") / block).cast("int").alias("blocks")), "members")
    # the texts of these nodes, by the document that stands for each
    stands = stage(members.select("node").distinct().join(nodes, "node").select(
        "node", "rep_id", "copies", "bands"), "candidates")
    wanted = stands.select("rep_id").distinct()
    if stands.count() <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)
    key = free_name(docs, "rep_id")
    texts = docs.join(wanted.withColumnRenamed("rep_id", key),
                      docs[doc_id].eqNullSafe(F.col(key)), "left_semi").select(text)
    sets = texts.mapInArrow(_sets(words), "node binary, grams array<long>")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    placed = members.withColumn("block", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "node", "band", "bucket", "block", F.least("block", "other").alias("low"),
        F.greatest("block", "other").alias("high"))
    tiled = placed.join(stands.drop("rep_id").join(sets, "node"), "node")
    return (tiled.repartition("bucket", "low", "high")
            .sortWithinPartitions("bucket", "low", "high")
            .mapInArrow(_tiles(threshold), "node binary, links long, head binary"))


def join_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 threshold: float = THRESHOLD, recall: float = RECALL, words: int = WORDS,
                 block: int = BLOCK, tag: str | None = None) -> DataFrame:
    """One row per document: doc_id, class_id (smallest doc_id of its connected class),
    class_size, n_links (other documents at or above the threshold) and ``stays`` for the
    one row of the class that stands for it; and ``row_tag``, the column that ``tag`` names, if
    given, which must be binary and differ from row to row."""
    bands, rows = choose_bands(threshold, recall)
    name = tag or free_name(docs, "row_tag")
    given = docs if tag else docs.withColumn(name, numbered())
    signed = stage(given.select(F.struct(F.col(name).alias("tag"), F.col(doc_id).cast("long")
                                         .alias("doc_id")).alias("doc_id"), text)
                   .mapInArrow(_sign(bands, rows, words),
                               "doc_id struct<tag: binary, doc_id: long>, node binary, "
                               "bands array<long>")
                   .select("doc_id.tag", "doc_id.doc_id", "node", "bands"), "signatures")
    # equal sets are one node; documents without words are left alone
    nodes = stage(signed.filter("bands IS NOT NULL").groupBy("node").agg(
        F.min("doc_id").alias("rep_id"), F.count("*").alias("copies"),
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "tag")).alias("first"),
        F.first("bands").alias("bands")), "nodes")
    found = stage(_links(docs, nodes, doc_id, text, threshold, words, block), "links")
    roots = components(found.select("node", "head").distinct())
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    own = nodes.select("node", "rep_id", "copies", "first").join(roots, "node", "left").join(
        counts, "node", "left").select(
        "node", "rep_id", "copies", "first", F.coalesce("root", "node").alias("root"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    own = stage(own, "classes")
    classes = own.groupBy("root").agg(
        F.min("rep_id").alias("class_id"), F.sum("copies").alias("class_size"),
        F.min("first").alias("first"))
    placed = stage(own.drop("first").join(classes, "root").select(
        "node", "class_id", "class_size", "n_links", F.col("first.tag").alias("stays_tag")),
        "placed")
    with_words = signed.filter("bands IS NOT NULL").select("tag", "doc_id", "node").join(
        placed, "node").select(
        "tag", "doc_id", "class_id", "class_size", "n_links",
        (F.col("tag") == F.col("stays_tag")).alias("stays"))
    empty = signed.filter("bands IS NULL").select(
        "tag", "doc_id", F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("class_size"),
        F.lit(0).cast("long").alias("n_links"), F.lit(True).alias("stays"))
    out = with_words.unionByName(empty)
    return out.withColumnRenamed("tag", "row_tag") if tag else out.drop("tag")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One document of each class, that of the smallest doc_id, with the columns of ``docs``."""
    rows, tag = keyed(docs, doc_id, text, "batch-rows")
    given = rows.select(F.col(tag).alias("row_tag"), F.col(doc_id).alias("doc_id"),
                        F.col(text).alias("text"))
    gone = join_classes(given, tag="row_tag", **options).filter("NOT stays").select("row_tag")
    return without(rows, tag, stage(gone, "near-copies"))
