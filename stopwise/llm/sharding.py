"""Sharding by extendible hashing: oversized buckets split on one more bit of the hash.

The directory follows from sizes alone. Documents are summed once per cell of a fine
prefix, the cells are rolled up to every shorter prefix, and a shard is the shortest prefix
whose documents fit the byte limit. Cells that are still too large at the fine prefix go on
with the next bits of the hash; rows equal in id and text have equal hashes, and are told
apart by a hash of their own row number. One document above the limit is a shard of its own.

Null or repeated doc_id: the hash is taken from the doc_id and, where that is null, from the
text. A null text has no bytes. An empty table has no shards.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

from ..session import stage
from .tables import free_name, keyed, tagged

LIMIT_BYTES = 1 << 20
BITS = 60            # of one hash; further hashes follow when they are used up
SPARE_BITS = 6       # of a cell beyond an even split


def hash_bits(column: F.Column) -> F.Column:
    """60 bits of an MD5, as a long."""
    return F.conv(F.substring(F.md5(column), 1, 15), 16, 10).cast("long")


def _prefix(key: str, depth: int | F.Column) -> F.Column:
    if isinstance(depth, int):
        return F.shiftrightunsigned(F.col(key), BITS - depth)
    return F.call_function("shiftrightunsigned", F.col(key), (F.lit(BITS) - depth).cast("int"))


def _split(cells: DataFrame, depth: int, limit: int) -> DataFrame:
    """Shards ``(path, depth, prefix, shard_docs, shard_bytes, fits)`` of cells summed at ``depth``."""
    nodes = (cells.withColumn("d", F.explode(F.sequence(F.lit(0), F.lit(depth))))
             .groupBy("path", "d", F.call_function(
                 "shiftrightunsigned", F.col("cell"),
                 (F.lit(depth) - F.col("d")).cast("int")).alias("prefix"))
             .agg(F.sum("docs").alias("shard_docs"), F.sum("bytes").alias("shard_bytes")))
    nodes = nodes.withColumn("fits", (F.col("shard_bytes") <= limit) | (F.col("shard_docs") <= 1))
    above = nodes.filter("NOT fits").select(
        F.col("path").alias("path_"), (F.col("d") + 1).alias("d_"),
        F.col("prefix").alias("prefix_"))
    child = nodes.join(above, F.col("path").eqNullSafe(F.col("path_")) & (F.col("d") == F.col("d_"))
                       & (F.shiftright("prefix", 1) == F.col("prefix_")), "left")
    return child.filter((F.col("fits") | (F.col("d") == depth))
                        & ((F.col("d") == 0) | F.col("d_").isNotNull())).select(
        "path", F.col("d").alias("depth"), "prefix", "shard_docs", "shard_bytes", "fits")


def _bits(prefix: F.Column, depth: F.Column) -> F.Column:
    return F.when(depth == 0, "").otherwise(F.lpad(F.bin(prefix), depth, "0"))


def assign_shards(docs: DataFrame, limit: int = LIMIT_BYTES, doc_id: str = "doc_id",
                  text: str = "text", spare_bits: int = SPARE_BITS) -> DataFrame:
    """One row per document: doc_id, shard (its hash bits), depth, shard_docs, shard_bytes."""
    rows, _ = tagged(_sized(docs, doc_id, text), "sizes")
    return _assign(rows, limit, spare_bits).drop("row_tag")


def _sized(docs: DataFrame, doc_id: str, text: str, *more: F.Column) -> DataFrame:
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long")
    name = F.coalesce(F.col(doc_id).cast("string"), F.concat(F.lit("text "), F.md5(text)),
                      F.lit(""))
    return docs.select(F.col(doc_id).alias("doc_id"), size.alias("bytes"),
                       hash_bits(name).alias("key"), *more)


def _assign(rows: DataFrame, limit: int, spare_bits: int) -> DataFrame:
    """The shards of a written table of sized rows with ``row_tag``."""
    parts, left, offset, round_ = [], rows.withColumn("path", F.lit("")), 0, 0
    while True:
        total = left.agg(F.sum("bytes").alias("b"), F.count("*").alias("n"),
                         F.count_distinct("path").alias("k")).first()
        if not total["n"]:
            break
        depth = math.ceil(math.log2(max(1, total["b"] / max(1, limit)) / max(1, total["k"])
                                    + 1)) + spare_bits
        depth = min(BITS, max(1, depth))
        cells = left.groupBy("path", _prefix("key", depth).alias("cell")).agg(
            F.count("*").alias("docs"), F.sum("bytes").alias("bytes"))
        shards = stage(_split(cells, depth, limit), "shards")
        # each cell of the fine prefix belongs to one shard
        span = F.call_function("shiftleft", F.lit(1).cast("long"),
                               (F.lit(depth) - F.col("depth")).cast("int"))
        first = F.call_function("shiftleft", F.col("prefix"),
                                (F.lit(depth) - F.col("depth")).cast("int"))
        own = cells.select("path", "cell").join(
            shards.withColumn("cell", F.explode(F.sequence(first, first + span - 1))),
            ["path", "cell"])
        placed = left.withColumn("cell", _prefix("key", depth)).join(own, ["path", "cell"])
        path = F.concat("path", _bits(F.col("prefix"), F.col("depth")))
        parts.append(placed.filter("fits").select(
            "row_tag", "doc_id", path.alias("shard"), (F.lit(offset) + F.col("depth")).cast("int").alias("depth"),
            "shard_docs", "shard_bytes"))
        if not shards.filter("NOT fits").limit(1).count():
            break
        offset, round_ = offset + depth, round_ + 1
        # the bits that were used are gone; equal hashes go on with one of the row number
        fresh = F.when(F.lit(offset >= BITS), hash_bits(
            F.concat(F.hex("row_tag"), F.lit(f" {round_}"))))
        used = F.call_function("shiftleft", F.col("key"), F.lit(depth)).bitwiseAND(
            F.lit((1 << BITS) - 1).cast("long"))
        left = stage(placed.filter("NOT fits").select(
            "row_tag", "doc_id", "bytes", F.coalesce(fresh, used).alias("key"),
            path.alias("path")), "oversized")
    out = parts[0] if parts else rows.select(
        "row_tag", "doc_id", F.lit("").alias("shard"), F.lit(0).alias("depth"),
        F.lit(0).cast("long").alias("shard_docs"), F.col("bytes").alias("shard_bytes"))
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def write_shards(docs: DataFrame, path: str, limit: int = LIMIT_BYTES, doc_id: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """Write ``docs`` with one folder per shard, ``path/shard=<bits>``; returns the directory.

    Every row goes to the task of its shard, whose size the limit bounds. Rows find their shard
    by a key of their own, so repeated ids and repeated rows are written as often as they are given.
    """
    rows, tag = keyed(docs, doc_id, text, "sharded-rows")
    sizes = stage(_sized(rows, doc_id, text, F.col(tag).alias("row_tag")), "sizes")
    shards = stage(_assign(sizes, limit, SPARE_BITS), "assignment")
    key, name = free_name(rows, "shard_of"), free_name(docs, "shard")
    placed = rows.join(shards.select(F.col("row_tag").alias(key),
                                     F.concat(F.lit("b"), "shard").alias(name)),
                       F.col(tag) == F.col(key)).drop(key, tag)
    placed.repartition(name).write.partitionBy(name).parquet(path)
    return shards.select("shard", "depth", "shard_docs", "shard_bytes").distinct()
