"""Exact duplicates by a persistent index of text digests.

The index is a bucketed and sorted table of SHA-256 digests at a path of its own. A batch is
reduced to one row per text before it meets the index in a sort-merge anti-join, for which
the index side is neither shuffled nor sorted again; what is new is appended. So the index
holds each text once, with the document that stays for it.

Null text counts as empty, and empty texts are equal to each other. Of equal texts in a
batch the row with the largest doc_id stays; a null doc_id is smaller than any other. Of rows that
repeat a doc_id and text exactly one stays. A text that an earlier batch has added is
dropped, whatever its doc_id. An empty batch leaves the index as it is.

A batch has a name. What an earlier attempt at the same batch has added counts as the batch's own, so
a job that died after it had added its texts is run again under the same name and keeps the same
rows. Without a name each call is a batch of its own.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import new_folder, stage
from .tables import keyed, tagged, without

_COLUMNS = "digest BINARY, keep_id BIGINT, keep_tag BINARY, batch STRING"


class DigestIndex:
    """Digest index at ``path``; its number of buckets is stored beside it."""

    def __init__(self, spark: SparkSession, path: str, buckets: int) -> None:
        self.spark, self.path, self.buckets = spark, path, buckets
        self.name = f"digest_index_{uuid.uuid4().hex}"
        spark.sql(f"CREATE TABLE {self.name} ({_COLUMNS}) USING parquet "
                  f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS "
                  f"LOCATION '{path}/digests'")

    @classmethod
    def create(cls, spark: SparkSession, path: str, buckets: int | None = None) -> DigestIndex:
        """A new index; by default with as many buckets as a shuffle has partitions."""
        buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        spark.createDataFrame([(buckets,)], "buckets int").coalesce(1).write.json(f"{path}/meta")
        return cls(spark, path, buckets)

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> DigestIndex:
        """An index that an earlier session has written."""
        return cls(spark, path, spark.read.json(f"{path}/meta").first()["buckets"])

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def append(self, fresh: DataFrame) -> None:
        """One file per bucket and batch: rows are dealt out as the buckets are."""
        (fresh.select("digest", "keep_id", "keep_tag", "batch")
         .repartition(self.buckets, "digest").write.mode("append").format("parquet")
         .bucketBy(self.buckets, "digest").sortBy("digest")
         .option("path", f"{self.path}/digests").saveAsTable(self.name))
        self.spark.catalog.refreshTable(self.name)

    def compact(self, path: str) -> DigestIndex:
        """The same digests in one sorted file per bucket, at a new path."""
        out = DigestIndex.create(self.spark, path, self.buckets)
        out.append(self.table())
        return out

    def close(self) -> None:
        """Forget the table's name; its files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def digest(text: str) -> F.Column:
    return F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256))


def deduplicate(digests: DataFrame, index: DigestIndex, batch: str | None = None) -> DataFrame:
    """Verdicts on a batch of ``(row_tag, doc_id, digest)``, which it adds to the index.

    Returns these columns with ``keep_id``, ``group_size`` (rows of the batch with this
    text) and ``kept``. ``digests`` must be a written table, as it is read twice.
    """
    batch = batch or uuid.uuid4().hex
    groups = (digests.groupBy("digest")
              .agg(F.max(F.struct("doc_id", "row_tag")).alias("keep"),
                   F.count("*").alias("group_size"))
              .select("digest", F.col("keep.doc_id").alias("keep_id"),
                      F.col("keep.row_tag").alias("keep_tag"), "group_size",
                      F.lit(batch).alias("batch")))
    known = index.table().hint("merge")
    fresh = stage(groups.join(known.select("digest"), "digest", "left_anti"), "fresh-digests")
    index.append(fresh)
    sizes = groups.select("digest", "group_size", F.col("keep_id").alias("own_id"), "keep_tag")
    added = index.table().select("digest", "keep_id", "batch").hint("merge")
    texts = stage(sizes.join(added, "digest").withColumn(
        "own", F.col("batch") == batch), "batch-digests")
    # one row per text against all rows: a hot text is on the side that Spark can split
    return digests.join(texts.hint("merge"), "digest").select(
        "row_tag", "doc_id", "digest",
        F.when(F.col("own"), F.col("own_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        "group_size", (F.col("own") & (F.col("row_tag") == F.col("keep_tag"))).alias("kept"))


def find_duplicates(docs: DataFrame, index: DigestIndex, doc_id: str = "doc_id",
                    text: str = "text", batch: str | None = None) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    rows, _ = tagged(docs.select(F.col(doc_id).alias("doc_id"), digest(text).alias("digest")),
                     "digests")
    return deduplicate(rows, index, batch).select(
        "doc_id", "keep_id", "group_size", "kept",
        F.lower(F.hex("digest")).alias("text_sha256"))


def drop_duplicates(docs: DataFrame, index: DigestIndex | None = None, doc_id: str = "doc_id",
                    text: str = "text", batch: str | None = None) -> DataFrame:
    """The rows that stay, with the columns of ``docs``.

    Without an index the batch is compared with itself only, by an index of its own.
    """
    own = None
    if index is None:
        index = own = DigestIndex.create(docs.sparkSession, new_folder(docs.sparkSession, "index"))
    rows, tag = keyed(docs, doc_id, text, "batch-rows")
    digests = stage(rows.select(F.col(tag).alias("row_tag"), F.col(doc_id).alias("doc_id"),
                                digest(text).alias("digest")), "digests")
    gone = stage(deduplicate(digests, index, batch).filter("NOT kept").select("row_tag"), "duplicate-rows")
    if own:
        own.close()
    return without(rows, tag, gone)
