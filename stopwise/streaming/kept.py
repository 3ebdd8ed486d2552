"""Small tables that micro-batches keep up to date: a row per key, in hash buckets.

A bucket has two slots. A batch reads the newest slot of the buckets it touches, merges its
own rows, and replaces the other slot by dynamic partition overwrite. The slot it read stays
as it is, so a batch that fails half way and runs again, on this driver or the next, starts
from the same rows and gives the same table. Rows name the batch that wrote them; a bucket's
newest slot is the one of the highest batch.

Work per batch follows the keys it touches, not the history: what was folded in once is never
read from the sink again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

Merge = Callable[[DataFrame], DataFrame]

BUCKETS = 16     # touched buckets are rewritten whole: take more of them for larger tables


def newest(keys: list[str], order: list[str]) -> Merge:
    """Of rows of equal keys the one of the greatest ``order``; nulls are the least."""

    def merge(rows: DataFrame) -> DataFrame:
        kept = F.max_by(F.struct(*rows.columns), F.struct(*order))
        return rows.groupBy(*(F.col(k).alias(f"_key_{k}") for k in keys)).agg(
            kept.alias("_row")).select("_row.*")

    return merge


def totals(keys: list[str], sums: list[str]) -> Merge:
    """Rows of equal keys with their numbers added."""

    def merge(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in sums))

    return merge


class KeptTable:
    """A Parquet table of one row per key. ``merge`` combines rows of equal keys.

    ``merge`` must give the same row however rows are grouped, as ``newest`` and ``totals`` do.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType | str, keys: list[str],
                 merge: Merge, buckets: int = BUCKETS) -> None:
        self.spark, self.path, self.keys, self.merge, self.buckets = spark, path, keys, merge, buckets
        self.schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        self.columns = self.schema.fieldNames()

    def _slots(self) -> DataFrame:
        stored = T.StructType([*self.schema.fields, T.StructField("written_by", T.LongType()),
                               T.StructField("bucket", T.IntegerType()),
                               T.StructField("slot", T.IntegerType())])
        try:
            return self.spark.read.schema(stored).parquet(self.path)
        except AnalysisException as error:       # nothing was written yet
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], stored)

    def _newest_slots(self, before: int | None, buckets: list[int] | None = None) -> dict[int, int]:
        """The slot that holds each bucket, as batches before ``before`` left it."""
        slots = self._slots()
        if buckets is not None:
            slots = slots.filter(F.col("bucket").isin(buckets))
        if before is not None:
            slots = slots.filter(F.col("written_by") < before)
        # at most two rows a bucket reach the driver
        found = slots.groupBy("bucket").agg(F.max_by("slot", "written_by").alias("slot"))
        return {r["bucket"]: r["slot"] for r in found.collect()}

    def read(self, before: int | None = None, buckets: list[int] | None = None) -> DataFrame:
        """The table, or the given buckets of it, as batches before ``before`` left it."""
        return self._held(self._newest_slots(before, buckets)).select(*self.columns)

    def _held(self, slots: dict[int, int]) -> DataFrame:
        if not slots:
            return self._slots().filter(F.lit(False))
        by_slot = [F.col("bucket").isin([b for b, s in slots.items() if s == slot])
                   & (F.col("slot") == slot) for slot in set(slots.values())]
        chosen = by_slot[0] if len(by_slot) == 1 else by_slot[0] | by_slot[1]
        return self._slots().filter(chosen)

    def fold(self, rows: DataFrame, batch_id: int) -> None:
        """Merge the rows of a batch into the table. A repeated batch changes nothing."""
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        mine = self.merge(rows.select(*self.columns))
        touched = [r["bucket"] for r in mine.select(bucket.alias("bucket")).distinct().collect()]
        if not touched:
            return
        slots = self._newest_slots(batch_id, touched)
        old = self._held(slots).select(*self.columns)
        merged = self.merge(old.unionByName(mine)).withColumn("bucket", bucket)
        other = F.lit(0)
        for b, slot in slots.items():
            if slot == 0:
                other = F.when(F.col("bucket") == b, F.lit(1)).otherwise(other)
        (merged.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields),
                       F.lit(batch_id).cast("long").alias("written_by"), "bucket",
                       other.cast("int").alias("slot"))
         .repartition(F.col("bucket"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("bucket", "slot").parquet(self.path))
