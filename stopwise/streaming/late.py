"""Late and repeated rows of a stream, kept beside the accepted ones and counted.

Spark's own watermark drops late rows inside a stateful operator, where nothing can be done with
them. Here each micro-batch is split before anything else sees it: rows older than the newest
time of the batches before it, less an allowance, are late; rows whose key was accepted already
are repeated; the rest is accepted. What the split needs to know is in two kept tables, the
newest time and the keys that a row could still repeat, which are those within the allowance.
So a batch that runs again after a failure is split in the same way.

Landed rows are accepted, late or repeated, each exactly one of them; the counts of every batch
are observed while it is written. Rows without a time are late.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, Window, functions as F

from .kept import BUCKETS, KeptTable, newest

_MARK = "name string, newest_s bigint"
COUNTS = "batch_id bigint, landed bigint, accepted bigint, late bigint, repeated bigint"


class LateRows:
    """Splits the batches of one query. ``folder`` has its state, ``late_path`` the late rows."""

    def __init__(self, spark: SparkSession, folder: str, allowance_s: int, keys: str =
                 "codBus string, event_s bigint", time: str = "event_s",
                 order: tuple[str, ...] = ("lat", "lon", "direction_id"), buckets: int = BUCKETS) -> None:
        self.allowance_s, self.time, self.order = allowance_s, time, order
        self.late_path = f"{folder}/late"
        self.marks = KeptTable(spark, f"{folder}/mark", _MARK, ["name"], newest(["name"], ["newest_s"]), 1)
        self.names = [c.split()[0] for c in keys.split(", ")]
        self.seen = KeptTable(spark, f"{folder}/seen", keys, self.names, self._recent(None), buckets)
        self.counts = KeptTable(spark, f"{folder}/counts", COUNTS, ["batch_id"],
                                newest(["batch_id"], ["landed"]), 1)

    def _recent(self, mark: int | None):
        def merge(rows: DataFrame) -> DataFrame:
            kept = rows if mark is None else rows.filter(F.col(self.time) >= mark)
            return kept.select(*self.names).distinct()

        return merge

    def split(self, batch: DataFrame, batch_id: int) -> tuple[DataFrame, Observation]:
        """The rows with their ``state``, and its counts once the rows have been read."""
        found = self.marks.read(before=batch_id).first()
        mark = None if found is None else found["newest_s"] - self.allowance_s
        time = F.col(self.time)
        late = time.isNull() if mark is None else time.isNull() | (time < mark)
        rank = F.row_number().over(Window.partitionBy(*self.names).orderBy(*self.order))
        seen = self.seen.read(before=batch_id).withColumn("_seen", F.lit(True))
        # late rows stay out of the ranking, so that their keys need not meet
        onward = batch.filter(~late).withColumn("_rank", rank).join(seen, self.names, "left")
        state = F.when(F.col("_seen") | (F.col("_rank") > 1), "repeated").otherwise("accepted")
        marked = onward.withColumn("state", state).select(*batch.columns, "state").unionByName(
            batch.filter(late).withColumn("state", F.lit("late")))
        told = Observation()
        marked = marked.observe(told, F.count("*").alias("landed"), *(
            F.count_if(F.col("state") == s).alias(s) for s in ("accepted", "late", "repeated")))
        return marked, told

    def remember(self, accepted: DataFrame, counts: dict[str, int], batch_id: int) -> None:
        """Folds a batch into the state, after its rows were written."""
        spark = accepted.sparkSession
        top = accepted.agg(F.max(self.time)).first()[0]
        before = self.marks.read(before=batch_id).first()
        high = max([x for x in (top, before and before["newest_s"]) if x is not None], default=None)
        if high is not None:
            self.marks.fold(spark.createDataFrame([("newest", high)], _MARK), batch_id)
            self.seen.merge = self._recent(high - self.allowance_s)
            self.seen.fold(accepted.select(*self.names), batch_id)
        self.counts.fold(spark.createDataFrame(
            [(batch_id, *(counts[c] for c in ("landed", "accepted", "late", "repeated")))], COUNTS), batch_id)
