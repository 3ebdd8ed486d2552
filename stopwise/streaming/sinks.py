"""Micro-batch sinks that give the same tables when a batch is repeated.

The history of a query is a folder per batch. Compaction folds the older ones into one folder
``through=N`` that is complete once its ``_SUCCESS`` is there; readers take the newest complete
one and the batches after it, so no reader sees a batch twice or not at all while it runs.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.joins import released_after
from .kept import KeptTable
from .late import LateRows

#: A kept table, and what of a batch is folded into it.
Kept = tuple[KeptTable, Callable[[DataFrame], DataFrame]]


def start_query(
    df: DataFrame,
    path: str | None,
    checkpoint: str,
    *,
    step: Callable[[DataFrame], DataFrame] | None = None,
    keep: list[Kept] | None = None,
    late: LateRows | None = None,
    output_mode: str = "append",
    every: str | None = None,
) -> StreamingQuery:
    """Write each micro-batch to its own ``batch_id`` folder of a Parquet table.

    A batch that runs again after a failure overwrites its folder. ``step`` is a batch
    transformation applied first. ``keep`` lists tables that each batch is folded into; with
    ``path`` None there is no history beside them. ``late`` takes late and repeated rows out
    before all that and writes the late ones to a folder of its own. Without ``every`` the query
    stops after the files that are there.
    """
    keep = keep or []

    def write(batch: DataFrame, batch_id: int) -> None:
        with released_after():
            if late is None:
                put(batch, batch_id)
                return
            marked, told = late.split(batch, batch_id)
            marked = marked.persist()
            try:
                marked.filter("state = 'late'").drop("state").write.mode("overwrite").parquet(
                    f"{late.late_path}/batch_id={batch_id}")
                accepted = marked.filter("state = 'accepted'").drop("state")
                put(accepted, batch_id)
                late.remember(accepted, told.get, batch_id)
            finally:
                marked.unpersist()

    def put(batch: DataFrame, batch_id: int) -> None:
        out = step(batch) if step else batch
        if keep:             # folding reads the batch more than once
            out = out.persist()
        try:
            if path is not None:
                out.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
            for table, part in keep:
                table.fold(part(out), batch_id)
        finally:
            if keep:
                out.unpersist()

    writer = (df.writeStream.outputMode(output_mode)
              .option("checkpointLocation", checkpoint).foreachBatch(write))
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()


def run_available(df: DataFrame, path: str | None, checkpoint: str, *,
                  limit_s: int | None = None, **options) -> None:
    """Process what has landed, then stop; with ``limit_s``, fail when it takes longer."""
    query = start_query(df, path, checkpoint, **options)
    try:
        if limit_s is None:
            query.awaitTermination()
        elif not query.awaitTermination(limit_s):
            raise TimeoutError(f"stream still busy after {limit_s} s")
    finally:
        query.stop()


def _folders(spark: SparkSession, path: str) -> tuple[int | None, list[int], list[str]]:
    """The newest complete compaction, the batches after it, and the folders both replace."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(place):
        return None, [], []
    names = [s.getPath().getName() for s in files.listStatus(place)]
    found = {kind: sorted(int(m[1]) for n in names if (m := re.fullmatch(rf"{kind}=(\d+)", n)))
             for kind in ("through", "batch_id")}

    def complete(n: int) -> bool:
        return files.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/through={n}/_SUCCESS"))

    through = next((n for n in reversed(found["through"]) if complete(n)), None)
    last = -1 if through is None else through
    batches = [n for n in found["batch_id"] if n > last]
    replaced = [f"batch_id={n}" for n in found["batch_id"] if n <= last]
    return through, batches, replaced + [f"through={n}" for n in found["through"] if n < last]


def read_sink(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """The rows of all batches, with ``batch_id``."""
    through, batches, _ = _folders(spark, path)
    parts = []
    if through is not None:
        parts.append(spark.read.parquet(f"{path}/through={through}"))
    if batches or through is None:
        reader = spark.read.option("basePath", path)
        if schema is not None:
            reader = reader.schema(schema)
        parts.append(reader.parquet(*([f"{path}/batch_id={n}" for n in batches] or [path]))
                     .withColumn("batch_id", F.col("batch_id").cast("long")))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def compact_sink(spark: SparkSession, path: str, *, newest: int = 10, files: int = 1) -> int | None:
    """Fold all but the ``newest`` batches into one folder, and return its last batch.

    The newest batches may still run again, so they stay as they are. Folders that an earlier
    compaction has taken in are removed first: readers that started before it have had the time
    between two compactions. The state tables of the query are not touched.
    """
    through, batches, replaced = _folders(spark, path)
    hadoop = spark._jvm.org.apache.hadoop.fs
    system = hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    for name in replaced:
        system.delete(hadoop.Path(f"{path}/{name}"), True)
    old = batches[:-newest] if newest else batches
    if not old:
        return through
    rows = spark.read.option("basePath", path).parquet(
        *[f"{path}/batch_id={n}" for n in old]).withColumn("batch_id", F.col("batch_id").cast("long"))
    if through is not None:
        rows = spark.read.parquet(f"{path}/through={through}").unionByName(rows)
    rows.repartition(files).write.mode("overwrite").parquet(f"{path}/through={old[-1]}")
    return old[-1]
