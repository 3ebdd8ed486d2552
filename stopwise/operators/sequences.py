"""Per-key sequence operations that split a hot key over many tasks.

A key's rows are cut into segments of bounded length. Windows run per (key, segment);
only one summary row per segment is ordered across the whole key, to carry values
over the cuts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def segment_of(position: Column, length: int) -> Column:
    return F.floor(position / length)


def number_within_key(df: DataFrame, key: str, position: str, name: str,
                      segment_rows: int = 2 ** 18) -> DataFrame:
    """0-based row number per key in the order of a unique integer column."""
    cut = df.withColumn("_segment", segment_of(F.col(position), segment_rows))
    along = Window.partitionBy(key).orderBy("_segment").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = (cut.groupBy(key, "_segment").agg(F.count("*").alias("_n"))
              .select(key, "_segment", F.coalesce(F.sum("_n").over(along), F.lit(0))
                      .alias("_start")))
    inside = Window.partitionBy(key, "_segment").orderBy(position)
    return (cut.withColumn("_row", F.row_number().over(inside))
            .join(starts, [key, "_segment"])
            .withColumn(name, F.col("_start") + F.col("_row") - 1)
            .drop("_segment", "_start", "_row"))
