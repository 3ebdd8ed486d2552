"""Result tables and model artefacts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.forest import DelayForest
from ..schemas import LIVE_STATUS, TRAINING


def _read(spark: SparkSession, path: str, fmt: str, schema) -> DataFrame:
    return spark.read.format(fmt).schema(schema).option("header", True).load(path)


def read_training(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return _read(spark, path, fmt, TRAINING)


def read_live_status(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return _read(spark, path, fmt, LIVE_STATUS)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: tuple[str, ...] = ()) -> str:
    """Write part files in parallel; readers take the folder as one table."""
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return path


def save_model(model: DelayForest, path: str) -> str:
    return model.save(path)


def load_model(path: str | None) -> DelayForest | None:
    """The saved forest, or None when there is none: callers then show the heuristic only."""
    if not path:
        return None
    spark = SparkSession.active()
    try:
        spark.read.text(f"{path.rstrip('/')}/metadata")
    except Exception as missing:
        if "PATH_NOT_FOUND" in str(missing):
            return None
        raise
    return DelayForest.load(spark, path)
