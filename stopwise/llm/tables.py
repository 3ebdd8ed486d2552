"""Reading the given tables and naming helper columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import stage


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/documents.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or with underscores before it while the frame has such a column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def numbered() -> F.Column:
    """8 bytes that differ from row to row, as long as rows are not read again."""
    return F.unhex(F.lpad(F.hex(F.monotonically_increasing_id()), 16, "0"))


def tagged(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """The frame written once with a number of its own for every row.

    A number given on the fly could differ between two reads of the same rows; the
    written one does not, so repeated rows can be told apart in every later step.
    """
    tag = free_name(df, "row_tag")
    return stage(df.withColumn(tag, numbered()), name), tag


def keyed(docs: DataFrame, doc_id: str, text: str, name: str) -> tuple[DataFrame, str]:
    """The frame with a key of its own for every row, the same at every read.

    The key is a digest of doc_id and text, which needs no copy of the texts. Only when
    rows repeat both is the frame written once with numbers instead.
    """
    key = free_name(docs, "row_tag")
    own = docs.withColumn(key, F.unhex(F.md5(F.concat(
        F.coalesce(F.col(doc_id).cast("string"), F.lit("-")),
        F.when(F.col(text).isNull(), F.lit("?")).otherwise(F.concat(F.lit("="), text))))))
    repeated = own.groupBy(key).count().filter("count > 1").limit(1)
    return (own, key) if repeated.isEmpty() else tagged(docs, name)


def without(rows: DataFrame, key: str, gone: DataFrame, bound: int = 500_000) -> DataFrame:
    """The rows whose key is not in the one column of ``gone``, which is a written table.

    It is broadcast while it has no more than ``bound`` keys, else joined by a shuffle.
    """
    other = free_name(rows, "gone")
    gone = gone.toDF(other)
    if gone.count() <= bound:
        gone = F.broadcast(gone)
    return rows.join(gone, rows[key] == F.col(other), "left_anti").drop(key)
