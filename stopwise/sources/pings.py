"""Vehicle position files, as a batch or as a stream.

CSV columns are taken by the name in the header, in any order and spelling that the feed
has used. Files that are read together must agree in their header, which Spark checks file
by file; snapshots of another layout are passed as a further path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..operators.clean import normalise_headers, select_available, stamp_snapshot
from ..schemas import PING_CSV, PING_JSON

#: Columns without which a ping cannot be placed. The feed's names.
REQUIRED = ("codBus", "codLinea", "sentido", "lat", "lon", "last_update")

#: Header of a feed folder in which no file has landed yet. The feed's order.
FEED_HEADER = ("codBus", "codLinea", "sentido", "lon", "lat", "codParIni", "last_update")


def _as_pings(raw: DataFrame) -> DataFrame:
    named = normalise_headers(raw)
    missing = [c for c in REQUIRED if c not in named.columns]
    if missing:
        raise ValueError(f"ping files lack the columns {', '.join(missing)}")
    extra = [c for c in ("snapshot_time",) if c in named.columns]
    return select_available(named, [*PING_CSV.names, *extra])


def _header(spark: SparkSession, path: str) -> list[str]:
    """Column names in the first file of a path; none while the path has no file."""
    try:
        return spark.read.option("header", True).csv(path).columns
    except Exception as missing:
        if "PATH_NOT_FOUND" in str(missing) or "UNABLE_TO_INFER_SCHEMA" in str(missing):
            return []
        raise


def _strings(names) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in names])


def read_ping_history(spark: SparkSession, path: str | list[str], fmt: str = "csv", *,
                      stamp: bool = False) -> DataFrame:
    """All snapshots under a path, glob or list of them. Spark lists the files.

    ``stamp`` adds ``snapshot_time``, when each snapshot's file was written.
    """
    if fmt != "csv":
        raw = spark.read.format(fmt).schema(PING_JSON).load(path)
        return stamp_snapshot(raw, from_file=True) if stamp else raw
    parts = []
    for one in [path] if isinstance(path, str) else path:
        reader = spark.read.option("header", True).option("enforceSchema", False)
        raw = reader.schema(_strings(_header(spark, one))).csv(one)
        parts.append(_as_pings(stamp_snapshot(raw, from_file=True) if stamp else raw))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def read_ping_stream(spark: SparkSession, path: str, fmt: str = "csv",
                     max_files: int | None = 1000, header: list[str] | None = None
                     ) -> DataFrame:
    """Snapshots as they land in a folder, at most ``max_files`` in a micro-batch.

    The header is that of the files that are there, or ``header``; a later file with
    another one fails loudly. None for ``max_files`` takes the whole backlog at once.
    """
    reader = spark.readStream.format(fmt)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if fmt != "csv":
        return reader.schema(PING_JSON).load(path)
    names = header or _header(spark, path) or FEED_HEADER
    return _as_pings(reader.option("header", True).option("enforceSchema", False)
                     .schema(_strings(names)).load(path))
