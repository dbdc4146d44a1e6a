"""CSV landings: one folder holds the files of all four entities.

A file belongs to the entity its name starts with (``enrollments.csv``,
``enrollments_2024.csv``). Large landings use folders instead
(``enrollments_2024.csv/part-*.csv``), as Spark itself writes them.
"""

from __future__ import annotations

import csv
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.streaming import DataStreamReader

from .schemas import check_columns, text_schema
from .tables import read_text


# What one micro-batch takes at most: enough to fill a cluster, and a failed batch
# repeats no more than this.
MAX_BATCH_BYTES = 1 << 40
# The columns Spark gives a file of any format.
_FILE = "path string, modificationTime timestamp, length bigint, content binary"


def bound_batches(
    reader: DataStreamReader, max_files: int | None, max_bytes: int
) -> DataStreamReader:
    """Bound each micro-batch by ``max_files`` or, without it, by ``max_bytes``."""
    if max_files is not None:
        return reader.option("maxFilesPerTrigger", max_files)
    return reader.option("maxBytesPerTrigger", max_bytes)


def landing_path(landing: str, entity: str) -> str:
    return f"{landing.rstrip('/')}/{entity}*.csv"


def read_csv(
    spark: SparkSession,
    landing: str,
    entity: str,
    schema: T.StructType | None = None,
    widen: bool = False,
) -> DataFrame:
    """All files of ``entity``; every column is text, named by the header.

    ``enforceSchema=false`` makes a file with another header stop the read, where
    Spark would otherwise bind its columns by position. With ``widen`` the drops may have
    different headers: columns are bound by name, and are NULL in drops that lack them.
    """
    if widen:
        return read_files(spark, landed(spark, landing, entity), entity)
    return _checked(spark, schema).csv(landing_path(landing, entity))


def _checked(spark: SparkSession, schema: T.StructType | None):
    reader = spark.read.option("header", True).option("enforceSchema", False)
    return reader if schema is None else reader.schema(schema)


def landed(spark: SparkSession, landing: str, entity: str) -> list[str]:
    """The drops of ``entity``, files or folders, in the order of their names."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(landing_path(landing, entity))
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern)
    return sorted(f.getPath().toString() for f in found or [])


def header_of(spark: SparkSession, drop: str) -> tuple[str, ...] | None:
    """Column names of a drop, from its first file that has any; None if all are empty.

    Only first lines are read. The files of a folder must share a header, or reading them stops.
    """
    where = spark._jvm.org.apache.hadoop.fs.Path(drop)
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())
    inside = sorted(
        f.getPath().toString()
        for f in files.listStatus(where)
        if not f.getPath().getName().startswith(("_", ".")) and f.getLen()
    )
    for file in inside:
        line = read_text(spark, file)
        if line and line.strip("\ufeff"):
            return tuple(next(csv.reader([line.strip("\ufeff")])))
    return None


def read_files(spark: SparkSession, drops: Iterable[str], entity: str) -> DataFrame:
    """Drops whose headers may differ, one read for each header, put together by name."""
    drops = list(drops)
    if not drops:
        raise FileNotFoundError(f"no files of {entity}")
    # A first line each, however large the drop.
    with ThreadPoolExecutor(max_workers=16) as pool:
        headers = list(pool.map(lambda d: header_of(spark, d), drops))
    by_header: dict[tuple[str, ...], list[str]] = {}
    for drop, header in zip(drops, headers, strict=True):
        if header is not None:
            check_columns(entity, header, drop)
            by_header.setdefault(header, []).append(drop)
    if not by_header:
        return spark.createDataFrame([], text_schema(entity))
    parts = [
        _checked(spark, T.StructType([T.StructField(c, T.StringType()) for c in header])).csv(paths)
        for header, paths in by_header.items()
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def stream_csv(
    spark: SparkSession,
    landing: str,
    entity: str,
    schema: T.StructType,
    layout: str = "files",
    max_files: int | None = None,
    max_bytes: int = MAX_BATCH_BYTES,
) -> DataFrame:
    """The files of ``entity`` as a stream that takes each file once.

    ``layout="files"`` expects plain files in the landing folder, ``"folders"``
    folders of part files.
    """
    reader = (
        spark.readStream.schema(schema).option("header", True).option("enforceSchema", False)
    )
    pattern, folder = _files_of(landing, entity, layout)
    reader = bound_batches(reader, max_files, max_bytes)
    return reader.option("pathGlobFilter", pattern).csv(folder)


def _files_of(landing: str, entity: str, layout: str) -> tuple[str, str]:
    if layout == "files":
        return f"{entity}*.csv", landing
    if layout == "folders":
        return "*.csv", landing_path(landing, entity) + "/"
    raise ValueError(f"layout must be 'files' or 'folders', not {layout!r}")


def stream_names(
    spark: SparkSession,
    landing: str,
    entity: str,
    layout: str = "files",
    max_files: int | None = None,
    max_bytes: int = MAX_BATCH_BYTES,
) -> DataFrame:
    """The names of new files as a stream that gives each file once. Contents are not read:
    ``read_files`` does that for a micro-batch, whatever headers it has."""
    pattern, folder = _files_of(landing, entity, layout)
    reader = spark.readStream.format("binaryFile").schema(_FILE)
    reader = bound_batches(reader, max_files, max_bytes).option("pathGlobFilter", pattern)
    return reader.load(folder).select("path")


def write_csv(df: DataFrame, landing: str, entity: str, drop: str = "") -> None:
    """Write ``df`` as one drop of ``entity`` (a folder of part files with headers)."""
    suffix = f"_{drop}" if drop else ""
    df.write.option("header", True).csv(f"{landing.rstrip('/')}/{entity}{suffix}.csv")
