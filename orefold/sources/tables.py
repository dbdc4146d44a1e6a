"""Catalog tables in Parquet, and small texts beside them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def overwrite_table(df: DataFrame, table: str, comment: str | None = None) -> DataFrame:
    """Replace ``table`` by ``df`` and return the stored table.

    The rows are written beside those that ``table`` shows, so a failed write leaves the
    former ones readable, and there is no moment without a table. Only the latest two
    versions are kept. Later steps use the returned DataFrame, so nothing upstream is
    computed twice.
    """
    from .versions import Retention, publish

    return publish(df, table, comment, retention=Retention(keep_last=2))


def escaped(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def _file(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def read_text(spark: SparkSession, path: str) -> str | None:
    """The first line of a small file, or None without such a file."""
    where, files = _file(spark, path)
    if not files.exists(where):
        return None
    java = spark._jvm.java.io
    reader = java.BufferedReader(java.InputStreamReader(files.open(where), "UTF-8"))
    try:
        return reader.readLine()
    finally:
        reader.close()


def write_text(spark: SparkSession, path: str, text: str) -> str:
    where, files = _file(spark, path)
    out = files.create(where, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    return text


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a folder."""
    where, files = _file(spark, path)
    return files.getContentSummary(where).getLength() if files.exists(where) else 0
