"""Tables that keep every version written to them.

A version is one partition ``_version=n`` of an ordinary Parquet table; a second
table lists what happened to each version. The history row is added after the
rows are stored, so a version that was only half written is never seen, and the
next write replaces it. Any number of readers, one writer at a time.

``publish`` replaces a table of a pipeline that way: the name is a view of the latest
version, so the former rows can be read until the new ones are complete, and after.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.numbers import quoted
from ..operators.layout import FILE_BYTES, cluster_by
from .columns import fitted
from .tables import escaped, stored_bytes

VERSION = "_version"
_WRITE_KINDS = ("WRITE", "CLUSTER")
_EXPIRE = "EXPIRE"


def versions_of(spark: SparkSession, table: str) -> VersionedTable:
    """The versions behind a table that ``publish`` writes."""
    return VersionedTable(spark, f"{table}_versions", shown_as=table)


@dataclass(frozen=True)
class Retention:
    """Which older versions a run removes when it has published a new one; see ``expire``."""

    keep_last: int | None = None
    older_than: timedelta | None = None

    def apply(self, versions: VersionedTable) -> list[int]:
        if self.keep_last is None and self.older_than is None:
            return []
        before = None if self.older_than is None else datetime.now() - self.older_than
        return versions.expire(self.keep_last, before)


def show(spark: SparkSession, name: str, rows: str, comment: str | None = None) -> None:
    """Let ``name`` show the rows that the SQL text ``rows`` selects."""
    note = f"COMMENT '{escaped(comment)}'" if comment else ""
    spark.sql(f"CREATE OR REPLACE VIEW {name} {note} AS {rows}")


def publish(
    df: DataFrame,
    table: str,
    comment: str | None = None,
    widen: bool = False,
    retention: Retention | None = None,
) -> DataFrame:
    """Write ``df`` as the next version of ``table`` and let the name show it.

    Returns the stored rows of this version. If the write fails, the name and its
    rows stay as they were. ``widen`` lets the table gain columns; ``retention`` removes
    older versions once the new one is shown.
    """
    spark = df.sparkSession
    versions = versions_of(spark, table)
    number = versions.write(df, widen=widen)
    columns = spark.table(versions.table).columns[:-1] if widen else df.columns
    show(spark, table, versions.rows_as_sql(number, columns), comment)
    if retention:
        retention.apply(versions)
    return spark.table(table)


def store_partition(
    df: DataFrame, table: str, version: int, widen: bool = False
) -> None:
    """Store ``df`` as the partition ``_version=version`` of ``table``, replacing what a
    stopped attempt may have left there. The table is created if need be."""
    spark = df.sparkSession
    stamped = df.withColumn(VERSION, F.lit(version))
    if not spark.catalog.tableExists(table):
        create_table(spark, df.schema, table, by_version=True)
    # A failed attempt may have left rows under this number, known to the catalog or not.
    part = f"PARTITION ({VERSION}={version})"
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {part}")
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {part}")
    # The partition is empty now, and rows may come from another version of the same table.
    fitted(stamped, table, widen, VERSION).write.mode("append").insertInto(table)


def create_table(spark: SparkSession, schema: T.StructType, table: str, by_version: bool = False) -> None:
    """An empty table, by its definition alone: no job, and rows that are observed stay unread."""
    nullable = T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])
    columns = spark.createDataFrame([], nullable)._jdf.schema().toDDL()
    if by_version:
        spark.sql(f"CREATE TABLE {table} ({columns}, {VERSION} INT) USING parquet PARTITIONED BY ({VERSION})")
    else:
        spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet")


class VersionedTable:
    """``shown_as`` names the view that must follow when the rows are laid out anew."""

    def __init__(self, spark: SparkSession, table: str, shown_as: str | None = None) -> None:
        self.spark = spark
        self.table = table
        self.history_table = f"{table}_history"
        self.shown_as = shown_as

    # -- writing -------------------------------------------------------------

    def write(
        self,
        df: DataFrame,
        operation: str = "WRITE",
        version: int | None = None,
        widen: bool = False,
    ) -> int:
        """Store ``df`` as the next version and return its number, from 0 up.

        ``version`` names a number beyond the latest, where numbers mean something to the
        caller. ``widen`` lets the table gain columns that ``df`` has and it has not.
        """
        if operation not in _WRITE_KINDS:
            raise ValueError(f"operation must be one of {_WRITE_KINDS}")
        latest = self.latest()
        following = 0 if latest is None else latest + 1
        version = following if version is None else version
        if version < following:
            raise ValueError(f"version {version} of {self.table} is not beyond {latest}")
        self._store(df, version, widen)
        rows = (
            self.spark.table(self.table)
            .filter(F.col(VERSION) == version)
            .agg(F.count(F.lit(1)).alias("num_rows"))
        )
        self._record(rows.withColumns({"version": F.lit(version), "operation": F.lit(operation)}))
        return version

    def cluster(self, columns: str | Sequence[str], partitions: int | None = None) -> int:
        """Write the latest rows again, range-partitioned by ``columns``, by several of them
        along a Z curve. The number of files follows from the bytes of the latest version."""
        rows = self.read()
        if partitions is None:
            partitions = max(1, -(-self._stored_bytes(self.latest()) // FILE_BYTES))
        version = self.write(cluster_by(rows, columns, partitions), operation="CLUSTER")
        if self.shown_as:
            shown = self.rows_as_sql(version, rows.columns)
            self.spark.sql(f"ALTER VIEW {self.shown_as} AS {shown}")
        return version

    def _stored_bytes(self, version: int) -> int:
        part = f"PARTITION ({VERSION}={version})"
        lines = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.table} {part}")
        place = lines.filter("col_name = 'Location'").first()["data_type"]
        return stored_bytes(self.spark, place)

    def rows_as_sql(self, version: int, columns: Sequence[str]) -> str:
        names = ", ".join(quoted(c) for c in columns)
        return f"SELECT {names} FROM {self.table} WHERE {VERSION} = {version}"

    def _store(self, df: DataFrame, version: int, widen: bool = False) -> None:
        store_partition(df, self.table, version, widen)

    def _record(self, rows: DataFrame) -> None:
        line = rows.select(
            F.col("version").cast("int"),
            F.current_timestamp().alias("committed_at"),
            F.col("operation"),
            F.col("num_rows").cast("bigint"),
        )
        line.coalesce(1).write.format("parquet").mode("append").saveAsTable(self.history_table)

    # -- reading -------------------------------------------------------------

    def history(self) -> DataFrame:
        """(version, committed_at, operation, num_rows), one row per event."""
        return self.spark.table(self.history_table)

    def live(self) -> DataFrame:
        """History rows of the versions that can still be read."""
        events = self.history()
        expired = events.filter(F.col("operation") == _EXPIRE).select("version")
        return events.filter(F.col("operation") != _EXPIRE).join(expired, "version", "left_anti")

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of ``version``, by default the latest; only its files are read."""
        if version is None:
            version = self.latest()
            if version is None:
                raise LookupError(f"{self.table} has no version yet")
        elif self.live().filter(F.col("version") == version).isEmpty():
            raise LookupError(f"{self.table} has no version {version}")
        return self.spark.table(self.table).filter(F.col(VERSION) == version).drop(VERSION)

    def latest(self) -> int | None:
        """The number of the latest version, or None."""
        if not self.spark.catalog.tableExists(self.history_table):
            return None
        return self.history().agg(F.max("version")).first()[0]

    # -- expiry --------------------------------------------------------------

    def to_expire(
        self, keep_last: int | None = None, older_than: datetime | None = None
    ) -> DataFrame:
        """History rows of the versions outside the ``keep_last`` newest and, if
        given, committed before ``older_than``. The latest is never among them."""
        if keep_last is None and older_than is None:
            raise ValueError("give keep_last, older_than or both")
        live = self.live()
        newest = live.orderBy(F.desc("version")).limit(max(keep_last or 1, 1))
        chosen = live.join(newest.select("version"), "version", "left_anti")
        if older_than is not None:
            chosen = chosen.filter(F.col("committed_at") < F.lit(older_than))
        return chosen.select("version", "committed_at", "operation", "num_rows")

    def expire(
        self, keep_last: int | None = None, older_than: datetime | None = None
    ) -> list[int]:
        """Remove the files of the versions ``to_expire`` names, and of versions that were
        marked before but kept their files because that run was stopped."""
        chosen = self.to_expire(keep_last, older_than)
        # Version numbers only: a few per table, whatever the size of its rows.
        versions = sorted(r["version"] for r in chosen.select("version").collect())
        if versions:
            # Marked first: a stop half-way leaves unread files, not broken versions.
            marked = self.live().filter(F.col("version").isin(versions))
            rows = marked.withColumn("operation", F.lit(_EXPIRE)).select(
                "version", "operation", "num_rows"
            )
            self._record(rows)
        expired = self.history().filter(F.col("operation") == _EXPIRE).select("version")
        marked_numbers = {r["version"] for r in expired.distinct().collect()}
        stored = self.spark.sql(f"SHOW PARTITIONS {self.table}").collect()
        numbers = {int(r["partition"].rpartition("=")[2]) for r in stored}
        parts = ", ".join(f"PARTITION ({VERSION}={v})" for v in sorted(numbers & marked_numbers))
        if parts:
            self.spark.sql(f"ALTER TABLE {self.table} DROP IF EXISTS {parts}")
        return versions
