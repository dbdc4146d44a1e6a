"""Columns of stored tables, and how they grow when landing files bring new ones.

Schema version 0 of a table is what it was created with, and every widening adds one. Rows
stored before have NULL in columns that came later.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.numbers import quoted


def _list(table: str) -> str:
    return f"{table}_columns_history"


def schema_versions(spark: SparkSession, table: str, partition: str) -> DataFrame:
    """(schema_version, columns, added, since) of a stored table; ``since`` of version 0 is NULL."""
    if spark.catalog.tableExists(_list(table)):
        return spark.table(_list(table))
    columns = [c for c in spark.table(table).columns if c != partition]
    return _line(spark, 0, columns, columns, F.lit(None).cast("timestamp"))


def _line(spark: SparkSession, number: int, columns: list[str], added: list[str], since) -> DataFrame:
    names = lambda given: F.array(*[F.lit(c) for c in given]).cast("array<string>")
    return spark.range(1).select(
        F.lit(number).alias("schema_version"),
        names(columns).alias("columns"),
        names(added).alias("added"),
        since.alias("since"),
    )


def _record(spark: SparkSession, table: str, partition: str, added: list[str]) -> None:
    """Add the next schema version: the columns that ``table`` has now, and ``added``."""
    before = schema_versions(spark, table, partition)
    number = before.agg(F.max("schema_version")).first()[0] + 1
    columns = [c for c in spark.table(table).columns if c != partition]
    line = _line(spark, number, [*columns, *added], added, F.current_timestamp())
    if number == 1:
        line = before.unionByName(line)
    line.coalesce(1).write.format("parquet").mode("append").saveAsTable(_list(table))


def fitted(df: DataFrame, table: str, widen: bool, partition: str) -> DataFrame:
    """``df`` with the columns of ``table``, in their order, and its partition column last.

    With ``widen`` the table gains the columns it lacks, and ``df`` has NULL in those that it
    lacks itself. Without, other columns are an error, and nothing has changed.
    """
    spark = df.sparkSession
    columns = [c for c in spark.table(table).columns if c != partition]
    new = [f for f in df.schema.fields if f.name not in {*columns, partition}]
    missing = [c for c in columns if c not in df.columns]
    if (new or missing) and not widen:
        given = [c for c in df.columns if c != partition]
        raise ValueError(f"{table} has columns {columns}, not {given}; widen=True lets it grow")
    if new:
        _record(spark, table, partition, [f.name for f in new])
        added = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({added})")
    types = {f.name: f.dataType for f in spark.table(table).schema.fields}
    return df.select(
        *[
            F.lit(None).cast(kind).alias(name) if name in missing else F.col(quoted(name))
            for name, kind in types.items()
        ]
    )
