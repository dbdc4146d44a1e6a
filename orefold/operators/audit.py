"""Row-count audits."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, functions as F


def row_counts(tables: Mapping[str, Mapping[str, DataFrame]]) -> DataFrame:
    """(layer, table_name, row_count) for ``{layer: {table: DataFrame}}``.

    Over stored Parquet tables the scan reads no column, only the row counts in
    the file footers.
    """
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), "row_count"
        )
        for layer, members in tables.items()
        for name, df in members.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def layer_rejections(
    before: Mapping[str, DataFrame], after: Mapping[str, DataFrame], total: str = "total"
) -> DataFrame:
    """(entity, rows_in, rows_kept, rows_rejected), with a line over all entities."""
    counts = row_counts({"in": before, "kept": after})
    per_entity = counts.groupBy(F.col("table_name").alias("entity")).agg(
        F.sum(F.when(F.col("layer") == "in", F.col("row_count"))).alias("rows_in"),
        F.sum(F.when(F.col("layer") == "kept", F.col("row_count"))).alias("rows_kept"),
    )
    overall = per_entity.agg(
        F.lit(total).alias("entity"),
        F.sum("rows_in").alias("rows_in"),
        F.sum("rows_kept").alias("rows_kept"),
    )
    return per_entity.unionByName(overall).withColumn(
        "rows_rejected", F.col("rows_in") - F.col("rows_kept")
    )
