"""Landing rows of a table that is stored as one row group."""

from pyspark.sql import functions as F

import __spark_entry__ as entry_file


def test_one_row_group_lands_in_several_parts(spark, space):
    rows = spark.range(600_000).select(
        F.col("id").alias("event_id"), F.when(F.col("id") % 7 > 0, F.col("id") % 1009).alias("user_id")
    )
    rows.coalesce(1).write.parquet(f"{space.folder}/events.parquet")
    entry_file._land(spark, space.folder, space, "progress")
    landed = spark.read.option("header", True).csv(f"{space.landing}/progress.csv")
    per_file = landed.groupBy(F.input_file_name()).count().collect()
    assert len(per_file) > 1
    assert sum(r["count"] for r in per_file) == 600_000
    given = entry_file.standins.as_text(entry_file.standins.progress(spark, space.folder))
    assert landed.exceptAll(given).isEmpty()
