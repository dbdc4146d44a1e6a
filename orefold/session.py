"""Session settings the library is tested with."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(
    app_name: str = "orefold",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Return a session with ANSI casts, UTC time and adaptive execution.

    On a cluster leave ``master`` unset (spark-submit names it) and give a
    generous ``shuffle_partitions``: adaptive execution joins small neighbours
    again, so a high start value costs little and keeps every task in memory.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128m")
        # Fewer, larger read tasks; a scan-and-write step makes one file per task.
        .config("spark.sql.files.maxPartitionBytes", "256m")
        # A lost executor may replay a map task whose output order is not fixed;
        # the checksum makes Spark notice and rerun the readers of that output.
        .config("spark.sql.shuffle.orderIndependentChecksum.enabled", "true")
        .config("spark.sql.shuffle.orderIndependentChecksum.enableFullRetryOnMismatch", "true")
        # The older form of stored timestamps carries no statistics to skip files by.
        .config("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
        # Call sites are looked up once per column expression otherwise.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        # Rule metrics are read from progress reports, so keep more than the default 100.
        .config("spark.sql.streaming.numRecentProgressUpdates", "1000")
    )
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
