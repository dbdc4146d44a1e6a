"""Start flows and wait for them; each micro-batch is a version with its rule counts.

A flow has one source, one target table and one checkpoint of its own. It takes
what is there when it starts and then ends (``availableNow``); started again, it
goes on where it stopped, and rows already stored are not stored twice.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.quality import REPORT_COLUMNS, Rule
from ..sources.appended import AppendedTable
from ..sources.csv_files import MAX_BATCH_BYTES, bound_batches
from ..sources.tables import read_text, write_text

Lines = Callable[[list[tuple]], object]


@dataclass(frozen=True)
class Flow:
    """Rows of ``source`` that pass ``rules``, appended to ``table``.

    ``expand`` makes the rows of a micro-batch out of what the source gives, where that is
    not the rows themselves; ``schema`` is then what an empty table has.
    """

    table: str
    source: DataFrame
    checkpoint: str
    comment: str | None = None
    rules: Sequence[Rule] = field(default_factory=tuple)
    label: str | None = None
    expand: Callable[[DataFrame], DataFrame] | None = None
    schema: T.StructType | None = None
    widen: bool = False

    @property
    def name(self) -> str:
        """How metrics refer to the table; by default its full name."""
        return self.label or self.table

    @property
    def target(self) -> AppendedTable:
        return AppendedTable(self.source.sparkSession, self.table)

    def start(self, keep: Lines) -> StreamingQuery:
        self.target.create(self.schema or self.source.schema, self.comment)
        # The checkpoint numbers the batches; its mark tells them from those of another one.
        run = _mark(self.source.sparkSession, self.checkpoint)

        def store(batch: DataFrame, batch_id: int) -> None:
            rows = self.expand(batch) if self.expand else batch
            target = AppendedTable(batch.sparkSession, self.table)
            lines = target.append(rows, batch_id, run, self.rules, self.comment, self.widen)
            keep([(self.name, batch_id, *line) for line in lines])

        return (
            self.source.writeStream.foreachBatch(store)
            .queryName(self.table)
            .option("checkpointLocation", self.checkpoint)
            .trigger(availableNow=True)
            .start()
        )


def _mark(spark: SparkSession, checkpoint: str) -> str:
    path = f"{checkpoint.rstrip('/')}/table_mark"
    return read_text(spark, path) or write_text(spark, path, uuid.uuid4().hex)


def stream_table(
    spark: SparkSession,
    table: str,
    max_files: int | None = None,
    max_bytes: int = MAX_BATCH_BYTES,
) -> DataFrame:
    """The rows appended to ``table`` since the reading flow last ran."""
    return AppendedTable(spark, table).stream(
        bound_batches(spark.readStream, max_files, max_bytes)
    )


def run_flows(flows: Sequence[Flow], store: Lines | None = None) -> list[tuple]:
    """Run flows side by side until all their input is stored.

    Returns one line per flow, micro-batch and rule:
    (table_name, batch_id, rule, action, passed, failed). ``store`` is given the lines of
    each micro-batch when it is stored; they stay in the table's history as well. A flow
    that fails does not stop the others; the first error is raised when all have ended.
    """
    running: list[StreamingQuery] = []
    seen: list[tuple] = []
    errors: list[Exception] = []

    def keep(lines: list[tuple]) -> None:
        seen.extend(lines)
        if store and lines:
            store(lines)

    try:
        for flow in flows:
            try:
                running.append(flow.start(keep))
            except Exception as error:  # noqa: BLE001
                errors.append(error)
                break
        for query in running:
            try:
                query.awaitTermination()
            except StreamingQueryException as error:
                errors.append(error)
    finally:
        for query in running:
            query.stop()
        for flow in flows:
            flow.target.refresh()
    if errors:
        raise errors[0]
    return sorted(seen)


def store_rule_metrics(spark: SparkSession, lines: Sequence[tuple], table: str) -> DataFrame:
    """Append the lines of ``run_flows`` to ``table`` and return it.

    The lines are counts, a handful per micro-batch, and never rows of data.
    """
    schema = (
        "table_name string, batch_id bigint, rule string, action string, "
        "passed bigint, failed bigint"
    )
    lines_df = spark.createDataFrame(list(lines), schema)
    lines_df = lines_df.withColumn("stored_at", F.current_timestamp())
    lines_df.coalesce(1).write.format("parquet").mode("append").saveAsTable(table)
    return spark.table(table)


def summarise_rule_metrics(metrics: DataFrame) -> DataFrame:
    """Counts per rule over all micro-batches; of one that was repeated, the last ones."""
    latest = metrics.groupBy("table_name", "batch_id", "rule", "action").agg(
        F.max_by("passed", "stored_at").alias("passed"),
        F.max_by("failed", "stored_at").alias("failed"),
    )
    return (
        latest.groupBy("table_name", "rule", "action")
        .agg(F.sum("passed").alias("passed"), F.sum("failed").alias("failed"))
        .select(*REPORT_COLUMNS)
    )
