"""Tables that grow by micro-batches, each of which is a version.

The rows of a micro-batch are one partition of a Parquet table. When they are stored, one
history row makes them a version: it names the batch, the run it belongs to, how many rows
it holds and how often each rule passed, all in one file. So a batch that was stopped half-way
is never seen and is replaced when it is repeated, and one that is repeated though it was
complete adds nothing: neither rows nor counts are lost or doubled, whenever the driver stops.

The name of the table is a view of all complete batches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T
from pyspark.sql.streaming import DataStreamReader

from ..functions.numbers import quoted
from ..operators.quality import Rule, apply_rules, report_rows
from .versions import VERSION, create_table, show, store_partition

_HISTORY = (
    "version int, committed_at timestamp, operation string, num_rows bigint, batch_id bigint, "
    "run string, rules array<struct<rule:string,action:string,passed:bigint,failed:bigint>>"
)


class AppendedTable:
    """``name`` shows all complete batches; rows are below ``<name>_batches``."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark = spark
        self.name = name
        self.table = f"{name}_batches"
        self.history_table = f"{name}_history"

    # -- writing -------------------------------------------------------------

    def create(self, schema: T.StructType, comment: str | None = None) -> None:
        """An empty table of this schema, unless it is there; the comment is set in any case."""
        exists = self.spark.catalog.tableExists
        if not exists(self.table):
            create_table(self.spark, schema, self.table, by_version=True)
        if not exists(self.history_table):
            create_table(self.spark, T.StructType.fromDDL(_HISTORY), self.history_table)
            self._show(-1, comment)
        elif comment:
            latest = self.latest()
            self._show(-1 if latest is None else latest, comment)

    def append(
        self,
        batch: DataFrame,
        batch_id: int,
        run: str,
        rules: Sequence[Rule] = (),
        comment: str | None = None,
        widen: bool = False,
    ) -> list[tuple]:
        """Store the rows of a micro-batch that pass ``rules``, once.

        ``run`` names the checkpoint that numbers the batches. Returns a line
        (rule, action, passed, failed) per rule.
        """
        mine = (F.col("batch_id") == batch_id) & (F.col("run") == run)
        known = self.history().agg(
            F.max("version").alias("latest"), F.max_by("rules", F.when(mine, F.col("version"))).alias("rules")
        ).first()
        if known.rules is not None:
            return [tuple(r) for r in known.rules]
        version = 0 if known.latest is None else known.latest + 1
        counts, stored = Observation(), Observation()
        kept = apply_rules(batch, rules, counts if rules else None)
        kept = kept.observe(stored, F.count(F.lit(1)).alias("rows"))
        store_partition(kept, self.table, version, widen)
        lines = [line[1:] for line in report_rows(counts.get, rules, "")] if rules else []
        row = self.spark.createDataFrame(
            [(version, None, "APPEND", stored.get["rows"], batch_id, run, lines)], _HISTORY
        )
        row = row.withColumn("committed_at", F.current_timestamp())
        # The one step that makes the batch count.
        row.coalesce(1).write.format("parquet").mode("append").saveAsTable(self.history_table)
        self._show(version, comment)
        return lines

    def _show(self, until: int, comment: str | None) -> None:
        names = ", ".join(quoted(c) for c in self.spark.table(self.table).columns[:-1])
        rows = f"SELECT {names} FROM {self.table} WHERE {VERSION} <= {until}"
        show(self.spark, self.name, rows, comment)

    # -- reading -------------------------------------------------------------

    def refresh(self) -> None:
        """Forget file lists of before: batches are written by sessions of their own."""
        for table in (self.table, self.history_table):
            if self.spark.catalog.tableExists(table):
                self.spark.catalog.refreshTable(table)

    def history(self) -> DataFrame:
        """One row per version: (version, committed_at, operation, num_rows, batch_id, run, rules)."""
        self.refresh()
        return self.spark.table(self.history_table)

    def latest(self) -> int | None:
        if not self.spark.catalog.tableExists(self.history_table):
            return None
        return self.history().agg(F.max("version")).first()[0]

    def read(self, version: int | None = None, after: int = -1) -> DataFrame:
        """The table as of ``version``, by default the latest, without what it held as of
        ``after``; only the files of the batches in between are read."""
        latest = self.latest()
        version = latest if version is None else version
        if version is None or version > latest:
            raise LookupError(f"{self.name} has no version {version}")
        between = (F.col(VERSION) <= version) & (F.col(VERSION) > after)
        return self.spark.table(self.table).filter(between).drop(VERSION)

    def stream(self, reader: DataStreamReader) -> DataFrame:
        """The batches as a stream. Read it when the flow that writes them has ended: files of
        a batch that is being written would be taken too."""
        return reader.table(self.table).drop(VERSION)

    def rule_counts(self, label: str) -> str:
        """SQL text for (table_name, batch_id, rule, action, passed, failed, stored_at)."""
        columns = "batch_id, r.rule, r.action, r.passed, r.failed, committed_at AS stored_at"
        return (
            f"SELECT '{label}' AS table_name, {columns} FROM {self.history_table}"
            " LATERAL VIEW explode(rules) AS r"
        )
