"""The incremental run: new landing files through streaming Bronze and Silver
tables, then a refresh of the Gold tables.

Each call takes the files that arrived since the last one. Bronze flows run side
by side, then Silver flows. Every micro-batch is a version of its table. Gold is made from sums
by course that are kept between runs: only new Silver batches are read and added to them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from threading import Lock

from pyspark.sql import DataFrame, SparkSession, types as T

from ..functions.fixed import (
    ENTITIES,
    GOLD_CATEGORIES,
    GOLD_COMPLETION,
    GOLD_LOW_ENGAGEMENT,
    GOLD_REVENUE,
)
from ..operators import clean, metrics, quality
from ..operators.quality import Rule
from ..parallel import side_by_side
from ..sources.appended import AppendedTable
from ..sources.csv_files import (
    MAX_BATCH_BYTES,
    landed,
    read_csv,
    read_files,
    stream_csv,
    stream_names,
)
from ..sources.versions import Retention, publish, show
from ..streaming.flows import Flow, run_flows, stream_table
from .partials import CourseSums

BRONZE_COMMENTS = {
    "enrollments": "Raw enrollments from landing files",
    "courses": "Raw courses from landing files",
    "progress": "Raw progress from landing files",
    "instructors": "Raw instructors from landing files",
}
SILVER_COMMENTS = {
    "enrollments": "Enrollments with a valid payment, in US dollars",
    "courses": "Courses with a category",
    "progress": "Progress with a lesson total",
    "instructors": "Instructors with a country",
}
GOLD_COMMENTS = {
    GOLD_COMPLETION: "Mean completion per course",
    GOLD_REVENUE: "Revenue and enrollments per instructor",
    GOLD_LOW_ENGAGEMENT: "Courses by completion, lowest first",
    GOLD_CATEGORIES: "Revenue and enrollments per category",
}


@dataclass
class Incremental:
    """Settings of one incremental run; the same ones must be used every time.

    ``rules_first`` counts rules over all Bronze rows. By default a Silver step
    filters first and its rules see only what is left, so rules that repeat the
    filter report no failures. With ``widen`` a later file may bring new columns, which are
    NULL in the rows before; without, it stops the flow. ``retention`` removes older versions
    of Gold tables once new ones are stored.
    """

    spark: SparkSession
    landing: str
    schema: str
    checkpoints: str
    suffix: str = "_stream"
    layout: str = "files"
    convert: bool = True
    rules_first: bool = False
    max_files: int | None = None
    max_bytes: int = MAX_BATCH_BYTES
    entities: Sequence[str] = field(default=ENTITIES)
    widen: bool = False
    retention: Retention | None = None
    _writing: Lock = field(default_factory=Lock, repr=False, compare=False)

    def table(self, name: str) -> str:
        return f"{self.schema}.{name}{self.suffix}"

    def _checkpoint(self, name: str) -> str:
        return f"{self.checkpoints}/{name}{self.suffix}"

    # -- Bronze --------------------------------------------------------------

    def _landing_schema(self, entity: str) -> T.StructType:
        # The first run takes the header; later ones hold files to the stored columns.
        table = self.table(f"bronze_{entity}")
        if self.spark.catalog.tableExists(table):
            return self.spark.table(table).schema
        return read_csv(self.spark, self.landing, entity).schema

    def bronze_flows(self) -> list[Flow]:
        return [self._bronze_flow(entity) for entity in self.entities]

    def _bronze_flow(self, entity: str) -> Flow:
        name = f"bronze_{entity}"
        place = (self.table(name), self._checkpoint(name), BRONZE_COMMENTS[entity])
        bounds = (self.layout, self.max_files, self.max_bytes)
        if not self.widen:
            schema = self._landing_schema(entity)
            source = stream_csv(self.spark, self.landing, entity, schema, *bounds)
            return Flow(place[0], source, *place[1:])

        def contents(batch: DataFrame) -> DataFrame:
            # Names of the files of one micro-batch, which ``max_files`` or ``max_bytes`` bound.
            return read_files(self.spark, sorted(r.path for r in batch.collect()), entity)

        if self.spark.catalog.tableExists(place[0]):
            schema = self.spark.table(place[0]).schema
        else:
            first = landed(self.spark, self.landing, entity)[:1]
            schema = read_files(self.spark, first, entity).schema
        source = stream_names(self.spark, self.landing, entity, *bounds)
        return Flow(place[0], source, *place[1:], expand=contents, schema=schema, widen=True)

    # -- Silver --------------------------------------------------------------

    def silver_source(self, entity: str, bronze: DataFrame) -> tuple[DataFrame, list[Rule]]:
        """The cleaned rows and the rules for them, from batch or streaming Bronze."""
        if entity == "enrollments":
            df = bronze if self.rules_first else clean.with_payment(bronze)
            return (clean.with_usd(df) if self.convert else df), quality.enrollment_rules(df)
        if entity == "courses":
            return clean.standardise_category(bronze), quality.course_rules(bronze)
        if entity == "progress":
            df = bronze if self.rules_first else clean.valid_progress(bronze)
            return df, quality.progress_rules(df)
        return clean.fill_country(bronze), []

    def silver_flows(self) -> list[Flow]:
        flows = []
        for entity in self.entities:
            bronze = stream_table(
                self.spark, self.table(f"bronze_{entity}"), self.max_files, self.max_bytes
            )
            source, rules = self.silver_source(entity, bronze)
            name = f"silver_{entity}"
            flows.append(
                Flow(
                    self.table(name),
                    source,
                    self._checkpoint(name),
                    SILVER_COMMENTS[entity],
                    tuple(rules),
                    name,
                    widen=self.widen,
                )
            )
        return flows

    # -- Gold ----------------------------------------------------------------

    def _silver(self, entity: str) -> DataFrame:
        return self.spark.table(self.table(f"silver_{entity}"))

    def versions(self, name: str) -> AppendedTable:
        """The versions of a streamed table, such as ``silver_enrollments``."""
        return AppendedTable(self.spark, self.table(name))

    def _store(self, name: str, df: DataFrame) -> DataFrame:
        return publish(df, self.table(name), GOLD_COMMENTS[name], retention=self.retention)

    def money_sums(self) -> CourseSums:
        """Money and enrollments by course, kept between runs."""
        return CourseSums(
            self.versions("silver_enrollments"),
            lambda rows: metrics.money_per_course(rows, self._amount),
            metrics.add_money,
        )

    def completion_sums(self) -> CourseSums:
        """Completion and users by course, kept between runs."""
        return CourseSums(
            self.versions("silver_progress"),
            lambda rows: metrics.completion_per_course(rows, rounded=False),
            metrics.add_completion,
        )

    def _sums(self, sums: CourseSums) -> DataFrame:
        # One writer at a time; whoever comes second finds nothing new to add.
        with self._writing:
            return sums.refresh()

    def refresh_completion(self) -> DataFrame:
        rates = metrics.course_completion_single_round(
            self._sums(self.completion_sums()), self._silver("courses")
        )
        return self._store(GOLD_COMPLETION, rates)

    def refresh_revenue(self) -> DataFrame:
        revenue = metrics.instructor_revenue(
            self._sums(self.money_sums()), self._silver("courses"), self._silver("instructors")
        )
        return self._store(GOLD_REVENUE, revenue)

    def refresh_low_engagement(self) -> DataFrame:
        enrolled = metrics.enrolled(self._sums(self.money_sums()), target="total_inscritos")
        low = metrics.by_engagement(
            self.spark.table(self.table(GOLD_COMPLETION)),
            enrolled,
            rate="completion_pct",
            target="total_inscritos",
        )
        return self._store(GOLD_LOW_ENGAGEMENT, low)

    def refresh_categories(self) -> DataFrame:
        categories = metrics.category_revenue(
            self._sums(self.money_sums()), self._silver("courses")
        )
        return self._store(GOLD_CATEGORIES, categories)

    @property
    def _amount(self) -> str:
        return "payment_usd" if self.convert else "payment_amount"

    # -- whole runs ----------------------------------------------------------

    def run_bronze(self) -> None:
        run_flows(self.bronze_flows())

    def run_silver(self) -> None:
        flows = self.silver_flows()
        try:
            run_flows(flows)
        finally:
            self._show_rule_counts(flows)

    def _show_rule_counts(self, flows: Sequence[Flow]) -> None:
        """Counts are in the history of each table, written with the batch; one view shows all."""
        exists = self.spark.catalog.tableExists
        checked = [f for f in flows if f.rules and exists(f.target.history_table)]
        if checked:
            counts = " UNION ALL ".join(f.target.rule_counts(f.name) for f in checked)
            show(self.spark, self.table("rule_metrics"), counts, "Rule counts per micro-batch")

    def refresh_gold(self) -> dict[str, DataFrame]:
        steps = {
            GOLD_COMPLETION: lambda: (self.refresh_completion(), self.refresh_low_engagement()),
            GOLD_REVENUE: self.refresh_revenue,
            GOLD_CATEGORIES: self.refresh_categories,
        }
        stored = side_by_side(steps)
        rates, low = stored.pop(GOLD_COMPLETION)
        return {GOLD_COMPLETION: rates, GOLD_LOW_ENGAGEMENT: low, **stored}

    def run(self) -> dict[str, DataFrame]:
        """Take all new files and return the refreshed Gold tables."""
        self.spark.sql(f"CREATE SCHEMA IF NOT EXISTS {self.schema}")
        self.run_bronze()
        self.run_silver()
        return self.refresh_gold()
