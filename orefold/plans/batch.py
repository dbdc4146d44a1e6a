"""The batch run: CSV landing to Bronze, Silver and Gold tables.

Every layer reads the stored tables of the one before it, so each row is parsed
once and each metric is computed once. Every table keeps the versions of former runs.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from ..functions.fixed import (
    ENTITIES,
    GOLD_CATEGORIES,
    GOLD_COMPLETION,
    GOLD_LOW_ENGAGEMENT,
    GOLD_REVENUE,
)
from ..operators import audit, clean, metrics, quality
from ..operators.layout import cluster_by
from ..parallel import side_by_side
from ..sources.csv_files import read_csv
from ..sources.versions import Retention, publish

SILVER: dict[str, Callable[[DataFrame], DataFrame]] = {
    "enrollments": clean.with_usd,
    "courses": clean.standardise_category,
    "progress": clean.valid_progress,
    "instructors": clean.fill_country,
}

_RULES = {
    "enrollments": quality.enrollment_rules,
    "courses": quality.course_rules,
    "progress": quality.progress_rules,
}


@dataclass
class Layers:
    """The stored tables of a run, by layer and short name."""

    bronze: dict[str, DataFrame] = field(default_factory=dict)
    silver: dict[str, DataFrame] = field(default_factory=dict)
    gold: dict[str, DataFrame] = field(default_factory=dict)
    rules: DataFrame | None = None

    def row_counts(self) -> DataFrame:
        named = {
            "bronze": {f"bronze_{e}": df for e, df in self.bronze.items()},
            "silver": {f"silver_{e}": df for e, df in self.silver.items()},
            "gold": self.gold,
        }
        return audit.row_counts({layer: tables for layer, tables in named.items() if tables})

    def rejections(self) -> DataFrame:
        return audit.layer_rejections(self.bronze, self.silver)


def _store(
    layer: str, frames: Mapping[str, DataFrame], schema: str, **options: object
) -> dict[str, DataFrame]:
    return side_by_side(
        {e: partial(publish, df, f"{schema}.{layer}_{e}", **options) for e, df in frames.items()}
    )


def load_bronze(
    spark: SparkSession,
    landing: str,
    schema: str,
    widen: bool = False,
    retention: Retention | None = None,
) -> dict[str, DataFrame]:
    raw = {e: read_csv(spark, landing, e, widen=widen) for e in ENTITIES}
    return _store("bronze", raw, schema, widen=widen, retention=retention)


def build_silver(
    bronze: Mapping[str, DataFrame],
    schema: str,
    check_rules: bool = False,
    cluster_enrollments: str | None = None,
    widen: bool = False,
    retention: Retention | None = None,
) -> dict[str, DataFrame]:
    """Clean each entity. ``check_rules`` also applies the quality rules, and
    ``cluster_enrollments`` lays the enrollments out by that column."""
    clean_rows = {}
    for entity, df in bronze.items():
        if check_rules and entity in _RULES:
            df = quality.apply_rules(df, _RULES[entity](df))
        cleaned = SILVER[entity](df)
        if entity == "enrollments" and cluster_enrollments:
            cleaned = cluster_by(cleaned, cluster_enrollments)
        clean_rows[entity] = cleaned
    return _store("silver", clean_rows, schema, widen=widen, retention=retention)


def build_gold(
    silver: Mapping[str, DataFrame], schema: str, retention: Retention | None = None
) -> dict[str, DataFrame]:
    enrollments, courses = silver["enrollments"], silver["courses"]
    spark = enrollments.sparkSession
    # Three metrics are by course: the enrollments are summed once for all of them.
    summed = f"{schema}.enrollment_sums"

    def store(name: str, df: DataFrame) -> DataFrame:
        return publish(df, f"{schema}.{name}", retention=retention)

    def completion() -> dict[str, DataFrame]:
        rates = store(GOLD_COMPLETION, metrics.completion_rate(silver["progress"], courses))
        low = store(GOLD_LOW_ENGAGEMENT, metrics.low_engagement(rates, enrollments, per_course=sums))
        return {GOLD_COMPLETION: rates, GOLD_LOW_ENGAGEMENT: low}

    def revenue() -> dict[str, DataFrame]:
        df = metrics.revenue_by_instructor(
            enrollments, courses, silver["instructors"], per_course=sums
        )
        return {GOLD_REVENUE: store(GOLD_REVENUE, df)}

    def categories() -> dict[str, DataFrame]:
        df = metrics.revenue_by_category(enrollments, courses, per_course=sums)
        return {GOLD_CATEGORIES: store(GOLD_CATEGORIES, df)}

    steps = {f.__name__: f for f in (completion, revenue, categories)}
    gold: dict[str, DataFrame] = {}
    try:
        metrics.money_per_course(enrollments).write.mode("overwrite").saveAsTable(summed)
        sums = spark.table(summed)
        for stored in side_by_side(steps).values():
            gold.update(stored)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {summed}")
    return gold


def rule_report(bronze: Mapping[str, DataFrame]) -> DataFrame:
    """Counts of all rules over the raw rows, before anything is filtered."""
    reports = [
        quality.rule_report(df, _RULES[entity](df), f"silver_{entity}")
        for entity, df in bronze.items()
        if entity in _RULES
    ]
    result = reports[0]
    for other in reports[1:]:
        result = result.unionByName(other)
    return result


def run(
    spark: SparkSession,
    landing: str,
    schema: str,
    check_rules: bool = False,
    cluster_enrollments: str | None = None,
    widen: bool = False,
    retention: Retention | None = None,
) -> Layers:
    """Build all twelve tables in ``schema`` from the CSV files in ``landing``.

    Each run adds a version to every table; ``versions_of(spark, name)`` reads, lists and
    expires them, and ``retention`` says which older ones a run removes when its own are
    shown. With ``check_rules`` the counts of all rules are stored in ``rule_metrics`` before
    the rows that fail are left out. With ``widen`` files may bring new columns, or lack some
    of those, and are bound by name; without, other columns than before stop the run.
    """
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")
    bronze = load_bronze(spark, landing, schema, widen, retention)
    rules = None
    if check_rules:
        rules = publish(rule_report(bronze), f"{schema}.rule_metrics", retention=retention)
    silver = build_silver(bronze, schema, check_rules, cluster_enrollments, widen, retention)
    return Layers(bronze, silver, build_gold(silver, schema, retention), rules)
