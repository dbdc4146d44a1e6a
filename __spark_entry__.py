"""Registered queries and their SQL counterparts."""

from __future__ import annotations

import importlib
import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from orefold.functions.fixed import ENTITIES  # noqa: E402
from orefold.operators import audit, clean, metrics, quality  # noqa: E402
from orefold.plans import batch, standins  # noqa: E402
from orefold.plans.incremental import Incremental  # noqa: E402
from orefold.sources.csv_files import read_csv, write_csv  # noqa: E402
from orefold.sources.tables import overwrite_table  # noqa: E402
from orefold.sources.versions import Retention, VersionedTable, versions_of  # noqa: E402
from orefold.sources.workspace import Workspace, new_workspace  # noqa: E402
from orefold.streaming.flows import summarise_rule_metrics  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"
Query = Callable[[SparkSession, str], DataFrame]


def entry(spark: SparkSession) -> DataFrame:
    """Revenue by instructor: cleaning, two joins, exact sums and a sort."""
    return revenue_by_instructor(spark, SMOKE_DIR)


# -- inputs ------------------------------------------------------------------


def _raw(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    return standins.ENTITY_VIEWS[entity](spark, sf_dir)


def _silver(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    return batch.SILVER[entity](_raw(spark, sf_dir, entity))


def _valid_enrollments(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = clean.with_payment(_raw(spark, sf_dir, "enrollments"))
    return quality.apply_rules(raw, quality.enrollment_rules(raw))


# Rows that stay together, in the order they were read, so that stored columns stay as small.
_BLOCK = 1 << 16


def _dealt(rows: DataFrame) -> DataFrame:
    """The rows in parts of like size: a table stored in few row groups is read by as few tasks,
    and writing its rows as text takes far longer than reading them."""
    block = rows.withColumn("_block", F.expr(f"monotonically_increasing_id() DIV {_BLOCK}"))
    return block.hint("rebalance", "_block").drop("_block")


def _land(spark: SparkSession, sf_dir: str, space: Workspace, *entities: str) -> None:
    for entity in entities:
        write_csv(standins.as_text(_dealt(_raw(spark, sf_dir, entity))), space.landing, entity)


# -- Bronze ------------------------------------------------------------------


def _bronze_csv(entity: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        space = new_workspace(spark, "csv")
        _land(spark, sf_dir, space, entity)
        raw = read_csv(spark, space.landing, entity)
        return standins.typed(overwrite_table(raw, space.table(f"bronze_{entity}")))

    return query


# Two drops that together hold every row of the entity.
_FIRST_DROP = {
    "enrollments": "enrolled_at < timestamp_ntz'1995-06-01 00:00:00'",
    "courses": "instructor_id <= 25",
    "progress": "total_lessons <= 10",
    "instructors": "country IS NULL",
}


def _incremental(spark: SparkSession, space: Workspace, *entities: str, **options) -> Incremental:
    return Incremental(
        spark,
        space.landing,
        space.schema,
        space.checkpoints,
        layout="folders",
        entities=entities,
        **options,
    )


def _bronze_stream(entity: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        space = new_workspace(spark, "stream")
        rows = _raw(spark, sf_dir, entity)
        in_first = F.coalesce(F.expr(_FIRST_DROP[entity]), F.lit(False))
        flows = _incremental(spark, space, entity)
        for drop, part in (("1", rows.filter(in_first)), ("2", rows.filter(~in_first))):
            write_csv(standins.as_text(part), space.landing, entity, drop)
            flows.run_bronze()
        return standins.typed(spark.table(flows.table(f"bronze_{entity}")))

    return query


# -- Silver ------------------------------------------------------------------


def _silver_batch(entity: str) -> Query:
    return lambda spark, sf_dir: _silver(spark, sf_dir, entity)


def _streamed(spark: SparkSession, sf_dir: str, *entities: str, **options) -> Incremental:
    """Bronze and Silver tables of ``entities``, streamed from CSV files."""
    space = new_workspace(spark, "stream")
    _land(spark, sf_dir, space, *entities)
    flows = _incremental(spark, space, *entities, **options)
    flows.run_bronze()
    flows.run_silver()
    return flows


def _silver_stream(entity: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        flows = _streamed(spark, sf_dir, entity)
        return standins.typed(spark.table(flows.table(f"silver_{entity}")))

    return query


# -- quality -----------------------------------------------------------------


def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batch.rule_report({e: _raw(spark, sf_dir, e) for e in ENTITIES})


def quality_report_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts gathered from micro-batches while the Silver flows ran."""
    flows = _streamed(spark, sf_dir, "enrollments", "courses", "progress", rules_first=True)
    return summarise_rule_metrics(spark.table(flows.table("rule_metrics")))


def quality_report_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts that a batch run stores beside its tables."""
    space = new_workspace(spark, "batch")
    _land(spark, sf_dir, space, *ENTITIES)
    batch.run(spark, space.landing, space.schema, check_rules=True)
    return spark.table(space.table("rule_metrics"))


def quality_report_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts observed while the checked rows were written to a table."""
    space = new_workspace(spark, "observed")
    raw = _raw(spark, sf_dir, "enrollments")
    rules = quality.enrollment_rules(raw)
    seen = Observation("enrollments")
    overwrite_table(quality.apply_rules(raw, rules, seen), space.table("silver_enrollments"))
    lines = quality.report_rows(seen.get, rules, "silver_enrollments")
    return spark.createDataFrame(
        lines, "table_name string, rule string, action string, passed bigint, failed bigint"
    )


def expect_keep_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _raw(spark, sf_dir, "courses")
    return quality.apply_rules(raw, quality.course_rules(raw))


def expect_drop_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _raw(spark, sf_dir, "enrollments")
    return quality.apply_rules(raw, quality.enrollment_rules(raw))


def expect_fail_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _raw(spark, sf_dir, "enrollments")
    rules = [
        quality.Rule("enrollment_id_no_nulo", "enrollment_id IS NOT NULL", "fail"),
        *quality.enrollment_rules(raw),
    ]
    return quality.apply_rules(raw, rules)


# -- Gold --------------------------------------------------------------------


def progress_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.with_completion(_silver(spark, sf_dir, "progress"))


def completion_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.completion_rate(
        _silver(spark, sf_dir, "progress"), _silver(spark, sf_dir, "courses")
    )


def completion_rate_single_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.completion_rate_single_round(
        _silver(spark, sf_dir, "progress"), _silver(spark, sf_dir, "courses")
    )


def revenue_by_instructor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.revenue_by_instructor(
        _silver(spark, sf_dir, "enrollments"),
        _silver(spark, sf_dir, "courses"),
        _silver(spark, sf_dir, "instructors"),
    )


def revenue_by_instructor_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.revenue_by_instructor(
        _valid_enrollments(spark, sf_dir),
        _silver(spark, sf_dir, "courses"),
        _silver(spark, sf_dir, "instructors"),
        amount="payment_amount",
    )


def enrollments_per_course(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.enrollments_per_course(_silver(spark, sf_dir, "enrollments"))


def low_engagement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.low_engagement(
        completion_rate(spark, sf_dir), _silver(spark, sf_dir, "enrollments")
    )


def low_engagement_single_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.low_engagement(
        completion_rate_single_round(spark, sf_dir),
        _valid_enrollments(spark, sf_dir),
        rate="completion_pct",
        target="total_inscritos",
    )


def low_engagement_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.low_engagement(
        completion_rate(spark, sf_dir),
        _silver(spark, sf_dir, "enrollments"),
        max_completion=60.0,
        min_enrolled=30,
    )


def revenue_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.revenue_by_category(
        _silver(spark, sf_dir, "enrollments"), _silver(spark, sf_dir, "courses")
    )


def revenue_by_category_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.revenue_by_category(
        _valid_enrollments(spark, sf_dir),
        _silver(spark, sf_dir, "courses"),
        amount="payment_amount",
    )


def revenue_by_category_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.revenue_by_category_month(
        _silver(spark, sf_dir, "enrollments"), _silver(spark, sf_dir, "courses")
    )


def _hundredths(spark: SparkSession, sf_dir: str, amount: str) -> DataFrame:
    """Enrollments with amounts made from the whole hundredths ``h`` of their prices."""
    rows = _raw(spark, sf_dir, "enrollments").withColumn(
        "h", F.expr("CAST(rint(payment_amount * 100) AS BIGINT)")
    )
    return rows.withColumn("payment_usd", F.expr(amount))


def revenue_by_instructor_large_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts of ten to a hundred thousand millions."""
    return metrics.revenue_by_instructor(
        _hundredths(spark, sf_dir, "(h * 1000000 + 37) / 100D"),
        _silver(spark, sf_dir, "courses"),
        _silver(spark, sf_dir, "instructors"),
    )


def revenue_by_category_small_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts of about a millionth and less."""
    return metrics.revenue_by_category(
        _hundredths(spark, sf_dir, "h / 1e12D"), _silver(spark, sf_dir, "courses")
    )


def top_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.revenue_by_category(
        _silver(spark, sf_dir, "enrollments"), _silver(spark, sf_dir, "courses"), k=3
    )


# The same metrics with the rows of a course spread over fewer tasks.


def completion_rate_large_courses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.completion_rate(
        _silver(spark, sf_dir, "progress"),
        _silver(spark, sf_dir, "courses"),
        salts=4,
    )


def revenue_by_instructor_large_courses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.revenue_by_instructor(
        _silver(spark, sf_dir, "enrollments"),
        _silver(spark, sf_dir, "courses"),
        _silver(spark, sf_dir, "instructors"),
        salts=4,
    )


def revenue_by_category_month_large_courses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.revenue_by_category_month(
        _silver(spark, sf_dir, "enrollments"), _silver(spark, sf_dir, "courses"), salts=4
    )


def headline_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.headline_totals(
        completion_rate(spark, sf_dir), revenue_by_instructor(spark, sf_dir)
    )


# -- whole runs --------------------------------------------------------------


def _batch_run(spark: SparkSession, sf_dir: str) -> batch.Layers:
    space = new_workspace(spark, "batch")
    _land(spark, sf_dir, space, *ENTITIES)
    return batch.run(spark, space.landing, space.schema)


def _run_twice(spark: SparkSession, sf_dir: str) -> VersionedTable:
    """Enrollments of a batch run without rules, then of one with them."""
    space = new_workspace(spark, "batch")
    _land(spark, sf_dir, space, *ENTITIES)
    batch.run(spark, space.landing, space.schema)
    batch.run(spark, space.landing, space.schema, check_rules=True)
    return versions_of(spark, space.table("silver_enrollments"))


def batch_table_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run_twice(spark, sf_dir).history().drop("committed_at")


def batch_version_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standins.typed(_run_twice(spark, sf_dir).read(0))


def layer_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _batch_run(spark, sf_dir).row_counts()


def layer_rejections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.layer_rejections(
        {e: _raw(spark, sf_dir, e) for e in ENTITIES},
        {e: _silver(spark, sf_dir, e) for e in ENTITIES},
    )


def _gold_batch(name: str, types: dict[str, str]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        stored = _batch_run(spark, sf_dir).gold[name]
        return stored.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})

    return query


def gold_from_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    flows = _streamed(spark, sf_dir, "enrollments", "courses", "instructors")
    return standins.typed(flows.refresh_revenue())


def _two_drops(spark: SparkSession, sf_dir: str, *entities: str) -> Incremental:
    """Two runs: the first takes part of the enrollments and all other rows, the second the rest."""
    space = new_workspace(spark, "stream")
    flows = _incremental(spark, space, "enrollments", *entities)
    _land(spark, sf_dir, space, *entities)
    rows = _raw(spark, sf_dir, "enrollments")
    in_first = F.coalesce(F.expr(_FIRST_DROP["enrollments"]), F.lit(False))
    for drop, part in (("1", rows.filter(in_first)), ("2", rows.filter(~in_first))):
        write_csv(standins.as_text(part), space.landing, "enrollments", drop)
        flows.run_bronze()
        flows.run_silver()
        if entities:
            flows.refresh_revenue()
    return flows


def gold_from_two_drops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue refreshed twice; the second time only the new batches are summed up."""
    flows = _two_drops(spark, sf_dir, "courses", "instructors")
    return standins.typed(versions_of(spark, flows.table("gold_revenue_instructor")).read())


def silver_stream_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streamed Silver enrollments as of the first of two drops."""
    flows = _two_drops(spark, sf_dir)
    return standins.typed(flows.versions("silver_enrollments").read(0))


def silver_stream_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The versions that two drops made of the streamed Silver enrollments."""
    history = _two_drops(spark, sf_dir).versions("silver_enrollments").history()
    return history.select("version", "operation", "num_rows", "batch_id")


def _two_headers(spark: SparkSession, sf_dir: str, space: Workspace, land) -> None:
    """Courses in two drops: the second has one column more, and another order of columns."""
    rows = standins.as_text(_raw(spark, sf_dir, "courses"))
    in_first = F.coalesce(F.expr(_FIRST_DROP["courses"]), F.lit(False))
    wider = rows.filter(~in_first).select(
        "title", F.concat(F.lit("L"), F.col("course_id")).alias("level"), "category", "instructor_id", "course_id"
    )
    for drop, part in (("1", rows.filter(in_first)), ("2", wider)):
        write_csv(part, space.landing, "courses", drop)
        land()


def bronze_csv_new_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    space = new_workspace(spark, "csv")
    _two_headers(spark, sf_dir, space, lambda: None)
    return standins.typed(read_csv(spark, space.landing, "courses", widen=True))


def silver_stream_new_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    space = new_workspace(spark, "stream")
    flows = _incremental(spark, space, "courses", widen=True)

    def land() -> None:
        flows.run_bronze()
        flows.run_silver()

    _two_headers(spark, sf_dir, space, land)
    return standins.typed(spark.table(flows.table("silver_courses")))


def gold_from_stream_low_engagement(spark: SparkSession, sf_dir: str) -> DataFrame:
    flows = _streamed(spark, sf_dir, "enrollments", "courses", "progress")
    flows.refresh_completion()
    return standins.typed(flows.refresh_low_engagement())


def gold_from_stream_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _streamed(spark, sf_dir, "enrollments", "courses").refresh_categories()


# -- versions and layout -----------------------------------------------------


def _versioned_enrollments(spark: SparkSession, sf_dir: str) -> VersionedTable:
    """Version 0 as cleaned, version 1 without invalid payments, version 2 the same
    rows ordered in files by date."""
    table = VersionedTable(spark, new_workspace(spark, "versions").table("silver_enrollments"))
    table.write(_silver(spark, sf_dir, "enrollments"))
    first = table.read(0)
    table.write(quality.apply_rules(first, quality.enrollment_rules(first)))
    table.cluster("enrolled_at")
    return table


def version_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _versioned_enrollments(spark, sf_dir).read(0)


def version_as_of_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _versioned_enrollments(spark, sf_dir).read(0)
    return rows.orderBy(*rows.columns).limit(10)


def table_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _versioned_enrollments(spark, sf_dir).history().drop("committed_at")


def versions_to_expire(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _versioned_enrollments(spark, sf_dir).to_expire(keep_last=2).drop("committed_at")


def expired_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _versioned_enrollments(spark, sf_dir)
    table.expire(keep_last=1)
    return table.history().drop("committed_at")


def rows_after_expiry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows that are still stored when every version but the last has expired."""
    table = _versioned_enrollments(spark, sf_dir)
    table.expire(keep_last=1)
    return spark.table(table.table).drop("_version")


def clustered_range_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A range of dates, kept as text like all raw columns, out of clustered files."""
    table = VersionedTable(spark, new_workspace(spark, "clustered").table("silver_enrollments"))
    table.write(clean.with_usd(standins.as_text(_raw(spark, sf_dir, "enrollments"))))
    table.cluster("enrolled_at")
    in_1995 = F.col("enrolled_at").between("1995-01-01 00:00:00", "1995-12-31 00:00:00.000000")
    return standins.typed(table.read().filter(in_1995))


def clustered_two_columns_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A range of courses out of files laid out by date and course at once."""
    table = VersionedTable(spark, new_workspace(spark, "clustered").table("silver_enrollments"))
    table.write(clean.with_usd(_raw(spark, sf_dir, "enrollments")))
    table.cluster(["enrolled_at", "course_id"])
    return table.read().filter(F.col("course_id").between(20, 60))


def retained_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What three batch runs that keep two versions leave of the enrollments."""
    space = new_workspace(spark, "batch")
    _land(spark, sf_dir, space, *ENTITIES)
    for check_rules in (False, True, True):
        batch.run(
            spark, space.landing, space.schema, check_rules, retention=Retention(keep_last=2)
        )
    return versions_of(spark, space.table("silver_enrollments")).live().drop("committed_at")


# -- preparing training text --------------------------------------------------


def _training_text() -> tuple[dict[str, Query], dict[str, str]]:
    """Queries and SQL of the subpackage for training text, where it is there."""
    found, sql = {}, {}
    for name in ("orefold.llm.queries", "corpus_pipeline"):
        try:
            module = importlib.import_module(name)
        except ImportError as error:
            # Also where a library is missing that only these queries need: the others stay.
            print(f"no queries of {name}: {error}", file=sys.stderr)
            continue
        if name == "corpus_pipeline":
            found["pipeline"] = module.run
            if module.ORACLE_SQL:
                sql["pipeline"] = module.ORACLE_SQL
        else:
            found.update(module.QUERIES)
            sql.update(module.ORACLE_SQL)
    return found, sql


TRAINING_QUERIES, TRAINING_SQL = _training_text()


def queries() -> dict[str, Query]:
    found: dict[str, Query] = dict(TRAINING_QUERIES)
    for entity in ENTITIES:
        found[f"bronze_csv_{entity}"] = _bronze_csv(entity)
        found[f"bronze_stream_{entity}"] = _bronze_stream(entity)
        found[f"silver_{entity}"] = _silver_batch(entity)
        found[f"silver_stream_{entity}"] = _silver_stream(entity)
    plain = [
        quality_report,
        quality_report_stream,
        quality_report_observed,
        quality_report_batch,
        expect_keep_rows,
        expect_drop_rows,
        expect_fail_clean,
        progress_pct,
        completion_rate,
        completion_rate_single_round,
        revenue_by_instructor,
        revenue_by_instructor_raw,
        enrollments_per_course,
        low_engagement,
        low_engagement_single_round,
        low_engagement_threshold,
        revenue_by_category,
        revenue_by_category_raw,
        revenue_by_category_month,
        revenue_by_instructor_large_amounts,
        revenue_by_category_small_amounts,
        top_categories,
        completion_rate_large_courses,
        revenue_by_instructor_large_courses,
        revenue_by_category_month_large_courses,
        headline_totals,
        layer_row_counts,
        layer_rejections,
        gold_from_stream,
        gold_from_stream_low_engagement,
        gold_from_stream_categories,
        version_as_of,
        version_as_of_limit,
        table_history,
        versions_to_expire,
        expired_history,
        rows_after_expiry,
        batch_table_history,
        batch_version_as_of,
        clustered_range_read,
        clustered_two_columns_read,
        retained_history,
        gold_from_two_drops,
        silver_stream_as_of,
        silver_stream_history,
        bronze_csv_new_column,
        silver_stream_new_column,
    ]
    found.update({query.__name__: query for query in plain})
    found["gold_from_batch_completion"] = _gold_batch(
        "gold_completion_rate", {"course_id": "bigint"}
    )
    found["gold_from_batch_low_engagement"] = _gold_batch(
        "gold_cursos_abandonados", {"course_id": "bigint"}
    )
    found["gold_from_batch_revenue"] = _gold_batch(
        "gold_revenue_instructor", {"instructor_id": "bigint"}
    )
    found["gold_from_batch_categories"] = _gold_batch("gold_top_categorias", {})
    return found


# -- the same in SQL ---------------------------------------------------------

_ENR = """enr AS (
  SELECT l_orderkey AS enrollment_id, l_partkey AS course_id,
         CASE WHEN l_quantity = 13 THEN NULL WHEN l_quantity = 7 THEN -l_extendedprice
              ELSE l_extendedprice END AS payment_amount,
         CASE l_suppkey % 5 WHEN 0 THEN 'MXN' WHEN 1 THEN 'COP' WHEN 2 THEN 'PEN'
              WHEN 3 THEN 'USD' ELSE NULL END AS currency,
         l_shipdate AS enrolled_at
  FROM lineitem)"""
_CRS = """crs AS (
  SELECT p_partkey AS course_id, p_name AS title,
         CASE p_type WHEN 'ECONOMY' THEN '' WHEN 'STANDARD' THEN NULL ELSE p_type END AS category,
         CAST(p_size AS BIGINT) AS instructor_id
  FROM part)"""
_INS = """ins AS (
  SELECT s_suppkey AS instructor_id, s_name AS name,
         CASE WHEN s_nationkey % 5 = 0 THEN NULL ELSE n_name END AS country
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey)"""
_PRG = """prg AS (
  SELECT user_id, event_id % 211 AS course_id,
         (event_id * 7) % (event_id % 21 + 1) AS lessons_completed,
         event_id % 21 AS total_lessons
  FROM events)"""
_SENR = """senr AS (
  SELECT *, round(payment_amount * CASE currency WHEN 'MXN' THEN 0.058::DOUBLE
         WHEN 'COP' THEN 0.00024::DOUBLE WHEN 'PEN' THEN 0.27::DOUBLE ELSE 1.0::DOUBLE END, 2)
         AS payment_usd
  FROM enr)"""
_SCRS = """scrs AS (
  SELECT course_id, title,
         CASE WHEN category IS NULL OR category = '' THEN 'Sin categoría' ELSE category END
         AS category, instructor_id
  FROM crs)"""
_SINS = """sins AS (
  SELECT instructor_id, name, coalesce(country, 'Desconocido') AS country FROM ins)"""
_SPRG = "sprg AS (SELECT * FROM prg WHERE total_lessons >= 1)"
_VENR = "venr AS (SELECT * FROM senr WHERE payment_amount >= 0)"
# Percentages in whole hundredths, so that ties round the same way everywhere.
_PCT = """pct AS (
  SELECT *, (20000 * lessons_completed + total_lessons) // (2 * total_lessons) AS h FROM sprg)"""
_COMPLETION = """completion AS (
  SELECT course_id, title, category, count(user_id) AS total_usuarios,
         CAST((2 * sum(h) + count(h)) // (2 * count(h)) AS BIGINT) / 100.0::DOUBLE
         AS avg_completion_pct
  FROM pct LEFT JOIN scrs USING (course_id) GROUP BY course_id, title, category)"""
_COMPLETION_ONCE = """completion_once AS (
  SELECT course_id, title, count(user_id) AS total_usuarios,
         round(avg(lessons_completed / total_lessons * 100), 2) AS completion_pct
  FROM sprg LEFT JOIN scrs USING (course_id) GROUP BY course_id, title)"""


def _revenue(rows: str, amount: str) -> str:
    return f"""revenue AS (
  SELECT scrs.instructor_id, name, country,
         CAST(sum(CAST({amount} AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue_usd,
         count(enrollment_id) AS total_inscripciones
  FROM {rows} LEFT JOIN scrs USING (course_id)
  LEFT JOIN sins ON scrs.instructor_id = sins.instructor_id
  GROUP BY scrs.instructor_id, name, country)"""


def _category(rows: str, amount: str) -> str:
    return f"""cat AS (
  SELECT category, CAST(sum(CAST({amount} AS DECIMAL(18,2))) AS DOUBLE) AS revenue_usd,
         count(enrollment_id) AS inscripciones
  FROM {rows} LEFT JOIN scrs USING (course_id) GROUP BY category)"""


_INSCRITOS = """enrolled AS (
  SELECT course_id, count(enrollment_id) AS inscritos FROM senr GROUP BY course_id)"""
_LOW = f"""low AS (
  SELECT completion.*, inscritos FROM completion LEFT JOIN enrolled USING (course_id))"""
_CATEGORY = _category("senr", "payment_usd")
_REVENUE = _revenue("senr", "payment_usd")
_BASE = [_ENR, _CRS, _INS, _PRG, _SENR, _SCRS, _SINS, _SPRG, _VENR, _PCT]


def _sql(select: str, *more: str) -> str:
    return "WITH " + ",\n".join([*_BASE, *more]) + "\n" + select


_RULE_LINES = {
    "enrollments": """
  SELECT 'silver_enrollments' AS table_name, 'pago_valido' AS rule, 'drop' AS action,
         count(*) FILTER (WHERE payment_amount >= 0) AS passed,
         count(*) - count(*) FILTER (WHERE payment_amount >= 0) AS failed FROM enr
  UNION ALL
  SELECT 'silver_enrollments', 'course_id_no_nulo', 'warn', count(course_id),
         count(*) - count(course_id) FROM enr""",
    "courses": """
  SELECT 'silver_courses', 'course_id_existe', 'warn', count(course_id),
         count(*) - count(course_id) FROM crs""",
    "progress": """
  SELECT 'silver_progress', 'total_lessons_valido', 'drop',
         count(*) FILTER (WHERE total_lessons > 0),
         count(*) - count(*) FILTER (WHERE total_lessons > 0) FROM prg""",
}


def oracle_sql() -> dict[str, str]:
    found: dict[str, str] = dict(TRAINING_SQL)
    short = {"enrollments": "enr", "courses": "crs", "progress": "prg", "instructors": "ins"}
    for entity, view in short.items():
        raw = _sql(f"SELECT * FROM {view}")
        # An empty text column reads back from CSV as NULL.
        if entity == "courses":
            raw = _sql(
                "SELECT course_id, title, nullif(category, '') AS category, instructor_id FROM crs"
            )
        found[f"bronze_csv_{entity}"] = raw
        found[f"bronze_stream_{entity}"] = raw
        found[f"silver_{entity}"] = _sql(f"SELECT * FROM s{view}")
        found[f"silver_stream_{entity}"] = _sql(f"SELECT * FROM s{view}")
    found["silver_stream_enrollments"] = _sql("SELECT * FROM venr")
    rules = "\n  UNION ALL".join(_RULE_LINES.values())
    completion = _sql("SELECT * FROM completion", _COMPLETION)
    low = _sql("SELECT * FROM low", _COMPLETION, _INSCRITOS, _LOW)
    low_once = _sql(
        """SELECT completion_once.*, total_inscritos FROM completion_once LEFT JOIN (
             SELECT course_id, count(enrollment_id) AS total_inscritos FROM venr
             GROUP BY course_id) USING (course_id)""",
        _COMPLETION_ONCE,
    )
    revenue = _sql("SELECT * FROM revenue", _REVENUE)
    category = _sql("SELECT * FROM cat", _CATEGORY)
    category_month = _sql(
        """SELECT category, CAST(date_trunc('month', enrolled_at) AS DATE) AS month,
           CAST(sum(CAST(payment_usd AS DECIMAL(18,2))) AS DOUBLE) AS revenue_usd,
           count(enrollment_id) AS inscripciones
           FROM senr LEFT JOIN scrs USING (course_id) GROUP BY ALL"""
    )
    first = "enrolled_at < TIMESTAMP '1995-06-01'"
    level = "CASE WHEN instructor_id <= 25 THEN NULL ELSE 'L' || course_id END AS level"
    history = """
  SELECT 0 AS version, 'WRITE' AS operation, count(*) AS num_rows FROM senr
  UNION ALL SELECT 1, 'WRITE', count(*) FROM venr
  UNION ALL SELECT 2, 'CLUSTER', count(*) FROM venr"""
    found.update(
        {
            "quality_report": _sql(rules),
            "quality_report_stream": _sql(rules),
            "quality_report_batch": _sql(rules),
            "quality_report_observed": _sql(_RULE_LINES["enrollments"]),
            "expect_keep_rows": _sql("SELECT * FROM crs"),
            "expect_drop_rows": _sql("SELECT * FROM enr WHERE payment_amount >= 0"),
            "expect_fail_clean": _sql("SELECT * FROM enr WHERE payment_amount >= 0"),
            "progress_pct": _sql(
                """SELECT user_id, course_id, CAST(lessons_completed AS DOUBLE) AS lessons_completed,
                   CAST(total_lessons AS DOUBLE) AS total_lessons,
                   h / 100.0::DOUBLE AS completion_pct FROM pct"""
            ),
            "completion_rate": completion,
            "completion_rate_single_round": _sql(
                "SELECT * FROM completion_once", _COMPLETION_ONCE
            ),
            "revenue_by_instructor": revenue,
            "revenue_by_instructor_raw": _sql(
                "SELECT * FROM revenue", _revenue("venr", "payment_amount")
            ),
            "enrollments_per_course": _sql("SELECT * FROM enrolled", _INSCRITOS),
            "low_engagement": low,
            "low_engagement_single_round": low_once,
            "low_engagement_threshold": _sql(
                "SELECT * FROM low WHERE avg_completion_pct <= 60 AND inscritos >= 30",
                _COMPLETION,
                _INSCRITOS,
                _LOW,
            ),
            "revenue_by_category": category,
            "revenue_by_category_raw": _sql(
                "SELECT * FROM cat", _category("venr", "payment_amount")
            ),
            "revenue_by_category_month": category_month,
            "revenue_by_instructor_large_amounts": _sql(
                """SELECT scrs.instructor_id, name, country, CAST(sum((CAST(CAST(round(
                   payment_amount * 100) AS BIGINT) AS DECIMAL(20,0)) * 1000000 + 37) * 0.01)
                   AS DOUBLE) AS total_revenue_usd, count(enrollment_id) AS total_inscripciones
                   FROM enr LEFT JOIN scrs USING (course_id)
                   LEFT JOIN sins ON scrs.instructor_id = sins.instructor_id
                   GROUP BY scrs.instructor_id, name, country"""
            ),
            "revenue_by_category_small_amounts": _sql(
                """SELECT category, CAST(round(sum(CAST(CAST(round(payment_amount * 100)
                   AS BIGINT) AS DECIMAL(18,0)) * 0.000000000001), 2) AS DOUBLE) AS revenue_usd,
                   count(enrollment_id) AS inscripciones
                   FROM enr LEFT JOIN scrs USING (course_id) GROUP BY category"""
            ),
            "top_categories": _sql(
                "SELECT * FROM cat ORDER BY revenue_usd DESC NULLS LAST, category LIMIT 3",
                _CATEGORY,
            ),
            "headline_totals": _sql(
                """SELECT 'mean_completion_pct' AS metric, CAST(
                   (2 * sum(CAST(round(avg_completion_pct * 100) AS BIGINT)) + count(*))
                   // (2 * count(*)) AS BIGINT) / 100.0::DOUBLE AS value FROM completion
                   UNION ALL SELECT 'total_revenue_usd',
                   CAST(sum(CAST(total_revenue_usd AS DECIMAL(18,2))) AS DOUBLE) FROM revenue""",
                _COMPLETION,
                _REVENUE,
            ),
            "layer_row_counts": _sql(
                "\nUNION ALL ".join(
                    f"SELECT '{layer}' AS layer, '{name}' AS table_name,"
                    f" count(*) AS row_count FROM {view}"
                    for layer, name, view in [
                        *[("bronze", f"bronze_{e}", v) for e, v in short.items()],
                        *[("silver", f"silver_{e}", f"s{v}") for e, v in short.items()],
                        ("gold", "gold_completion_rate", "completion"),
                        ("gold", "gold_revenue_instructor", "revenue"),
                        ("gold", "gold_cursos_abandonados", "low"),
                        ("gold", "gold_top_categorias", "cat"),
                    ]
                ),
                _COMPLETION,
                _INSCRITOS,
                _LOW,
                _REVENUE,
                _CATEGORY,
            ),
            "layer_rejections": _sql(
                """, counts AS ("""
                + " UNION ALL ".join(
                    f"""SELECT '{e}' AS entity, (SELECT count(*) FROM {v}) AS rows_in,
                    (SELECT count(*) FROM s{v}) AS rows_kept"""
                    for e, v in short.items()
                )
                + """) SELECT *, rows_in - rows_kept AS rows_rejected FROM counts UNION ALL
                SELECT 'total', CAST(sum(rows_in) AS BIGINT), CAST(sum(rows_kept) AS BIGINT),
                CAST(sum(rows_in - rows_kept) AS BIGINT) FROM counts"""
            ),
            "gold_from_stream": _sql(
                "SELECT * FROM revenue", _revenue("venr", "payment_usd")
            ),
            "gold_from_two_drops": _sql(
                "SELECT * FROM revenue", _revenue("venr", "payment_usd")
            ),
            "silver_stream_as_of": _sql(f"SELECT * FROM venr WHERE {first}"),
            "silver_stream_history": _sql(
                f"""SELECT 0 AS version, 'APPEND' AS operation, count(*) AS num_rows, 0::BIGINT AS batch_id
                   FROM venr WHERE {first}
                   UNION ALL SELECT 1, 'APPEND', count(*), 1 FROM venr WHERE ({first}) IS NOT TRUE"""
            ),
            "bronze_csv_new_column": _sql(
                f"""SELECT course_id, title, nullif(category, '') AS category, instructor_id, {level}
                   FROM crs"""
            ),
            "silver_stream_new_column": _sql(f"SELECT *, {level} FROM scrs"),
            "gold_from_stream_low_engagement": low_once,
            "gold_from_stream_categories": _sql(
                "SELECT * FROM cat", _category("venr", "payment_usd")
            ),
            "gold_from_batch_completion": completion,
            "gold_from_batch_low_engagement": low,
            "gold_from_batch_revenue": revenue,
            "gold_from_batch_categories": category,
            "completion_rate_large_courses": completion,
            "revenue_by_instructor_large_courses": revenue,
            "revenue_by_category_month_large_courses": category_month,
            "version_as_of": _sql("SELECT * FROM senr"),
            "batch_version_as_of": _sql("SELECT * FROM senr"),
            "batch_table_history": _sql(
                """SELECT 0 AS version, 'WRITE' AS operation, count(*) AS num_rows FROM senr
                   UNION ALL SELECT 1, 'WRITE', count(*) FROM venr"""
            ),
            "rows_after_expiry": _sql("SELECT * FROM venr"),
            "version_as_of_limit": _sql(
                """SELECT * FROM senr ORDER BY enrollment_id NULLS FIRST, course_id NULLS FIRST,
                   payment_amount NULLS FIRST, currency NULLS FIRST, enrolled_at NULLS FIRST,
                   payment_usd NULLS FIRST LIMIT 10"""
            ),
            "table_history": _sql(history),
            "versions_to_expire": _sql(
                "SELECT 0 AS version, 'WRITE' AS operation, count(*) AS num_rows FROM senr"
            ),
            "expired_history": _sql(
                history
                + """
  UNION ALL SELECT 0, 'EXPIRE', count(*) FROM senr
  UNION ALL SELECT 1, 'EXPIRE', count(*) FROM venr"""
            ),
            "clustered_two_columns_read": _sql(
                "SELECT * FROM senr WHERE course_id BETWEEN 20 AND 60"
            ),
            "retained_history": _sql(
                """SELECT 1 AS version, 'WRITE' AS operation, count(*) AS num_rows FROM venr
                   UNION ALL SELECT 2, 'WRITE', count(*) FROM venr"""
            ),
            "clustered_range_read": _sql(
                """SELECT * FROM senr WHERE enrolled_at
                   BETWEEN TIMESTAMP '1995-01-01' AND TIMESTAMP '1995-12-31'"""
            ),
        }
    )
    return found
