"""Each metric against the plain join-then-group form, on rows with every awkward case."""

from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from orefold.operators import clean, metrics
from orefold.operators.joins import join_dimension
from rows import frames, sorted_rows


@pytest.fixture(scope="module")
def silver(spark):
    raw = frames(spark)
    enrollments = raw["enrollments"].filter("payment_amount IS DISTINCT FROM 'NaN'")
    return {
        "enrollments": clean.with_usd(enrollments),
        "courses": clean.standardise_category(raw["courses"]),
        "progress": clean.valid_progress(raw["progress"]),
        "instructors": clean.fill_country(raw["instructors"]),
    }


WAYS = [
    {},
    {"salts": 1},
    {"salts": 4},
]


#: Instructor, name, country, revenue and enrollments, worked out by hand from ``rows.py``.
#: c1 (i1): e1 5.80, e2 240.00, e9 none, e10 -40, e11 0; c3 (i1): e5 7, e6 1.01.
#: c2 (i2): e3 2.70, e4 50.50, e12 unreadable, one of 5 without an id; c5 (i2 twice, i3): e15 3.
#: c4 leads to an unknown instructor (i9); e7 and e8 have no known course.
REVENUE = {
    "payment_usd": [
        ("i1", "Ana", "PE", 213.81, 7),
        ("i2", "Beto", "Desconocido", 64.2, 5),
        ("i3", "Caro", "", 3.0, 1),
        ("i9", None, None, 9.0, 1),
        (None, None, None, 50.0, 2),
    ],
    # Unconverted: e2 is 1,000,000, e1 100, e3 10, and e6 is not rounded before the sum.
    "payment_amount": [
        ("i1", "Ana", "PE", 1000068.01, 7),
        ("i2", "Beto", "Desconocido", 71.5, 5),
        ("i3", "Caro", "", 3.0, 1),
        ("i9", None, None, 9.0, 1),
        (None, None, None, 50.0, 2),
    ],
}


@pytest.mark.parametrize("way", WAYS)
@pytest.mark.parametrize("amount", ["payment_usd", "payment_amount"])
def test_revenue_by_instructor(silver, way, amount):
    got = metrics.revenue_by_instructor(
        silver["enrollments"], silver["courses"], silver["instructors"], amount=amount, **way
    )
    assert sorted_rows(got) == sorted(REVENUE[amount], key=repr)
    totals = [r.total_revenue_usd for r in got.collect()]
    known = [t for t in totals if t is not None]
    assert known == sorted(known, reverse=True) and totals[: len(known)] == known


@pytest.mark.parametrize("way", WAYS)
def test_other_fact_columns_do_not_collide(silver, way):
    more = silver["enrollments"].withColumns(
        {c: F.lit("x") for c in ("instructor_id", "category", "title", "name")}
    )
    got = metrics.revenue_by_instructor(more, silver["courses"], silver["instructors"], **way)
    assert sorted_rows(got) == sorted(REVENUE["payment_usd"], key=repr)
    got = metrics.revenue_by_category(more, silver["courses"], **way)
    want = metrics.revenue_by_category(silver["enrollments"], silver["courses"], **way)
    assert got.collect() == want.collect()


@pytest.mark.parametrize("way", WAYS)
def test_revenue_by_category(silver, way):
    got = metrics.revenue_by_category(silver["enrollments"], silver["courses"], **way)
    want = (
        silver["enrollments"]
        .join(silver["courses"].select("course_id", "category"), "course_id", "left")
        .groupBy("category")
        .agg(
            F.round(F.sum("payment_usd"), 2).alias("revenue_usd"),
            F.count("enrollment_id").alias("inscripciones"),
        )
    )
    assert sorted_rows(got) == sorted_rows(want)
    assert None in {r.category for r in got.collect()}


@pytest.mark.parametrize("way", WAYS)
def test_revenue_by_category_month(silver, way):
    got = metrics.revenue_by_category_month(silver["enrollments"], silver["courses"], **way)
    want = (
        silver["enrollments"]
        .withColumn("month", F.trunc(F.to_date("enrolled_at"), "month"))
        .join(silver["courses"].select("course_id", "category"), "course_id", "left")
        .groupBy("category", "month")
        .agg(
            F.round(F.sum("payment_usd"), 2).alias("revenue_usd"),
            F.count("enrollment_id").alias("inscripciones"),
        )
    )
    assert sorted_rows(got) == sorted_rows(want)


def test_top_k(silver):
    every = metrics.revenue_by_category(silver["enrollments"], silver["courses"]).collect()
    top = metrics.revenue_by_category(silver["enrollments"], silver["courses"], k=2).collect()
    assert top == every[:2]


@pytest.mark.parametrize("way", WAYS)
def test_completion_rate(silver, way):
    got = metrics.completion_rate(silver["progress"], silver["courses"], **way)
    want = (
        clean.with_completion(silver["progress"])
        .join(silver["courses"].select("course_id", "title", "category"), "course_id", "left")
        .groupBy("course_id", "title", "category")
        .agg(
            F.count("user_id").alias("total_usuarios"),
            F.round(F.avg(F.col("completion_pct").cast("decimal(18,2)")), 2)
            .cast("double")
            .alias("avg_completion_pct"),
        )
    )
    assert sorted_rows(got) == sorted_rows(want)


@pytest.mark.parametrize("way", WAYS)
def test_completion_rate_single_round(silver, way):
    got = metrics.completion_rate_single_round(silver["progress"], silver["courses"], **way)
    want = (
        clean.with_completion(silver["progress"], rounded=False)
        .join(silver["courses"].select("course_id", "title"), "course_id", "left")
        .groupBy("course_id", "title")
        .agg(
            F.count("user_id").alias("total_usuarios"),
            F.round(F.avg("completion_pct"), 2).alias("completion_pct"),
        )
    )
    assert sorted_rows(got) == sorted_rows(want)


def test_rounding_once_and_twice_differ(spark):
    rows = [("u", "c", "1", "3"), ("u", "c", "1", "3"), ("u", "c", "1", "6")] * 5
    progress = spark.createDataFrame(
        rows + [("u", "c", "1", "7")], "user_id string, course_id string, lessons_completed string, total_lessons string"
    )
    courses = frames(spark)["courses"]
    twice = metrics.completion_rate(progress, courses).first()
    once = metrics.completion_rate_single_round(progress, courses).first()
    assert twice.avg_completion_pct == 26.93 and once.completion_pct == 26.93
    tie = spark.createDataFrame(
        [("u", "c", "1", "800"), ("u", "c", "1", "1600")], progress.schema
    )
    assert metrics.completion_rate(tie, courses).first().avg_completion_pct == 0.1
    assert metrics.completion_rate_single_round(tie, courses).first().completion_pct == 0.09


def test_low_engagement(silver):
    completion = metrics.completion_rate(silver["progress"], silver["courses"])
    rows = metrics.low_engagement(completion, silver["enrollments"]).collect()
    assert len(rows) == completion.count()
    rates = [r.avg_completion_pct for r in rows]
    assert rates == sorted(rates)
    counts = {r.course_id: r.inscritos for r in rows}
    assert counts["c1"] == 5 and counts["c2"] == 3 and counts[None] is None
    few = metrics.low_engagement(
        completion, silver["enrollments"], max_completion=70, min_enrolled=2
    )
    assert {r.course_id for r in few.collect()} == {"c1", "c2"}
    assert [tuple(r) for r in metrics.low_engagement(completion, silver["enrollments"], k=2).collect()] == [
        tuple(r) for r in rows[:2]
    ]


def test_low_engagement_puts_null_rates_first(spark, silver):
    progress = spark.createDataFrame(
        [("u1", "c1", None, "4"), ("u2", "c2", "1", "4")], silver["progress"].schema
    )
    completion = metrics.completion_rate(progress, silver["courses"])
    rows = metrics.low_engagement(completion, silver["enrollments"]).collect()
    assert [r.avg_completion_pct for r in rows] == [None, 25.0]


def test_headline_totals(silver):
    completion = metrics.completion_rate(silver["progress"], silver["courses"])
    revenue = metrics.revenue_by_instructor(
        silver["enrollments"], silver["courses"], silver["instructors"]
    )
    values = {r.metric: r.value for r in metrics.headline_totals(completion, revenue).collect()}
    rates = [r.avg_completion_pct for r in completion.collect()]
    assert values["mean_completion_pct"] == pytest.approx(sum(rates) / len(rates), abs=0.0051)
    assert values["total_revenue_usd"] == pytest.approx(
        sum(r.total_revenue_usd for r in revenue.collect() if r.total_revenue_usd)
    )


def test_counts_add_up(silver):
    per_course = metrics.enrollments_per_course(silver["enrollments"])
    total = per_course.agg(F.sum("inscritos")).first()[0]
    assert total == silver["enrollments"].filter("enrollment_id IS NOT NULL").count()


# -- skew --------------------------------------------------------------------


@pytest.fixture(scope="module")
def hot(spark):
    """A third of the facts on one course, a third without one; a third of the
    courses are copies of one row and a third share a key."""
    facts = spark.range(0, 60_000, 1, 8).selectExpr(
        "id AS enrollment_id",
        "CASE id % 3 WHEN 0 THEN 1 WHEN 1 THEN NULL ELSE id % 500 END AS course_id",
        "(id % 1000) / 100.0D AS payment_usd",
    )
    courses = spark.range(0, 600, 1, 4).selectExpr(
        "CASE id % 3 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE id END AS course_id",
        "CASE id % 3 WHEN 0 THEN 7 WHEN 1 THEN id % 40 ELSE id % 40 END AS instructor_id",
    )
    instructors = spark.range(0, 40).selectExpr(
        "id AS instructor_id", "'n' || id AS name", "'x' AS country"
    )
    return facts, courses, instructors


@pytest.mark.parametrize("way", WAYS)
def test_hot_keys_keep_every_row(hot, way):
    facts, courses, instructors = hot
    got = metrics.revenue_by_instructor(facts, courses, instructors, **way)
    want = (
        facts.join(courses, "course_id", "left")
        .join(instructors, "instructor_id", "left")
        .groupBy("instructor_id", "name", "country")
        .agg(
            F.sum(F.col("payment_usd").cast("decimal(18,2)")).cast("double").alias("t"),
            F.count("enrollment_id").alias("n"),
        )
    )
    assert sorted_rows(got) == sorted_rows(want)


def test_facts_are_never_shuffled_row_by_row(spark, hot):
    facts, courses, instructors = hot
    for way in WAYS:
        df = metrics.revenue_by_instructor(facts, courses, instructors, **way)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
        # The range that stands for the facts lies under a partial aggregate or a
        # broadcast join, with no exchange in between.
        depth = plan.split("Range (0, 60000")[0]
        last_exchange = max(depth.rfind("Exchange hashpartitioning"), depth.rfind("Exchange range"))
        assert "partial_sum" in depth[last_exchange:] or "partial_count" in depth[last_exchange:]


def test_salted_join_spreads_a_key_and_keeps_unmatched(spark):
    facts = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k bigint, f string")
    dimension = spark.range(0, 1000).selectExpr("1L AS k", "id % 300 AS v")
    plain = join_dimension(facts, dimension, "k", ["v"], salts=1)
    salted = join_dimension(facts, dimension, "k", ["v"], salts=8)
    columns = ["k", "f", "v", "_copies"]
    assert sorted_rows(salted.select(*columns)) == sorted_rows(plain.select(*columns))
    assert salted.count() == 302
    assert sorted_rows(join_dimension(facts, dimension, "k", ["v"]).select(*columns)) == sorted_rows(
        plain.select(*columns)
    )


@pytest.mark.parametrize("way", WAYS)
def test_building_a_metric_starts_no_job(spark, hot, way):
    facts, courses, instructors = hot
    tracker = spark.sparkContext.statusTracker()
    group = f"building {way}"
    spark.sparkContext.setJobGroup(group, "metrics")
    try:
        revenue = metrics.revenue_by_instructor(facts, courses, instructors, **way)
        progress = facts.selectExpr("enrollment_id AS user_id", "course_id", "1D AS lessons_completed", "2D AS total_lessons")
        titled = courses.selectExpr("course_id", "'t' AS title", "'c' AS category")
        rates = metrics.completion_rate(progress, titled, **way)
        metrics.completion_rate_single_round(progress, titled, **way)
        metrics.revenue_by_category(facts, titled, **way)
        metrics.headline_totals(rates, revenue)
        assert not tracker.getJobIdsForGroup(group)
        rates.collect()
        assert tracker.getJobIdsForGroup(group)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


# -- digits --------------------------------------------------------------------


@pytest.mark.parametrize("unit", [4e-7, 1e-12, 1e9 + 0.37, 3e15 + 0.5, 1.005])
def test_no_digit_depends_on_size_or_layout(spark, unit):
    """40,000 rows of ``unit`` times 1, 2 or 3, against sums of Python decimals."""
    rows = spark.range(0, 40_000, 1, 4).selectExpr(
        "id AS enrollment_id", "id % 2 AS course_id", f"(id % 3 + 1) * {unit!r}D AS payment_usd"
    )
    courses = spark.range(2).selectExpr("id AS course_id", "id AS instructor_id", "'c' AS category")
    instructors = spark.range(2).selectExpr("id AS instructor_id", "'n' AS name", "'x' AS country")
    cents = Decimal("0.01")
    exact = [Decimal(0), Decimal(0)]
    for i in range(40_000):
        exact[i % 2] += Decimal(repr((i % 3 + 1) * unit))
    want = {i: float(t.quantize(cents, ROUND_HALF_UP)) for i, t in enumerate(exact)}
    both = float(sum(exact).quantize(cents, ROUND_HALF_UP))
    for layout in (rows, rows.repartition(3), rows.repartition(7)):
        revenue = metrics.revenue_by_instructor(layout, courses, instructors)
        assert {r.instructor_id: r.total_revenue_usd for r in revenue.collect()} == want
        [category] = metrics.revenue_by_category(layout, courses).collect()
        assert category.revenue_usd == both
        totals = revenue.selectExpr("total_revenue_usd", "0D AS avg_completion_pct")
        values = {r.metric: r.value for r in metrics.headline_totals(totals, totals).collect()}
        assert values["total_revenue_usd"] == float(sum(Decimal(repr(v)) for v in want.values()))


def test_mean_of_unrounded_percentages_is_the_same_in_any_layout(spark):
    progress = spark.range(0, 30_000, 1, 4).selectExpr(
        "id AS user_id", "1L AS course_id", "(id * 7) % (id % 89 + 1) AS lessons_completed",
        "id % 89 + 1 AS total_lessons",
    )
    courses = spark.createDataFrame([(1, "t")], "course_id long, title string")
    exact = sum(Decimal(repr((i * 7) % (i % 89 + 1) / (i % 89 + 1) * 100)) for i in range(30_000)) / 30_000
    want = float(exact.quantize(Decimal("0.01"), ROUND_HALF_UP))
    for parts in (1, 3, 8):
        got = metrics.completion_rate_single_round(progress.repartition(parts), courses).first()
        assert got.completion_pct == want
