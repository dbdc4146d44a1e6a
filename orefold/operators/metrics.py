"""Gold metrics.

Facts are aggregated by course, joined with the courses, and aggregated again where a metric
is by an attribute of the course (see ``joins``), so only partial sums cross the network.
Revenue by category and month is the one exception: its facts meet the courses row by row.
Building a metric starts no job. Sums are exact to eighteen places and do not depend on row
order. Sorted results break ties by key, which makes the order total and lets the range sort
split a run of equal values.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.exact import ExactSum, weighted_count
from ..functions.numbers import number, quoted
from .clean import with_completion
from .joins import SALTS, TIMES, join_dimension, join_facts

_MONEY = ExactSum("_money")
_PERCENT = ExactSum("_percent")
_ROWS = "_rows"


def _sorted(df: DataFrame, order: list[Column], k: int | None) -> DataFrame:
    df = df.orderBy(*order)
    return df if k is None else df.limit(k)


def completion_per_course(
    progress: DataFrame,
    rounded: bool = True,
    user: str = "user_id",
    course: str = "course_id",
) -> DataFrame:
    """Exact sums of completion by course, one row each; ``add_completion`` adds two such tables."""
    return (
        with_completion(progress, rounded=rounded)
        .groupBy(course)
        .agg(F.count(user).alias(_ROWS), *_PERCENT.first("completion_pct"))
    )


def money_per_course(
    enrollments: DataFrame,
    amount: str = "payment_usd",
    enrollment: str = "enrollment_id",
    course: str = "course_id",
) -> DataFrame:
    """Exact sums of money by course, one row each; ``add_money`` adds two such tables."""
    return enrollments.groupBy(course).agg(
        F.count(enrollment).alias(_ROWS), *_MONEY.first(number(enrollments, amount))
    )


def _added(a: DataFrame, b: DataFrame, sums: ExactSum, course: str) -> DataFrame:
    # Columns by position: both tables were made by the same function.
    both = a.union(b.select(*a.columns))
    return both.groupBy(course).agg(F.sum(_ROWS).alias(_ROWS), *sums.again("1L"))


def add_completion(a: DataFrame, b: DataFrame, course: str = "course_id") -> DataFrame:
    return _added(a, b, _PERCENT, course)


def add_money(a: DataFrame, b: DataFrame, course: str = "course_id") -> DataFrame:
    return _added(a, b, _MONEY, course)


def completion_rate(
    progress: DataFrame,
    courses: DataFrame,
    user: str = "user_id",
    course: str = "course_id",
    title: str = "title",
    category: str = "category",
    salts: int = SALTS,
) -> DataFrame:
    """Users and mean completion per course; each row is rounded, then the mean."""
    per_course = completion_per_course(progress, True, user, course)
    joined = join_dimension(per_course, courses, course, [title, category], salts)
    return joined.select(
        course,
        title,
        category,
        F.expr(f"{_ROWS} * {TIMES}").alias("total_usuarios"),
        _PERCENT.mean().alias("avg_completion_pct"),
    )


def completion_rate_single_round(
    progress: DataFrame,
    courses: DataFrame,
    user: str = "user_id",
    course: str = "course_id",
    title: str = "title",
    salts: int = SALTS,
) -> DataFrame:
    """Users and mean completion per course; only the mean is rounded."""
    per_course = completion_per_course(progress, False, user, course)
    return course_completion_single_round(per_course, courses, course, title, salts)


def course_completion_single_round(
    per_course: DataFrame,
    courses: DataFrame,
    course: str = "course_id",
    title: str = "title",
    salts: int = SALTS,
) -> DataFrame:
    """``completion_rate_single_round`` out of ``completion_per_course``."""
    joined = join_dimension(per_course, courses, course, [title], salts)
    return joined.select(
        course,
        title,
        F.expr(f"{_ROWS} * {TIMES}").alias("total_usuarios"),
        _PERCENT.mean().alias("completion_pct"),
    )


def _money_by_attribute(
    per_course: DataFrame, courses: DataFrame, course: str, attribute: str, salts: int
) -> DataFrame:
    """Money and rows by an attribute of the course."""
    return (
        join_dimension(per_course, courses, course, [attribute], salts)
        .groupBy(attribute)
        .agg(F.expr(f"sum({_ROWS} * {TIMES}) AS {_ROWS}"), *_MONEY.again(TIMES))
    )


def revenue_by_instructor(
    enrollments: DataFrame,
    courses: DataFrame,
    instructors: DataFrame,
    amount: str = "payment_usd",
    enrollment: str = "enrollment_id",
    course: str = "course_id",
    instructor: str = "instructor_id",
    name: str = "name",
    country: str = "country",
    k: int | None = None,
    salts: int = SALTS,
    per_course: DataFrame | None = None,
) -> DataFrame:
    """Revenue and enrollments per instructor, highest revenue first.

    Enrollments without a known course form the group with a NULL instructor. Pass
    ``amount="payment_amount"`` for sums of the unconverted amounts, and ``per_course`` where
    ``money_per_course`` of the same enrollments is there already.
    """
    if per_course is None:
        per_course = money_per_course(enrollments, amount, enrollment, course)
    return instructor_revenue(
        per_course, courses, instructors, course, instructor, name, country, k, salts
    )


def instructor_revenue(
    per_course: DataFrame,
    courses: DataFrame,
    instructors: DataFrame,
    course: str = "course_id",
    instructor: str = "instructor_id",
    name: str = "name",
    country: str = "country",
    k: int | None = None,
    salts: int = SALTS,
) -> DataFrame:
    """``revenue_by_instructor`` out of ``money_per_course``."""
    per_instructor = _money_by_attribute(per_course, courses, course, instructor, salts)
    joined = join_dimension(per_instructor, instructors, instructor, [name, country], salts)
    result = joined.select(
        instructor,
        name,
        country,
        _MONEY.total(TIMES).alias("total_revenue_usd"),
        F.expr(f"{_ROWS} * {TIMES}").alias("total_inscripciones"),
    )
    order = [F.desc("total_revenue_usd"), F.asc(instructor), F.asc(name), F.asc(country)]
    return _sorted(result, order, k)


def enrollments_per_course(
    enrollments: DataFrame,
    enrollment: str = "enrollment_id",
    course: str = "course_id",
    target: str = "inscritos",
) -> DataFrame:
    return enrollments.groupBy(course).agg(F.count(enrollment).alias(target))


def enrolled(
    per_course: DataFrame, course: str = "course_id", target: str = "inscritos"
) -> DataFrame:
    """``enrollments_per_course`` out of ``money_per_course``."""
    return per_course.select(course, F.col(_ROWS).alias(target))


def low_engagement(
    completion: DataFrame,
    enrollments: DataFrame,
    enrollment: str = "enrollment_id",
    course: str = "course_id",
    rate: str = "avg_completion_pct",
    target: str = "inscritos",
    max_completion: float | None = None,
    min_enrolled: int | None = None,
    k: int | None = None,
    per_course: DataFrame | None = None,
) -> DataFrame:
    """Completion per course with its enrollments, lowest completion first.

    Without limits every course with progress appears. ``max_completion`` and
    ``min_enrolled`` narrow it to well-attended courses that few people finish. ``per_course``
    is ``money_per_course`` of the same enrollments, where it is there already.
    """
    if per_course is None:
        counts = enrollments_per_course(enrollments, enrollment, course, target)
    else:
        counts = enrolled(per_course, course, target)
    return by_engagement(
        completion, counts, course, rate, target, max_completion, min_enrolled, k
    )


def by_engagement(
    completion: DataFrame,
    counts: DataFrame,
    course: str = "course_id",
    rate: str = "avg_completion_pct",
    target: str = "inscritos",
    max_completion: float | None = None,
    min_enrolled: int | None = None,
    k: int | None = None,
) -> DataFrame:
    """``low_engagement`` out of counts per course."""
    result = completion.join(counts, course, "left")
    if max_completion is not None:
        result = result.filter(F.col(rate) <= max_completion)
    if min_enrolled is not None:
        result = result.filter(F.col(target) >= min_enrolled)
    ties = [F.asc(c) for c in completion.columns if c != rate]
    return _sorted(result, [F.asc(rate), *ties], k)


def revenue_by_category(
    enrollments: DataFrame,
    courses: DataFrame,
    amount: str = "payment_usd",
    enrollment: str = "enrollment_id",
    course: str = "course_id",
    category: str = "category",
    k: int | None = None,
    salts: int = SALTS,
    per_course: DataFrame | None = None,
) -> DataFrame:
    """Revenue and enrollments per category, highest revenue first.

    The NULL category holds enrollments whose course is unknown. ``per_course`` is
    ``money_per_course`` of the same enrollments, where it is there already.
    """
    if per_course is None:
        per_course = money_per_course(enrollments, amount, enrollment, course)
    return category_revenue(per_course, courses, course, category, k, salts)


def category_revenue(
    per_course: DataFrame,
    courses: DataFrame,
    course: str = "course_id",
    category: str = "category",
    k: int | None = None,
    salts: int = SALTS,
) -> DataFrame:
    """``revenue_by_category`` out of ``money_per_course``."""
    result = _money_by_attribute(per_course, courses, course, category, salts).select(
        category, _MONEY.total().alias("revenue_usd"), F.col(_ROWS).alias("inscripciones")
    )
    return _sorted(result, [F.desc("revenue_usd"), F.asc(category)], k)


def revenue_by_category_month(
    enrollments: DataFrame,
    courses: DataFrame,
    amount: str = "payment_usd",
    enrollment: str = "enrollment_id",
    course: str = "course_id",
    category: str = "category",
    enrolled_at: str = "enrolled_at",
    salts: int = SALTS,
) -> DataFrame:
    """Revenue and enrollments per category and first day of the month.

    Give ``salts`` above one for courses too many to broadcast: a course that is frequent
    in the facts is then spread over that many tasks.
    """
    day = f"CAST(try_cast({quoted(enrolled_at)} AS TIMESTAMP_NTZ) AS DATE)"
    dated = enrollments.withColumn("month", F.expr(f"trunc({day}, 'month')"))
    # Few facts share a course and a month, so aggregating first would save little.
    facts = dated.select(course, enrollment, amount, "month")
    joined = join_facts(facts, courses, course, [category], salts)
    per_month = joined.groupBy(category, "month").agg(
        F.expr(f"{weighted_count(quoted(enrollment), TIMES)} AS {_ROWS}"),
        *_MONEY.first(number(enrollments, amount), TIMES),
    )
    return per_month.select(
        category,
        "month",
        _MONEY.total().alias("revenue_usd"),
        F.col(_ROWS).alias("inscripciones"),
    ).orderBy(F.asc(category), F.asc("month"))


def headline_totals(
    completion: DataFrame,
    revenue: DataFrame,
    rate: str = "avg_completion_pct",
    amount: str = "total_revenue_usd",
) -> DataFrame:
    """Mean completion over courses and revenue over instructors, one row each."""
    mean = completion.agg(*_PERCENT.first(quoted(rate))).select(
        F.lit("mean_completion_pct").alias("metric"), _PERCENT.mean().alias("value")
    )
    total = revenue.agg(*_MONEY.first(quoted(amount))).select(
        F.lit("total_revenue_usd").alias("metric"), _MONEY.total().alias("value")
    )
    return reduce(DataFrame.unionByName, [mean, total])
