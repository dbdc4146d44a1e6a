import pytest
from pyspark.sql import Observation

from orefold.operators.quality import (
    Rule,
    apply_rules,
    course_rules,
    enrollment_rules,
    progress_rules,
    report_rows,
    rule_report,
)
from orefold.sources.tables import overwrite_table
from rows import frames


def test_drop_removes_null_nan_negative_and_text(spark):
    df = frames(spark)["enrollments"]
    kept = {r.enrollment_id for r in apply_rules(df, enrollment_rules(df)).collect()}
    assert kept == {"e1", "e2", "e3", "e4", "e5", "e6", "e7", "e8", "e11", None, "e14", "e15"}


def test_warn_keeps_every_row(spark):
    df = frames(spark)["courses"]
    assert apply_rules(df, course_rules(df)).count() == df.count()


def test_report(spark):
    raw = frames(spark)
    lines = [
        tuple(r)
        for entity, rules in (
            ("enrollments", enrollment_rules), ("courses", course_rules), ("progress", progress_rules),
        )
        for r in rule_report(raw[entity], rules(raw[entity]), entity).collect()
    ]
    assert lines == [
        ("enrollments", "pago_valido", "drop", 12, 4),
        ("enrollments", "course_id_no_nulo", "warn", 15, 1),
        ("courses", "course_id_existe", "warn", 8, 1),
        ("progress", "total_lessons_valido", "drop", 10, 6),
    ]


def test_report_of_no_rows(spark):
    df = frames(spark)["courses"].limit(0)
    assert [tuple(r) for r in rule_report(df, course_rules(df), "t").collect()] == [
        ("t", "course_id_existe", "warn", 0, 0)
    ]


def test_metrics_do_not_depend_on_rule_order(spark):
    df = frames(spark)["enrollments"]
    rules = enrollment_rules(df)
    forward = {tuple(r) for r in rule_report(df, rules, "t").collect()}
    assert forward == {tuple(r) for r in rule_report(df, rules[::-1], "t").collect()}


def test_observed_counts_match_the_report(spark, space):
    df = frames(spark)["enrollments"]
    rules = enrollment_rules(df)
    seen = Observation("rules")
    stored = overwrite_table(apply_rules(df, rules, seen), space.table("kept"))
    assert stored.count() == 12
    assert report_rows(seen.get, rules, "t") == [
        tuple(r) for r in rule_report(df, rules, "t").collect()
    ]


def test_fail_stops_the_job_even_for_rows_another_rule_drops(spark, space):
    path = f"{space.folder}/in"
    spark.sql("SELECT * FROM VALUES (1L, -5.0D), (NULL, -6.0D), (3L, 7.0D) AS t(id, amount)") \
        .write.parquet(path)
    df = spark.read.parquet(path)
    rules = [Rule("positive", "amount >= 0", "drop"), Rule("has_id", "id IS NOT NULL", "fail")]
    with pytest.raises(Exception, match="rule failed: has_id"):
        apply_rules(df, rules).write.format("noop").mode("overwrite").save()
    # Also when no column of the result needs the check.
    with pytest.raises(Exception, match="rule failed: has_id"):
        apply_rules(df, rules).count()
    clean = df.filter("id IS NOT NULL")
    assert [r.id for r in apply_rules(clean, rules).collect()] == [3]


def test_null_result_fails(spark):
    df = spark.createDataFrame([(None,), (1,)], "x int")
    with pytest.raises(Exception, match="rule failed: big"):
        apply_rules(df, [Rule("big", "x > 0", "fail")]).collect()
    assert apply_rules(df, [Rule("big", "x > 0", "drop")]).count() == 1


def test_drop_rule_reaches_the_scan(spark, space):
    path = f"{space.folder}/typed"
    spark.range(100).selectExpr("id AS course_id", "id * 1.0D AS payment_amount").write.parquet(path)
    df = spark.read.parquet(path)
    text = apply_rules(df, enrollment_rules(df))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(payment_amount,0.0)" in text
