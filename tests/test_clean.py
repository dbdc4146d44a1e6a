from orefold.operators import clean
from rows import frames


def test_country_is_filled_on_null_only(spark):
    rows = clean.fill_country(frames(spark)["instructors"]).collect()
    assert {r.instructor_id: r.country for r in rows} == {
        "i1": "PE", "i2": "Desconocido", "i3": "", "i4": "MX",
    }


def test_category_null_and_empty(spark):
    rows = clean.standardise_category(frames(spark)["courses"]).collect()
    by_id = {r.course_id: r.category for r in rows}
    assert by_id["c1"] == "data"
    assert by_id["c2"] == by_id["c3"] == "Sin categoría"


def test_valid_progress(spark):
    rows = clean.valid_progress(frames(spark)["progress"]).collect()
    assert {r.user_id for r in rows} == {
        "u1", "u2", "u3", "u9", "u10", None, "u12", "u13", "u14", "u15",
    }


def test_completion_pct(spark):
    valid = clean.valid_progress(frames(spark)["progress"])
    pct = {r.user_id: r.completion_pct for r in clean.with_completion(valid).collect()}
    assert pct["u2"] == 33.33 and pct["u3"] == 120.0 and pct["u9"] == 66.67
    assert pct["u10"] is None and pct["u12"] == 12.5
    once = clean.with_completion(valid, rounded=False).collect()
    assert {r.user_id: r.completion_pct for r in once}["u2"] == 1 / 3 * 100


def test_usd_keeps_raw_columns(spark):
    df = clean.with_usd(frames(spark)["enrollments"])
    by_id = {r.enrollment_id: r for r in df.collect()}
    assert by_id["e1"].payment_amount == "100" and by_id["e1"].payment_usd == 5.8
    assert by_id["e12"].payment_usd is None and by_id["e15"].payment_usd == 3.0
    assert by_id["e10"].payment_usd == -40.0


def test_with_payment(spark):
    assert clean.with_payment(frames(spark)["enrollments"]).count() == 15


def test_typed_filter_reaches_the_scan(spark, space):
    path = f"{space.folder}/typed"
    spark.range(100).selectExpr("id AS total_lessons", "id AS other").write.parquet(path)
    plan = clean.valid_progress(spark.read.parquet(path)).select("total_lessons")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(total_lessons,1)" in text
    assert "ReadSchema: struct<total_lessons:bigint>" in text
