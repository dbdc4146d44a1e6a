import os

import pytest
from pyspark.sql import functions as F

from orefold.operators import clean, metrics
from orefold.operators.quality import Rule, apply_rules, enrollment_rules
from orefold.plans.incremental import Incremental
from orefold.sources.csv_files import read_csv, write_csv
from orefold.streaming.flows import Flow, run_flows, store_rule_metrics, stream_table, summarise_rule_metrics
from rows import frames, sorted_rows


def put(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w", encoding="utf-8") as f:
        f.write(text)


def incremental(spark, space, landing=None, **options):
    return Incremental(
        spark, landing or space.landing, space.schema, space.checkpoints, **options
    )


HEADERS = {
    "enrollments": "enrollment_id,course_id,payment_amount,currency,enrolled_at",
    "courses": "course_id,title,category,instructor_id",
    "progress": "user_id,course_id,lessons_completed,total_lessons",
    "instructors": "instructor_id,name,country",
}


def test_two_drops_of_plain_files_and_a_restart(spark, space, tmp_path):
    landing = str(tmp_path)
    put(landing, "enrollments.csv", HEADERS["enrollments"] + "\ne1,c1,100,MXN,2024-01-01\ne2,c1,-5,USD,2024-01-02\n")
    put(landing, "courses.csv", HEADERS["courses"] + "\nc1,Spark,,i1\n")
    put(landing, "progress.csv", HEADERS["progress"] + "\nu1,c1,1,2\nu2,c1,1,0\n")
    put(landing, "instructors.csv", HEADERS["instructors"] + "\ni1,Ana,\n")
    gold = incremental(spark, space, landing).run()
    assert [tuple(r) for r in gold["gold_revenue_instructor"].collect()] == [
        ("i1", "Ana", "Desconocido", 5.8, 1)
    ]
    assert [tuple(r) for r in gold["gold_completion_rate"].collect()] == [("c1", "Spark", 1, 50.0)]

    # Nothing new: the same tables again.
    gold = incremental(spark, space, landing).run()
    assert gold["gold_revenue_instructor"].first().total_inscripciones == 1

    put(landing, "enrollments_2.csv", HEADERS["enrollments"] + "\ne3,c1,10,PEN,2024-01-03\ne4,c7,,USD,2024-01-04\n")
    gold = incremental(spark, space, landing).run()
    assert [tuple(r) for r in gold["gold_revenue_instructor"].collect()] == [
        ("i1", "Ana", "Desconocido", 8.5, 2)
    ]
    assert gold["gold_cursos_abandonados"].first().total_inscritos == 2
    assert [tuple(r) for r in gold["gold_top_categorias"].collect()] == [("Sin categoría", 8.5, 2)]
    assert spark.table(space.table("bronze_enrollments_stream")).count() == 4
    per_batch = spark.table(space.table("rule_metrics_stream"))
    payments = per_batch.filter("rule = 'pago_valido'").orderBy("batch_id")
    assert [(r.batch_id, r.passed, r.failed) for r in payments.collect()] == [(0, 1, 1), (1, 1, 0)]
    total = summarise_rule_metrics(per_batch).filter("rule = 'pago_valido'").first()
    assert (total.passed, total.failed) == (2, 1)


def test_stream_equals_batch(spark, space):
    raw = frames(spark)
    for entity, df in raw.items():
        write_csv(df.repartition(3), space.landing, entity, "1")
    flows = incremental(spark, space, layout="folders", max_files=1)
    gold = flows.run()
    bronze = {e: read_csv(spark, space.landing, e) for e in raw}
    enrollments = clean.with_payment(bronze["enrollments"])
    enrollments = clean.with_usd(apply_rules(enrollments, enrollment_rules(enrollments)))
    courses = clean.standardise_category(bronze["courses"])
    progress = clean.valid_progress(bronze["progress"])
    instructors = clean.fill_country(bronze["instructors"])
    for entity, want in {
        "enrollments": enrollments, "courses": courses, "progress": progress, "instructors": instructors,
    }.items():
        got = spark.table(flows.table(f"silver_{entity}"))
        assert sorted_rows(got) == sorted_rows(want)
    completion = metrics.completion_rate_single_round(progress, courses)
    assert sorted_rows(gold["gold_completion_rate"]) == sorted_rows(completion)
    assert sorted_rows(gold["gold_revenue_instructor"]) == sorted_rows(
        metrics.revenue_by_instructor(enrollments, courses, instructors)
    )
    assert sorted_rows(gold["gold_top_categorias"]) == sorted_rows(
        metrics.revenue_by_category(enrollments, courses)
    )
    assert sorted_rows(gold["gold_cursos_abandonados"]) == sorted_rows(
        metrics.low_engagement(
            completion, enrollments, rate="completion_pct", target="total_inscritos"
        )
    )


def test_unconverted_amounts(spark, space):
    raw = frames(spark)
    for entity in ("enrollments", "courses", "instructors"):
        write_csv(raw[entity], space.landing, entity)
    flows = incremental(
        spark, space, layout="folders", convert=False,
        entities=("enrollments", "courses", "instructors"),
    )
    flows.run_bronze()
    flows.run_silver()
    assert "payment_usd" not in spark.table(flows.table("silver_enrollments")).columns
    rows = {r.instructor_id: r.total_revenue_usd for r in flows.refresh_revenue().collect()}
    assert rows["i1"] == 100 + 1000000 + 0 + 7 + 1.01


def test_rules_before_the_filter_see_every_row(spark, space):
    write_csv(frames(spark)["progress"], space.landing, "progress")
    flows = incremental(spark, space, layout="folders", rules_first=True, entities=("progress",))
    flows.run_bronze()
    flows.run_silver()
    line = spark.table(flows.table("rule_metrics")).first()
    assert (line.rule, line.passed, line.failed) == ("total_lessons_valido", 10, 6)
    assert spark.table(flows.table("silver_progress")).count() == 10


@pytest.mark.parametrize("bound", [{"max_files": 1}, {"max_bytes": 1}])
def test_batches_are_bounded_and_their_counts_add_up(spark, space, bound):
    for part in range(3):
        rows = frames(spark)["enrollments"].coalesce(1)
        write_csv(rows, space.landing, "enrollments", str(part))
    flows = incremental(
        spark, space, layout="folders", entities=("enrollments",), rules_first=True, **bound
    )
    flows.run_bronze()
    flows.run_silver()
    per_batch = spark.table(flows.table("rule_metrics"))
    assert per_batch.select("batch_id").distinct().count() == 3
    total = summarise_rule_metrics(per_batch).filter("rule = 'pago_valido'").first()
    assert (total.passed, total.failed) == (36, 12)


def test_fail_rule_stops_a_stream_and_stores_nothing(spark, space):
    write_csv(frames(spark)["courses"], space.landing, "courses")
    flows = incremental(spark, space, layout="folders", entities=("courses",))
    flows.run_bronze()
    source = stream_table(spark, flows.table("bronze_courses"))
    rule = Rule("course_id_existe", F.col("course_id").isNotNull(), "fail")
    flow = Flow(space.table("checked"), source, f"{space.checkpoints}/checked", rules=(rule,))
    with pytest.raises(Exception, match="rule failed: course_id_existe"):
        run_flows([flow])
    assert spark.table(space.table("checked")).count() == 0


def test_counts_of_a_flow_are_kept_when_another_fails(spark, space):
    for entity in ("courses", "progress"):
        write_csv(frames(spark)[entity], space.landing, entity)
    flows = incremental(spark, space, layout="folders", entities=("courses", "progress"))
    flows.run_bronze()

    def flow(name, rule):
        source = stream_table(spark, flows.table(f"bronze_{name}"))
        return Flow(space.table(name), source, f"{space.checkpoints}/{name}_checked", rules=(rule,), label=name)

    bad = flow("courses", Rule("key", "course_id IS NOT NULL", "fail"))
    good = flow("progress", Rule("lessons", "try_cast(total_lessons AS DOUBLE) >= 1", "warn"))
    kept = []
    with pytest.raises(Exception, match="rule failed: key"):
        run_flows([bad, good], kept.extend)
    assert spark.table(space.table("progress")).count() == 16
    [(table, batch_id, rule, action, passed, failed)] = kept
    assert (table, batch_id, rule, action, passed + failed) == ("progress", 0, "lessons", "warn", 16)


def test_a_repeated_batch_counts_once(spark, space):
    lines = [("t", 0, "r", "warn", 5, 1), ("t", 1, "r", "warn", 2, 0)]
    store_rule_metrics(spark, lines, space.table("counts"))
    again = store_rule_metrics(spark, [("t", 1, "r", "warn", 1, 1)], space.table("counts"))
    assert [(r.passed, r.failed) for r in summarise_rule_metrics(again).collect()] == [(6, 2)]


def test_tables_carry_comments(spark, space):
    write_csv(frames(spark)["instructors"], space.landing, "instructors")
    flows = incremental(spark, space, layout="folders", entities=("instructors",))
    flows.run_bronze()
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {flows.table('bronze_instructors')}")
    assert rows.filter("col_name = 'Comment'").first().data_type.startswith("Raw instructors")


def test_later_file_with_another_header_stops_the_flow(spark, space, tmp_path):
    landing = str(tmp_path)
    put(landing, "instructors.csv", HEADERS["instructors"] + "\ni1,Ana,PE\n")
    flows = incremental(spark, space, landing, entities=("instructors",))
    flows.run_bronze()
    put(landing, "instructors_2.csv", "name,instructor_id,country\nBeto,i2,PE\n")
    with pytest.raises(Exception, match="(?i)header|CSV"):
        flows.run_bronze()
    assert spark.table(flows.table("bronze_instructors")).count() == 1
