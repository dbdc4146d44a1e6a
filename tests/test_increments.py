"""Streamed tables: versions, counts that survive a stop, sums kept between runs, new columns."""

import os
import shutil

import pytest

from orefold.operators import clean, metrics
from orefold.plans import batch
from orefold.plans.incremental import Incremental
from orefold.sources import appended
from orefold.sources.columns import schema_versions
from orefold.sources.csv_files import read_csv
from orefold.sources.versions import VERSION, Retention, versions_of
from orefold.streaming.flows import summarise_rule_metrics
from rows import sorted_rows
from test_streaming import HEADERS, put


@pytest.fixture
def landing(tmp_path):
    folder = str(tmp_path / "landing")
    put(folder, "enrollments.csv", HEADERS["enrollments"] + "\ne1,c1,100,MXN,2024-01-01\ne2,c1,-5,USD,2024-01-02\ne3,c2,0.105,USD,\n")
    put(folder, "courses.csv", HEADERS["courses"] + "\nc1,Spark,,i1\nc2,SQL,Data,i2\n")
    put(folder, "progress.csv", HEADERS["progress"] + "\nu1,c1,1,3\nu2,c1,1,0\nu3,c2,2,7\n")
    put(folder, "instructors.csv", HEADERS["instructors"] + "\ni1,Ana,\ni2,Eva,PE\n")
    return folder


def second_drop(folder):
    put(folder, "enrollments_2.csv", HEADERS["enrollments"] + "\ne4,c1,10,PEN,2024-01-03\ne5,c7,,USD,2024-01-04\ne6,c2,0.1,USD,2024-01-05\n")
    put(folder, "progress_2.csv", HEADERS["progress"] + "\nu4,c1,2,3\nu5,c3,1,7\n")


def flows_of(spark, space, landing, **options):
    return Incremental(spark, landing, space.schema, space.checkpoints, **options)


def files_below(spark, table):
    location = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'").first().data_type
    return location.removeprefix("file:")


def test_refresh_reads_only_new_batches(spark, space, landing):
    flows = flows_of(spark, space, landing)
    flows.run()
    second_drop(landing)
    flows.run_bronze()
    flows.run_silver()
    silver = {e: spark.createDataFrame(spark.table(flows.table(f"silver_{e}")).collect(), spark.table(flows.table(f"silver_{e}")).schema) for e in ("enrollments", "courses", "progress", "instructors")}
    completion = metrics.completion_rate_single_round(silver["progress"], silver["courses"])
    expected = {
        "gold_completion_rate": sorted_rows(completion),
        "gold_revenue_instructor": sorted_rows(metrics.revenue_by_instructor(silver["enrollments"], silver["courses"], silver["instructors"])),
        "gold_top_categorias": sorted_rows(metrics.revenue_by_category(silver["enrollments"], silver["courses"])),
        "gold_cursos_abandonados": sorted_rows(metrics.low_engagement(completion, silver["enrollments"], rate="completion_pct", target="total_inscritos")),
    }
    for sums in (flows.money_sums(), flows.completion_sums()):
        assert sums.stored.latest() == 0 and sums.source.latest() == 1
        assert all("_version=1/" in f for f in sums.missing().inputFiles())
    # What the first run has summed up is not there any more.
    for entity in ("enrollments", "progress"):
        shutil.rmtree(f"{files_below(spark, flows.versions(f'silver_{entity}').table)}/_version=0")
    gold = flows.refresh_gold()
    assert {name: sorted_rows(df) for name, df in gold.items()} == expected
    again = flows.refresh_gold()  # nothing new: the sums as they are
    assert {name: sorted_rows(df) for name, df in again.items()} == expected


def test_refresh_without_any_row(spark, space, landing):
    put(landing, "enrollments.csv", HEADERS["enrollments"] + "\n")
    gold = flows_of(spark, space, landing).run()
    assert gold["gold_revenue_instructor"].count() == 0
    assert gold["gold_completion_rate"].count() == 2


def test_versions_of_a_streamed_table(spark, space, landing):
    flows = flows_of(spark, space, landing)
    flows.run_bronze()
    flows.run_silver()
    first = sorted_rows(spark.table(flows.table("silver_enrollments")))
    second_drop(landing)
    flows.run_bronze()
    flows.run_silver()
    silver = flows.versions("silver_enrollments")
    assert sorted_rows(silver.read(0)) == first and silver.read().count() == 4
    assert sorted_rows(silver.read(1, after=0)) == sorted_rows(silver.read().subtract(silver.read(0)))
    lines = silver.history().orderBy("version").collect()
    assert [(r.version, r.batch_id, r.operation, r.num_rows) for r in lines] == [(0, 0, "APPEND", 2), (1, 1, "APPEND", 2)]
    with pytest.raises(LookupError):
        silver.read(2)
    # Files are listed from the table; the sink keeps no log of its own.
    assert "_spark_metadata" not in os.listdir(files_below(spark, silver.table))


@pytest.mark.parametrize("where", ["before", "after"])
def test_a_stop_around_the_commit_of_a_batch(monkeypatch, spark, space, landing, where):
    """The driver stops when rows are stored, before or after the history row, and before Spark's own commit."""
    flows = flows_of(spark, space, landing, entities=("enrollments",), rules_first=True)
    flows.run_bronze()
    if where == "before":
        real = appended.store_partition

        def stop(*args, **kwargs):
            real(*args, **kwargs)
            raise RuntimeError("stopped here")

        monkeypatch.setattr(appended, "store_partition", stop)
    else:
        real = appended.AppendedTable.append

        def stop(*args, **kwargs):
            real(*args, **kwargs)
            raise RuntimeError("stopped here")

        monkeypatch.setattr(appended.AppendedTable, "append", stop)
    with pytest.raises(Exception, match="stopped here"):
        flows.run_silver()
    assert spark.table(flows.table("silver_enrollments")).count() == (0 if where == "before" else 2)
    monkeypatch.undo()
    flows.run_silver()
    assert spark.table(flows.table("silver_enrollments")).count() == 2
    counts = summarise_rule_metrics(spark.table(flows.table("rule_metrics"))).filter("rule = 'pago_valido'").first()
    assert (counts.passed, counts.failed) == (2, 1)
    assert flows.versions("silver_enrollments").history().count() == 1


def test_a_new_checkpoint_is_another_run(spark, space, landing):
    """Batches are numbered by checkpoint: those of a new one are not taken for old ones."""
    flows = flows_of(spark, space, landing, entities=("courses",))
    flows.run_bronze()
    shutil.rmtree(f"{space.checkpoints}/bronze_courses_stream")
    flows.run_bronze()
    assert spark.table(flows.table("bronze_courses")).count() == 4
    assert flows.versions("bronze_courses").latest() == 1


WIDER = "country,email,instructor_id,name\nMX,b@x,i3,Beto\n"


def test_batch_with_a_new_column(spark, space, landing):
    batch.run(spark, landing, space.schema)
    put(landing, "instructors_2.csv", WIDER)
    with pytest.raises(Exception, match="(?i)header|CSV|columns"):
        batch.run(spark, landing, space.schema)
    layers = batch.run(spark, landing, space.schema, widen=True)
    rows = {r.instructor_id: (r.name, r.country, r.email) for r in layers.silver["instructors"].collect()}
    assert rows == {"i1": ("Ana", "Desconocido", None), "i2": ("Eva", "PE", None), "i3": ("Beto", "MX", "b@x")}
    versions = versions_of(spark, space.table("silver_instructors"))
    assert versions.read(0).filter("email IS NOT NULL").count() == 0 and versions.read(0).count() == 2
    known = schema_versions(spark, versions.table, VERSION).orderBy("schema_version").collect()
    assert [(r.schema_version, r.added[-1:]) for r in known] == [(0, ["country"]), (1, ["email"])]
    assert layers.gold["gold_revenue_instructor"].count() == 2
    # Back to files without the column.
    os.remove(f"{landing}/instructors_2.csv")
    with pytest.raises(ValueError, match="widen=True"):
        batch.run(spark, landing, space.schema)
    assert batch.run(spark, landing, space.schema, widen=True).silver["instructors"].filter("email IS NULL").count() == 2


def test_stream_with_a_new_column(spark, space, landing):
    flows = flows_of(spark, space, landing, widen=True)
    flows.run()
    put(landing, "instructors_2.csv", WIDER)
    put(landing, "instructors_3.csv", "")
    flows.run()
    rows = {r.instructor_id: (r.name, r.country, r.email) for r in spark.table(flows.table("silver_instructors")).collect()}
    assert rows == {"i1": ("Ana", "Desconocido", None), "i2": ("Eva", "PE", None), "i3": ("Beto", "MX", "b@x")}
    assert flows.versions("silver_instructors").read(0).count() == 2
    put(landing, "instructors_4.csv", "instructor_id,name\ni4,Iris\n")
    with pytest.raises(Exception, match="lacks"):
        flows.run_bronze()


def test_stream_without_widening_stops(spark, space, landing):
    flows = flows_of(spark, space, landing, entities=("instructors",))
    flows.run_bronze()
    put(landing, "instructors_2.csv", WIDER)
    with pytest.raises(Exception, match="(?i)header|CSV"):
        flows.run_bronze()


def test_headers_are_bound_by_name(spark, landing):
    put(landing, "courses_2.csv", "instructor_id,title,course_id,level,category\ni1,\"Joins, in depth\",c3,2,Data\n")
    found = read_csv(spark, landing, "courses", widen=True)
    row = found.filter("course_id = 'c3'").first()
    assert (row.title, row.instructor_id, row.category, row.level) == ("Joins, in depth", "i1", "Data", "2")
    assert clean.standardise_category(found).filter("level IS NULL").count() == 2
    put(landing, "courses_3.csv", "course_id,title,category,instructor_id,title\nc4,a,b,i1,c\n")
    with pytest.raises(ValueError, match="twice"):
        read_csv(spark, landing, "courses", widen=True)


def test_runs_remove_old_versions(spark, space, landing):
    for _ in range(3):
        layers = batch.run(spark, landing, space.schema, retention=Retention(keep_last=2))
    assert layers.gold["gold_revenue_instructor"].count() == 2
    for name in ("bronze_courses", "silver_enrollments", "gold_completion_rate"):
        versions = versions_of(spark, space.table(name))
        assert sorted(r.version for r in versions.live().collect()) == [1, 2]
        stored = spark.sql(f"SHOW PARTITIONS {versions.table}").collect()
        assert sorted(r.partition for r in stored) == ["_version=1", "_version=2"]


def test_refreshes_remove_old_versions(spark, space, landing):
    flows = flows_of(spark, space, landing, retention=Retention(keep_last=1))
    for _ in range(2):
        gold = flows.run()
    assert gold["gold_top_categorias"].count() == 2
    assert [r.version for r in versions_of(spark, flows.table("gold_top_categorias")).live().collect()] == [1]
