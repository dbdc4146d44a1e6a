from types import SimpleNamespace

import pytest

from orefold.__main__ import main
from orefold.plans import batch
from orefold.sources import workspace
from orefold.sources.csv_files import write_csv
from orefold.sources.versions import publish, versions_of
from rows import frames, sorted_rows


@pytest.fixture
def landing(spark, space):
    for entity, df in frames(spark).items():
        write_csv(df, space.landing, entity)
    return space.landing


def test_twelve_tables_and_their_counts(spark, space, landing):
    layers = batch.run(spark, landing, space.schema)
    stored = {t.name for t in spark.catalog.listTables(space.schema)}
    tables = {t for t in stored if not t.endswith(("_versions", "_history"))}
    assert len(tables) == 12
    counts = {r.table_name: r.row_count for r in layers.row_counts().collect()}
    assert set(counts) == tables
    assert counts["bronze_progress"] == 16 and counts["silver_progress"] == 10
    # Without rules the batch run keeps every enrollment, negative ones too.
    assert counts["silver_enrollments"] == counts["bronze_enrollments"] == 16
    rejected = {r.entity: (r.rows_in, r.rows_kept, r.rows_rejected) for r in layers.rejections().collect()}
    assert rejected["progress"] == (16, 10, 6)
    assert rejected["total"] == (16 + 9 + 16 + 4, 16 + 9 + 10 + 4, 6)


def test_options(spark, space, landing):
    layers = batch.run(spark, landing, space.schema, check_rules=True, cluster_enrollments="enrolled_at")
    assert layers.silver["enrollments"].count() == 12
    report = {r.rule: (r.passed, r.failed) for r in batch.rule_report(layers.bronze).collect()}
    assert report["pago_valido"] == (12, 4) and report["total_lessons_valido"] == (10, 6)
    stored = {r.rule: (r.passed, r.failed) for r in spark.table(space.table("rule_metrics")).collect()}
    assert stored == report == {r.rule: (r.passed, r.failed) for r in layers.rules.collect()}


def test_a_second_run_replaces_the_first(spark, space, landing):
    first = batch.run(spark, landing, space.schema).row_counts().collect()
    assert batch.run(spark, landing, space.schema).row_counts().collect() == first


def test_former_runs_can_be_read(spark, space, landing):
    name = space.table("silver_enrollments")
    batch.run(spark, landing, space.schema)
    before = sorted_rows(spark.table(name))
    batch.run(spark, landing, space.schema, check_rules=True)
    versions = versions_of(spark, name)
    assert [r.num_rows for r in versions.history().orderBy("version").collect()] == [16, 12]
    assert repr(sorted_rows(versions.read(0))) == repr(before) and len(before) == 16
    assert repr(sorted_rows(versions.read())) == repr(sorted_rows(spark.table(name)))


def test_a_failed_run_leaves_the_former_rows(spark, space):
    name = space.table("t")
    publish(spark.range(5).select("id"), name)
    broken = spark.range(3).selectExpr("CAST(raise_error('no') AS BIGINT) + id AS id")
    with pytest.raises(Exception, match="no"):
        publish(broken, name)
    assert spark.table(name).count() == 5
    publish(spark.range(7).select("id"), name, "it's a note")
    versions = versions_of(spark, name)
    assert spark.table(name).count() == 7 and versions.read(0).count() == 5
    versions.cluster("id")
    versions.expire(keep_last=1)
    assert spark.table(name).count() == 7


def test_row_counts_read_no_columns(spark, space, landing):
    layers = batch.run(spark, landing, space.schema)
    plan = layers.row_counts()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ReadSchema: struct<>") == 12


def test_shared_folder_without_the_setting():
    def session(master):
        context = SimpleNamespace(master=master, applicationId="app-1")
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default="warehouse": default), sparkContext=context)

    local = workspace.shared_folder(session("local[2]"))
    assert local == workspace.shared_folder(session("local[2]")) == "warehouse/orefold_scratch"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        workspace.shared_folder(session("yarn"))


def test_workspace_lies_in_the_shared_folder(spark, space):
    assert space.folder.startswith(workspace.shared_folder(spark))


def test_command_line(spark, space, landing, capsys):
    main(["batch", "--landing", landing, "--schema", space.schema])
    assert "gold_top_categorias" in capsys.readouterr().out
    main(
        ["incremental", "--landing", landing, "--schema", space.schema, "--layout", "folders",
         "--checkpoints", space.checkpoints]
    )
    assert "pago_valido" in capsys.readouterr().out
    with pytest.raises(SystemExit):
        main(["incremental", "--landing", landing, "--schema", space.schema])
