from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from orefold.operators.layout import _placed, cluster_by
from orefold.parallel import side_by_side
from orefold.sources.tables import overwrite_table
from orefold.sources.versions import VersionedTable
from rows import sorted_rows


@pytest.fixture
def table(spark, space):
    return VersionedTable(spark, space.table("t"))


def test_versions_stay_readable(spark, table):
    assert table.write(spark.range(3)) == 0
    assert table.write(spark.range(10, 12)) == 1
    assert sorted_rows(table.read(0)) == [(0,), (1,), (2,)]
    assert sorted_rows(table.read()) == sorted_rows(table.read(1)) == [(10,), (11,)]
    history = table.history().orderBy("version").collect()
    assert [(r.version, r.operation, r.num_rows) for r in history] == [(0, "WRITE", 3), (1, "WRITE", 2)]
    assert all(r.committed_at for r in history)
    with pytest.raises(LookupError):
        table.read(7)


def test_no_version_yet(table):
    with pytest.raises(LookupError):
        table.read()


def test_an_empty_version_is_a_version(spark, table):
    table.write(spark.range(3))
    table.write(spark.range(0))
    assert table.read().count() == 0 and table.read(0).count() == 3


def test_columns_must_match_but_may_be_reordered(spark, table):
    table.write(spark.range(3).withColumn("x", F.lit("a")))
    table.write(spark.range(1).select(F.lit("b").alias("x"), "id"))
    assert tuple(table.read().first()) == (0, "b")
    with pytest.raises(ValueError):
        table.write(spark.range(3).withColumn("y", F.lit("a")))


def test_half_written_version_is_invisible_and_replaced(spark, table):
    table.write(spark.range(3))
    table._store(spark.range(100), 1)  # rows stored, history row never added
    assert table.read().count() == 3
    assert table.write(spark.range(7)) == 1
    assert table.read().count() == 7
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_read_prunes_to_one_version(spark, table):
    table.write(spark.range(3))
    table.write(spark.range(5))
    plan = table.read(0)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_version" in plan


def test_expiry_spares_the_latest(spark, table):
    for n in (1, 2, 3, 4):
        table.write(spark.range(n))
    assert [r.version for r in table.to_expire(keep_last=2).orderBy("version").collect()] == [0, 1]
    later = datetime.now(timezone.utc) + timedelta(days=1)
    earlier = later - timedelta(days=2)
    assert table.to_expire(older_than=earlier).isEmpty()
    assert table.to_expire(older_than=later).count() == 3
    assert table.to_expire(keep_last=3, older_than=later).count() == 1
    assert table.expire(keep_last=2) == [0, 1]
    with pytest.raises(LookupError):
        table.read(0)
    assert table.read(2).count() == 3 and table.read().count() == 4
    assert table.expire(keep_last=2) == []
    assert table.expire(keep_last=0) == [2]
    assert table.read().count() == 4
    assert table.write(spark.range(9)) == 4
    parts = [r[0] for r in spark.sql(f"SHOW PARTITIONS {table.table}").collect()]
    assert sorted(parts) == ["_version=3", "_version=4"]


def test_expiry_needs_a_limit(spark, table):
    table.write(spark.range(1))
    with pytest.raises(ValueError):
        table.to_expire()


# -- layout ------------------------------------------------------------------


@pytest.fixture
def skewed(spark):
    """A third of the rows share one day, and are copies of one row."""
    return spark.range(0, 30_000, 1, 6).selectExpr(
        "CASE WHEN id % 3 = 0 THEN '2024-01-05' ELSE date_format(date_add(DATE'2024-01-01', "
        "CAST(id % 200 AS INT)), 'yyyy-MM-dd') END AS day",
        "CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS id",
    )


def test_cluster_keeps_rows_and_separates_ranges(spark, skewed):
    clustered = cluster_by(skewed, "day", 8)
    assert clustered.columns == skewed.columns
    assert clustered.exceptAll(skewed).isEmpty() and skewed.exceptAll(clustered).isEmpty()
    ranges = (
        clustered.groupBy(F.spark_partition_id().alias("p"))
        .agg(F.min("day").alias("lo"), F.max("day").alias("hi"), F.count("*").alias("n"))
        .orderBy("p")
        .collect()
    )
    assert len(ranges) == 8
    assert all(a.hi <= b.lo for a, b in zip(ranges, ranges[1:]))
    # The hot day alone would put a third into one of eight parts.
    assert max(r.n for r in ranges) < 30_000 / 8 * 1.5


def test_positions_do_not_depend_on_row_order(skewed):
    """A repeated task may see its rows in another order; no row may move then."""
    parts = skewed.repartition(4, "id")
    one = _placed(parts.sortWithinPartitions("day", "id"))
    other = _placed(parts.sortWithinPartitions(F.desc("id"), F.desc("day")))
    assert one.exceptAll(other).isEmpty() and other.exceptAll(one).isEmpty()


def test_cluster_writes_the_latest_rows_again(spark, table, skewed):
    table.write(skewed)
    assert table.cluster("day", 8) == 1
    assert table.read().exceptAll(table.read(0)).isEmpty()
    assert table.history().filter("version = 1").first().operation == "CLUSTER"
    files = (
        table.read()
        .groupBy(F.input_file_name().alias("f"))
        .agg(F.min("day").alias("lo"), F.max("day").alias("hi"))
        .orderBy("lo", "hi")
        .collect()
    )
    assert len(files) == 8 and all(a.hi <= b.lo for a, b in zip(files, files[1:]))


@pytest.mark.parametrize("kind", ["string", "date", "timestamp"])
def test_range_read_skips_clustered_files(spark, table, kind):
    rows = spark.range(0, 100_000, 1, 8).selectExpr(
        f"CAST(date_add(DATE'2020-01-01', CAST(id % 1000 AS INT)) AS {kind}) AS day", "id"
    )
    table.write(rows)
    table.cluster("day", 16)
    days = table.read().filter(
        f"day BETWEEN CAST('2021-01-01' AS {kind}) AND CAST('2021-01-31' AS {kind})"
    )
    plan = days._jdf.queryExecution().executedPlan()
    assert len(plan.executeCollect()) == 3_100
    scanned = plan.collectLeaves().head().metrics().apply("numOutputRows").value()
    assert scanned <= 100_000 / 16 * 3


def test_cluster_accepts_map_columns(spark):
    df = spark.range(10).withColumn("m", F.create_map(F.lit("a"), "id"))
    assert cluster_by(df, "id", 2).count() == 10


def test_a_stopped_expiry_is_finished_by_the_next(spark, table, monkeypatch):
    for n in (1, 2, 3):
        table.write(spark.range(n))
    sql = spark.sql
    # The stop falls between the mark and the removal of the files.
    monkeypatch.setattr(type(spark), "sql", lambda self, text, *a, **k: (_ for _ in ()).throw(KeyboardInterrupt) if "DROP IF EXISTS" in text else sql(text, *a, **k))
    with pytest.raises(KeyboardInterrupt):
        table.expire(keep_last=1)
    monkeypatch.undo()
    assert spark.sql(f"SHOW PARTITIONS {table.table}").count() == 3
    assert table.expire(keep_last=1) == []
    assert spark.sql(f"SHOW PARTITIONS {table.table}").count() == 1 and table.read().count() == 3


def test_a_failed_overwrite_keeps_the_former_rows(spark, space):
    name = space.table("kept")
    overwrite_table(spark.range(5), name)
    with pytest.raises(Exception):
        overwrite_table(spark.range(3).select(F.raise_error(F.lit("stop")).cast("long").alias("id")), name)
    assert spark.table(name).count() == 5
    assert sorted_rows(overwrite_table(spark.table(name).where("id > 2"), name, "some")) == [(3,), (4,)]


def test_versions_leave_the_session_as_it_is(spark, table):
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    table.write(spark.range(3))
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before
    assert table.read().count() == 3


def test_threads_keep_the_job_group(spark):
    spark.sparkContext.setJobGroup("theirs", "their jobs")
    seen = side_by_side({str(i): lambda: spark.sparkContext.getLocalProperty("spark.jobGroup.id") for i in range(3)})
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert set(seen.values()) == {"theirs"}
