"""Layout over several columns and by bytes, and keys that hold a third of the facts."""

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from orefold.operators import layout
from orefold.operators.joins import TIMES, frequent, join_dimension, join_facts
from orefold.operators.layout import borders_of, cluster_by, rank, samples, z_value
from orefold.sources.versions import VersionedTable
from rows import sorted_rows


@pytest.fixture
def enrollments(spark):
    return spark.range(0, 200_000, 1, 8).selectExpr(
        "date_format(date_add(DATE'2020-01-01', CAST(pmod(xxhash64(id), 1000) AS INT)), 'yyyy-MM-dd') AS enrolled_at",
        "concat('c', lpad(CAST(pmod(xxhash64(id, 1), 5000) AS STRING), 6, '0')) AS course_id",
        "IF(id % 50 = 0, NULL, pmod(xxhash64(id, 2), 1000)) AS amount",
        "id",
    )


def scanned(df):
    plan = df._jdf.queryExecution().executedPlan()
    rows = len(plan.executeCollect())
    return rows, plan.collectLeaves().head().metrics().apply("numOutputRows").value()


@pytest.mark.parametrize(
    "where",
    ["enrolled_at BETWEEN '2021-01-01' AND '2021-01-20'", "course_id BETWEEN 'c001000' AND 'c001100'", "amount BETWEEN 300 AND 310"],
)
def test_range_reads_on_any_column_skip_files(spark, space, enrollments, where):
    table = VersionedTable(spark, space.table("laid_out"))
    table.write(enrollments)
    table.cluster(["enrolled_at", "course_id", "amount"], 64)
    expected = enrollments.filter(where).count()
    rows, read = scanned(table.read().filter(where))
    assert rows == expected
    # Three columns and 64 files: about four ranges of each, and a range read meets one or two of them.
    assert read <= 200_000 * 0.55
    assert sorted_rows(table.read().agg(F.count("*"), F.sum("id"))) == [(200_000, 200_000 * 199_999 // 2)]


def test_ranks_and_curve(spark):
    df = spark.createDataFrame([(v,) for v in [None, "a", "b", "b", "c", "z", "zz"]], "v string")
    [values] = samples(df, ["v"])
    borders = borders_of(values, 2)
    assert values == ["a", "b", "b", "c", "z", "zz"] and borders == ["a", "b", "z"]
    ranks = [r[0] for r in df.select(rank(F.col("v"), borders, df.schema["v"].dataType)).collect()]
    assert ranks == [0, 1, 2, 2, 2, 3, 3]
    grid = spark.range(16).selectExpr("id div 4 AS x", "id % 4 AS y")
    curve = [tuple(r) for r in grid.orderBy(z_value([F.col("y"), F.col("x")], 2)).collect()]
    assert curve[:4] == [(0, 0), (0, 1), (1, 0), (1, 1)] and curve[-1] == (3, 3)
    assert rank(F.col("v"), borders_of([]), df.schema["v"].dataType) is not None


def test_number_of_files_follows_bytes(monkeypatch, spark, space, enrollments):
    def files(rows, name):
        table = VersionedTable(spark, space.table(name))
        table.write(rows)
        table.cluster("enrolled_at")
        stored = table._stored_bytes(0)
        return stored, table.read().select(F.input_file_name()).distinct().count()

    monkeypatch.setattr("orefold.sources.versions.FILE_BYTES", 200_000)
    for share, name in ((0.1, "few"), (1.0, "many")):
        stored, count = files(enrollments.filter(F.col("id") < 200_000 * share), name)
        assert count == -(-stored // 200_000)


def test_rows_are_sorted_once(enrollments):
    plan = cluster_by(enrollments, "enrolled_at", 4)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Sort [") == 1


def test_copies_of_one_row_in_many_tasks_are_split(spark):
    copies = spark.range(0, 40_000, 1, 8).selectExpr("'2024-01-01' AS day", "1 AS x")
    sizes = cluster_by(copies, "day", 8).groupBy(F.spark_partition_id()).count()
    assert sizes.agg(F.max("count")).first()[0] <= 40_000 / 8 * 2


@pytest.fixture
def static_plans(spark):
    before = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def test_a_course_with_a_third_of_the_facts_is_spread(spark, static_plans):
    """Without adaptive execution and broadcasts: no task holds twice the median."""
    facts = spark.range(0, 90_000, 1, 8).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 30 = 1 THEN NULL ELSE 100 + id % 4000 END AS course", "id", "1.0D AS amount"
    )
    courses = spark.range(5_000).selectExpr("id AS course", "concat('cat', id % 9) AS category")
    courses = courses.unionByName(courses.filter("course IN (7, 200)"))  # duplicates multiply
    assert frequent(facts, "course", 8).first()[0] == [7]
    joined = join_facts(facts, courses, "course", ["category"], 8)
    sizes = sorted(r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect())
    assert len(sizes) == 8 and sizes[-1] < 2 * sizes[len(sizes) // 2]
    plain = join_facts(facts, courses, "course", ["category"], 1)
    weighted = lambda df: sorted_rows(df.groupBy("category").agg(F.expr(f"sum({TIMES})"), F.count("*")))
    assert weighted(joined) == weighted(plain)
    hot = sorted(r["count"] for r in plain.groupBy(F.spark_partition_id()).count().collect())
    assert hot[-1] > 2 * hot[len(hot) // 2]


def test_one_join_where_no_salts_are_asked_for(spark):
    facts = spark.range(100).selectExpr("id AS course", "1 AS rows")
    dimension = spark.range(100).selectExpr("id AS course", "'a' AS title")
    plan = join_dimension(facts, dimension, "course", ["title"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftOuter") == 1


def test_a_missing_library_leaves_the_other_queries():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (
        "import sys; sys.modules['public_tokenizers'] = None; sys.modules['tokenizers'] = None;"
        "import __spark_entry__ as e; q = e.queries(); assert set(q) == set(e.oracle_sql()), set(q) ^ set(e.oracle_sql());"
        "print(len(q))"
    )
    out = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    assert int(out.stdout.split()[-1]) >= 60 and layout.BITS == 8
