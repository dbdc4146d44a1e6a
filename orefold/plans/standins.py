"""The four entities derived from the test tables (see FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

_STAMP = "yyyy-MM-dd HH:mm:ss.SSSSSS"


# The columns the views use. Named here, they need not be looked up in the files.
_COLUMNS = {
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_quantity DOUBLE,"
    " l_extendedprice DOUBLE, l_shipdate TIMESTAMP_NTZ",
    "part": "p_partkey BIGINT, p_name STRING, p_type STRING, p_size INT",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT",
    "nation": "n_nationkey INT, n_name STRING",
    "events": "event_id BIGINT, user_id BIGINT",
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_COLUMNS[name]).parquet(f"{sf_dir}/{name}.parquet")


def enrollments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NULL and negative amounts, four currencies and NULL."""
    return _table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS enrollment_id",
        "l_partkey AS course_id",
        "CASE l_quantity WHEN 13 THEN NULL WHEN 7 THEN -l_extendedprice"
        " ELSE l_extendedprice END AS payment_amount",
        "CASE l_suppkey % 5 WHEN 0 THEN 'MXN' WHEN 1 THEN 'COP' WHEN 2 THEN 'PEN'"
        " WHEN 3 THEN 'USD' END AS currency",
        "l_shipdate AS enrolled_at",
    )


def courses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Empty and NULL categories."""
    return _table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS course_id",
        "p_name AS title",
        "CASE p_type WHEN 'ECONOMY' THEN '' WHEN 'STANDARD' THEN NULL ELSE p_type END"
        " AS category",
        "CAST(p_size AS BIGINT) AS instructor_id",
    )


def instructors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NULL country for one nation in five."""
    nation = _table(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "s_nationkey")
    return (
        _table(spark, sf_dir, "supplier")
        .join(nation, "s_nationkey", "left")
        .selectExpr(
            "s_suppkey AS instructor_id",
            "s_name AS name",
            "CASE WHEN s_nationkey % 5 <> 0 THEN n_name END AS country",
        )
    )


def progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lesson totals from 0, which is corrupt, to 20."""
    return _table(spark, sf_dir, "events").selectExpr(
        "user_id",
        "event_id % 211 AS course_id",
        "(event_id * 7) % (event_id % 21 + 1) AS lessons_completed",
        "event_id % 21 AS total_lessons",
    )


ENTITY_VIEWS = {
    "enrollments": enrollments,
    "courses": courses,
    "progress": progress,
    "instructors": instructors,
}

_TYPES = {
    "enrollment_id": "bigint",
    "course_id": "bigint",
    "payment_amount": "double",
    "enrolled_at": "timestamp_ntz",
    "instructor_id": "bigint",
    "user_id": "bigint",
    "lessons_completed": "bigint",
    "total_lessons": "bigint",
}


def as_text(df: DataFrame) -> DataFrame:
    """All columns as text, times in one fixed form, ready for CSV."""

    def text(name: str, kind: str) -> Column:
        if kind.startswith("timestamp"):
            return F.date_format(name, _STAMP).alias(name)
        return F.col(name).cast("string").alias(name)

    return df.select(*[text(name, kind) for name, kind in df.dtypes])


def typed(df: DataFrame) -> DataFrame:
    """Text columns back to the types of the views."""
    return df.select(
        *[F.col(c).try_cast(_TYPES[c]).alias(c) if c in _TYPES else F.col(c) for c in df.columns]
    )
