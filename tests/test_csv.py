import os

import pytest

from orefold.parallel import side_by_side
from orefold.sources.csv_files import read_csv, stream_csv, write_csv
from orefold.sources.schemas import text_schema
from orefold.sources.tables import overwrite_table
from rows import frames, sorted_rows


def put(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w", encoding="utf-8") as f:
        f.write(text)


def test_entities_share_a_folder(spark, tmp_path):
    landing = str(tmp_path)
    put(landing, "courses.csv", "course_id,title,category,instructor_id\nc1,Spark,,i1\n")
    put(landing, "instructors.csv", "instructor_id,name,country\ni1,Ana,PE\n")
    put(landing, "courses_2.csv", "course_id,title,category,instructor_id\nc2,SQL,\"\",i1\n")
    courses = read_csv(spark, landing, "courses")
    assert courses.dtypes == [
        ("course_id", "string"), ("title", "string"), ("category", "string"), ("instructor_id", "string"),
    ]
    # Empty fields, quoted or not, are NULL.
    assert sorted_rows(courses) == [("c1", "Spark", None, "i1"), ("c2", "SQL", None, "i1")]
    assert read_csv(spark, landing, "instructors").count() == 1


def test_unnamed_columns_pass_through(spark, tmp_path):
    put(str(tmp_path), "instructors.csv", "name,instructor_id,country,rating\nAna,i1,PE,5\n")
    df = read_csv(spark, str(tmp_path), "instructors")
    assert df.columns == ["name", "instructor_id", "country", "rating"]
    assert df.first().instructor_id == "i1"


@pytest.mark.parametrize(
    "header", ["name,instructor_id,country", "instructor_id,name", "instructor_id,name,country,x"]
)
def test_another_header_stops_a_read_with_a_schema(spark, tmp_path, header):
    values = ",".join("v" for _ in header.split(","))
    put(str(tmp_path), "instructors.csv", f"{header}\n{values}\n")
    with pytest.raises(Exception, match="(?i)header|CSV"):
        read_csv(spark, str(tmp_path), "instructors", text_schema("instructors")).collect()


def test_round_trip_through_folders(spark, space):
    for entity, df in frames(spark).items():
        write_csv(df, space.landing, entity)
        back = read_csv(spark, space.landing, entity)
        assert back.columns == df.columns and back.count() == df.count()


def test_overwrite_replaces_and_comments(spark, space):
    table = space.table("t")
    overwrite_table(spark.range(5), table)
    stored = overwrite_table(spark.range(3), table, "it's new")
    assert stored.count() == 3
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Comment'")
    assert described.first().data_type == "it's new"


def test_stream_layout_is_checked(spark, tmp_path):
    with pytest.raises(ValueError):
        stream_csv(spark, str(tmp_path), "courses", text_schema("courses"), layout="other")


def test_side_by_side_returns_all_or_raises():
    assert side_by_side({"a": lambda: 1, "b": lambda: 2}) == {"a": 1, "b": 2}
    with pytest.raises(ZeroDivisionError):
        side_by_side({"a": lambda: 1, "b": lambda: 1 // 0})
