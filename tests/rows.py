"""Small hand-made inputs with the awkward cases of every entity, all text as in CSV."""

ENROLLMENTS = [
    # enrollment_id, course_id, payment_amount, currency, enrolled_at
    ("e1", "c1", "100", "MXN", "2024-01-05"),
    ("e2", "c1", "1000000", "COP", "2024-01-20"),
    ("e3", "c2", "10", "PEN", "2024-02-01"),
    ("e4", "c2", "50.5", "USD", "2024-02-02"),
    ("e5", "c3", "7", "EUR", "2024-02-03"),
    ("e6", "c3", "1.005", None, "2024-03-01"),
    ("e7", "c9", "20", "USD", "2024-03-02"),
    ("e8", None, "30", "USD", "2024-03-03"),
    ("e9", "c1", None, "USD", "2024-03-04"),
    ("e10", "c1", "-40", "USD", "2024-03-05"),
    ("e11", "c1", "0", "USD", "2024-03-06"),
    ("e12", "c2", "abc", "USD", "2024-03-07"),
    (None, "c2", "5", "USD", "2024-03-08"),
    ("e14", "c4", "9", "USD", None),
    ("e15", "c5", " 3 ", "USD", "2024-04-01"),
    ("e16", "c5", "NaN", "USD", "2024-04-02"),
]
COURSES = [
    # course_id, title, category, instructor_id
    ("c1", "Spark", "data", "i1"),
    ("c2", "Kafka", "", "i2"),
    ("c3", "SQL", None, "i1"),
    ("c4", "Ghost", "data", "i9"),
    ("c5", "Twice", "art", "i2"),
    ("c5", "Twice", "art", "i2"),
    ("c5", "Other", "art", "i3"),
    (None, "No key", "art", "i3"),
    ("c6", "Empty", "art", None),
]
PROGRESS = [
    # user_id, course_id, lessons_completed, total_lessons
    ("u1", "c1", "5", "10"),
    ("u2", "c1", "1", "3"),
    ("u3", "c1", "12", "10"),
    ("u4", "c1", "5", "0"),
    ("u5", "c2", "5", "-1"),
    ("u6", "c2", "5", None),
    ("u7", "c2", "5", "abc"),
    ("u8", "c2", "1", "0.5"),
    ("u9", "c2", "1", "1.5"),
    ("u10", "c2", None, "4"),
    (None, "c2", "2", "4"),
    ("u12", "c9", "1", "8"),
    ("u13", None, "1", "4"),
    ("u14", "c5", "3", "4"),
    ("u15", "c5", "4", "4"),
    ("u16", "c3", "1", "NaN"),
]
INSTRUCTORS = [
    # instructor_id, name, country
    ("i1", "Ana", "PE"),
    ("i2", "Beto", None),
    ("i3", "Caro", ""),
    ("i4", "Idle", "MX"),
]


def frames(spark):
    from orefold.sources.schemas import text_schema

    rows = {
        "enrollments": ENROLLMENTS,
        "courses": COURSES,
        "progress": PROGRESS,
        "instructors": INSTRUCTORS,
    }
    return {e: spark.createDataFrame(r, text_schema(e)) for e, r in rows.items()}


def sorted_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
