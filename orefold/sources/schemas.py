"""Text schemas of the four landing entities."""

from __future__ import annotations

from pyspark.sql import types as T

# The columns each entity must hold; files may hold more.
COLUMNS = {
    "enrollments": ["enrollment_id", "course_id", "payment_amount", "currency", "enrolled_at"],
    "courses": ["course_id", "title", "category", "instructor_id"],
    "progress": ["user_id", "course_id", "lessons_completed", "total_lessons"],
    "instructors": ["instructor_id", "name", "country"],
}


def text_schema(entity: str) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in COLUMNS[entity]])


def check_columns(entity: str, header: tuple[str, ...], drop: str) -> None:
    """Stop at a drop that lacks a column its entity must hold, or names one twice."""
    missing = [c for c in COLUMNS.get(entity, []) if c not in header]
    if missing:
        raise ValueError(f"{drop}: the header lacks {missing}")
    if len(set(header)) < len(header):
        raise ValueError(f"{drop}: the header names a column twice")
