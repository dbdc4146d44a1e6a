"""Numbers out of raw text, and roundings that do not depend on float noise.

Raw columns are text, and ANSI casts stop a job at the first unreadable value.
Every number is therefore read with ``try_cast``: unreadable text becomes NULL.
Columns that already are numeric are used as they are, so a filter on them still
reaches the Parquet reader.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, types as T


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def number(df: DataFrame, name: str) -> str:
    """Column ``name`` as a number; text becomes double or NULL."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return f"try_cast({quoted(name)} AS DOUBLE)"
    return quoted(name)


def _at_least(df: DataFrame, name: str, bound: int) -> str:
    value = number(df, name)
    predicate = f"{value} >= {bound}"
    # NaN compares above every number in Spark, so it must be excluded by name.
    if isinstance(df.schema[name].dataType, (T.StringType, T.FloatType, T.DoubleType)):
        predicate = f"({predicate} AND NOT isnan({value}))"
    return predicate


def at_least_one(df: DataFrame, name: str) -> str:
    """True where the number, cut to a whole one, is above zero."""
    return _at_least(df, name, 1)


def not_negative(df: DataFrame, name: str) -> str:
    return _at_least(df, name, 0)


def percent(done: str, total: str) -> str:
    """``done / total * 100`` of two doubles, rounded half up to two places.

    Whole counts go through long arithmetic, which is exact on ties. Fractions are
    divided as the doubles they are and rounded once.
    """
    return f"""CASE
      WHEN {done} BETWEEN 0 AND 1e12 AND {total} BETWEEN 1 AND 1e12
           AND rint({done}) = {done} AND rint({total}) = {total}
      THEN ((CAST({done} AS BIGINT) * 20000 + CAST({total} AS BIGINT))
            DIV (CAST({total} AS BIGINT) * 2)) / 100D
      ELSE round(try_divide({done}, {total}) * 100, 2)
      END"""


def percent_unrounded(done: str, total: str) -> str:
    return f"try_divide({done}, {total}) * 100"


def round_cents(value: str) -> str:
    """``round(value, 2)`` of a double, with the same result at a fraction of its cost.

    ``round`` goes through the decimal text of every value, which decides ties such
    as 1.005. Only values close to a tie, or too large for whole hundredths, need it.
    Adding zero turns -0.0 into 0.0, as ``round`` does.
    """
    hundredths = f"({value}) * 100D"
    return f"""CASE
      WHEN abs({value}) < 1e9 AND abs({hundredths} - floor({hundredths}) - 0.5D) > 1e-4
      THEN rint({hundredths}) / 100D + 0D
      ELSE round({value}, 2)
      END"""
