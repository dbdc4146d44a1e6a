"""Silver operators: each adds or repairs a column, or drops corrupt rows.

All are narrow (no shuffle) and work on batch and streaming DataFrames alike.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from ..functions.fixed import UNCATEGORISED, UNKNOWN_COUNTRY, USD_RATES
from ..functions.money import to_usd
from ..functions.numbers import at_least_one, number, percent, percent_unrounded, quoted


def fill_country(
    df: DataFrame, column: str = "country", default: str = UNKNOWN_COUNTRY
) -> DataFrame:
    """NULL becomes ``default``; an empty string stays."""
    return df.fillna({column: default})


def standardise_category(
    df: DataFrame, column: str = "category", default: str = UNCATEGORISED
) -> DataFrame:
    """NULL and the empty string become ``default``; nothing else is touched."""
    given = F.expr(f"nullif({quoted(column)}, '')")
    return df.withColumn(column, F.coalesce(given, F.lit(default)))


def valid_progress(df: DataFrame, total: str = "total_lessons") -> DataFrame:
    """Keep rows whose lesson total is a number of at least one."""
    return df.filter(at_least_one(df, total))


def with_payment(df: DataFrame, amount: str = "payment_amount") -> DataFrame:
    """Keep rows that hold a payment at all."""
    return df.filter(F.col(amount).isNotNull())


def with_usd(
    df: DataFrame,
    amount: str = "payment_amount",
    currency: str = "currency",
    target: str = "payment_usd",
    rates: Mapping[str, float] = USD_RATES,
) -> DataFrame:
    return df.withColumn(target, F.expr(to_usd(number(df, amount), quoted(currency), rates)))


def as_double(df: DataFrame, *columns: str) -> DataFrame:
    """Replace the columns by their double value, NULL where unreadable."""
    return df.withColumns({c: F.expr(f"CAST({number(df, c)} AS DOUBLE)") for c in columns})


def with_completion(
    df: DataFrame,
    done: str = "lessons_completed",
    total: str = "total_lessons",
    target: str = "completion_pct",
    rounded: bool = True,
) -> DataFrame:
    """Add the completion percentage of each row; it may exceed 100."""
    compute = percent if rounded else percent_unrounded
    typed = as_double(df, done, total)
    return typed.withColumn(target, F.expr(compute(quoted(done), quoted(total))))
