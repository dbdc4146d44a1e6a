"""Named data-quality rules: warn, drop or stop, with counts per rule.

All rules of a table see the same input row, so their counts do not depend on the
order in which they are listed. A rule whose result is NULL has failed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Literal

from pyspark.sql import Column, DataFrame, Observation, functions as F

from ..functions.fixed import RULE_COURSE_KEY, RULE_ENROLLMENT_COURSE, RULE_LESSONS, RULE_PAYMENT
from ..functions.numbers import at_least_one, not_negative, quoted

Action = Literal["warn", "drop", "fail"]
_PASSED = "passed_"
_TOTAL = "total"
REPORT_COLUMNS = ["table_name", "rule", "action", "passed", "failed"]


@dataclass(frozen=True)
class Rule:
    """``predicate`` is a Column or SQL text; use ``try_cast`` in text, as ANSI casts raise."""

    name: str
    predicate: Column | str
    action: Action = "warn"

    @property
    def column(self) -> Column:
        return F.expr(self.predicate) if isinstance(self.predicate, str) else self.predicate

    @property
    def passes(self) -> Column:
        return F.coalesce(self.column, F.lit(False))


def enrollment_rules(
    df: DataFrame, amount: str = "payment_amount", course: str = "course_id"
) -> list[Rule]:
    return [
        Rule(RULE_PAYMENT, not_negative(df, amount), "drop"),
        Rule(RULE_ENROLLMENT_COURSE, f"{quoted(course)} IS NOT NULL", "warn"),
    ]


def course_rules(df: DataFrame, course: str = "course_id") -> list[Rule]:
    return [Rule(RULE_COURSE_KEY, f"{quoted(course)} IS NOT NULL", "warn")]


def progress_rules(df: DataFrame, total: str = "total_lessons") -> list[Rule]:
    return [Rule(RULE_LESSONS, at_least_one(df, total), "drop")]


def keep_condition(rules: Sequence[Rule]) -> Column | None:
    """The row filter for the drop and fail rules, or None when there are none."""
    drops = [r.column for r in rules if r.action == "drop"]
    fails = [r for r in rules if r.action == "fail"]
    keep = None
    for predicate in drops:
        keep = predicate if keep is None else keep & predicate
    if not fails:
        return keep
    # One CASE for all: Spark could push a separate drop filter below the stop
    # check, and a row that is dropped first would never be checked.
    stop = None
    for rule in fails:
        error = F.raise_error(F.lit(f"rule failed: {rule.name}")).cast("boolean")
        stop = (F.when if stop is None else stop.when)(~rule.passes, error)
    return stop.otherwise(F.lit(True) if keep is None else F.coalesce(keep, F.lit(False)))


def rule_counts(rules: Sequence[Rule]) -> list[Column]:
    """One pass-count per rule, and the row count, as aggregates."""
    counts = [F.count_if(r.passes).alias(_PASSED + r.name) for r in rules]
    return [F.count(F.lit(1)).alias(_TOTAL), *counts]


def apply_rules(
    df: DataFrame, rules: Sequence[Rule], observation: Observation | str | None = None
) -> DataFrame:
    """Apply the rules' actions to the rows of ``df``.

    ``observation`` collects the counts in the same pass: an ``Observation`` for a
    batch, a name for a stream. Use it where the rows go straight to a table, as
    Spark may count a row again when it repeats a task before a shuffle; elsewhere
    ``rule_report`` gives the exact counts.
    """
    if observation is not None:
        df = df.observe(observation, *rule_counts(rules))
    condition = keep_condition(rules)
    return df if condition is None else df.filter(condition)


def rule_report(df: DataFrame, rules: Sequence[Rule], table_name: str) -> DataFrame:
    """(table_name, rule, action, passed, failed), counted in one pass over ``df``."""
    wide = df.agg(*rule_counts(rules))
    lines = F.array(
        *[
            F.struct(
                F.lit(table_name).alias("table_name"),
                F.lit(r.name).alias("rule"),
                F.lit(r.action).alias("action"),
                F.col(quoted(_PASSED + r.name)).alias("passed"),
                (F.col(_TOTAL) - F.col(quoted(_PASSED + r.name))).alias("failed"),
            )
            for r in rules
        ]
    )
    return wide.select(F.inline(lines))


def report_rows(metrics: dict[str, int], rules: Sequence[Rule], table_name: str) -> list[tuple]:
    """The same lines out of collected counts (one per rule)."""
    total = metrics[_TOTAL]
    return [
        (table_name, r.name, r.action, metrics[_PASSED + r.name], total - metrics[_PASSED + r.name])
        for r in rules
    ]
