"""Sums that do not depend on the order of rows.

A plain ``sum`` of doubles changes in its last digits with the order in which
partitions arrive, and at cluster totals those digits are cents. ``ExactSum`` reads
each value as the decimal its text shows, splits it into whole units and a part of
eighteen places, and sums both as decimals; values below a million need no split. Digits beyond the eighteenth
place are rounded away in each value. Only NaN, infinity and values from 1e30 up,
which such decimals cannot sum, are added as doubles beside it.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_BEYOND = "1e30D"
_WHOLE = "DECIMAL(38, 0)"
_PART = "DECIMAL(18, 18)"


def weighted_count(value: str, copies: str = "1L") -> str:
    """How many values are not NULL, each standing for ``copies`` of itself."""
    return f"coalesce(sum(CASE WHEN {value} IS NOT NULL THEN {copies} END), 0L)"


def _times(copies: str) -> str:
    # Eighteen digits: one more, and the product with a part would lose places.
    return f"CAST({copies} AS DECIMAL(18, 0))"


def _rounded(whole: str, part: str) -> str:
    """``whole`` + ``part``, the latter in [0, 1], rounded half away from zero to cents."""
    return (
        f"CAST(CASE WHEN {whole} >= 0 THEN {whole} + round({part}, 2)"
        f" ELSE {whole} + 1 - round(1 - {part}, 2) END AS DOUBLE)"
    )


class ExactSum:
    """Aggregates for one summed column; they can be aggregated again after a join."""

    def __init__(self, prefix: str) -> None:
        self.units = f"{prefix}_units"
        self.parts = f"{prefix}_parts"
        self.rest = f"{prefix}_rest"
        self.count = f"{prefix}_count"

    def first(self, value: str, copies: str = "1L") -> list[Column]:
        """Aggregates over raw rows, each standing for ``copies`` of itself."""
        as_double = f"CAST({value} AS DOUBLE)"
        fits = f"abs({as_double}) < {_BEYOND}"
        # A double of whole hundredths needs no text; the result is the same, sooner.
        hundredths = f"rint({as_double} * 100D)"
        quick = (
            f"typeof({value}) = 'double' AND abs({as_double}) < 1e9"
            f" AND {hundredths} / 100D = {as_double}"
        )
        cents = f"CAST(CAST({hundredths} AS BIGINT) AS DECIMAL(18, 0))"
        # From 1e20 up, where this is NULL, a double has no part below one.
        fine = f"try_cast({value} AS DECIMAL(38, 18))"
        whole = f"coalesce(floor({fine}), try_cast({value} AS {_WHOLE}))"
        part = f"coalesce(CAST(pmod({fine}, 1BD) AS {_PART}), 0BD)"
        slow = f"NOT ({quick}) AND {fits}"
        # What is small is summed as it is: 10^13 such values still have their twenty digits before the point.
        small = f"NOT ({quick}) AND abs({as_double}) < 1e6D" if copies == "1L" else "false"
        return self._sums(
            f"CASE WHEN {small} THEN 0BD WHEN {slow} THEN {whole} END",
            f"CASE WHEN {small} THEN {fine} WHEN {slow} THEN CAST({part} AS {_PART}) END",
            f"CASE WHEN NOT {fits} THEN {as_double} END",
            weighted_count(value, copies),
            copies,
            f"CASE WHEN {quick} THEN {cents} END",
        )

    def again(self, copies: str) -> list[Column]:
        """Aggregates over grouped rows, each standing for ``copies`` of itself."""
        whole, part = self._carried()
        count = f"sum({self.count} * {copies})"
        return self._sums(whole, part, self.rest, count, copies)

    def _sums(
        self, whole: str, part: str, rest: str, count: str, copies: str, cents: str | None = None
    ) -> list[Column]:
        by = "" if copies == "1L" else f" * {_times(copies)}"
        units = f"CAST(sum(CAST({whole} AS {_WHOLE}){by}) AS {_WHOLE})"
        parts = f"CAST(sum({part}{by}) AS DECIMAL(38, 18))"
        if cents:
            sum_cents = f"CAST(sum({cents}{by}) AS {_WHOLE})"
            over = f"pmod({sum_cents}, 100BD)"
            even = f"CAST(({sum_cents} - {over}) * 0.01BD AS {_WHOLE})"
            units = f"CAST(coalesce({units} + {even}, {units}, {even}) AS {_WHOLE})"
            over = f"CAST({over} * 0.01BD AS DECIMAL(20, 18))"
            parts = f"CAST(coalesce({parts} + {over}, {parts}, {over}) AS DECIMAL(38, 18))"
        return [
            F.expr(f"{units} AS {self.units}"),
            F.expr(f"{parts} AS {self.parts}"),
            F.expr(f"sum({rest} * {copies}) AS {self.rest}"),
            F.expr(f"{count} AS {self.count}"),
        ]

    def _carried(self) -> tuple[str, str]:
        """Whole units with those that the parts add up to, and the part that is left."""
        whole = f"CAST({self.units} + floor({self.parts}) AS {_WHOLE})"
        return whole, f"CAST(pmod({self.parts}, 1BD) AS {_PART})"

    def total(self, copies: str = "1L") -> Column:
        """The sum, rounded half up to two places, as a double."""
        whole, part = self._carried()
        part = f"({part} * {_times(copies)})"
        whole = f"CAST({whole} * {_times(copies)} + floor({part}) AS {_WHOLE})"
        part = f"CAST(pmod({part}, 1BD) AS {_PART})"
        as_double = f"coalesce(CAST({whole} AS DOUBLE) + CAST({part} AS DOUBLE), 0D)"
        return F.expr(
            f"CASE WHEN {self.rest} IS NULL THEN {_rounded(whole, part)}"
            f" ELSE round({as_double} + {self.rest} * {copies}, 2) END"
        )

    def mean(self) -> Column:
        """The mean, rounded half up to two places, as a double; NULL without values."""
        whole, part = self._carried()
        # The whole units that do not divide evenly are divided together with the part.
        over = f"CAST(pmod({whole}, CAST({self.count} AS DECIMAL(19, 0))) AS DECIMAL(19, 0))"
        even = f"CAST(({whole} - {over}) / CAST({self.count} AS DECIMAL(19, 0)) AS DECIMAL(36, 0))"
        left = f"CAST(({over} + {part}) / CAST({self.count} AS DECIMAL(19, 0)) AS DECIMAL(38, 18))"
        as_double = (
            f"(coalesce(CAST({whole} AS DOUBLE) + CAST({part} AS DOUBLE), 0D) + {self.rest})"
            f" / {self.count}"
        )
        return F.expr(
            f"CASE WHEN {self.count} > 0 THEN"
            f" CASE WHEN {self.rest} IS NULL THEN {_rounded(even, left)}"
            f" ELSE round({as_double}, 2) END END"
        )
