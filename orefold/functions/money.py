"""Currency conversion."""

from __future__ import annotations

from collections.abc import Mapping

from .fixed import USD_RATES
from .numbers import round_cents


def to_usd(amount: str, currency: str, rates: Mapping[str, float] = USD_RATES) -> str:
    """``amount`` in dollars, rounded to cents.

    A currency outside ``rates``, NULL included, keeps its amount.
    """
    cases = []
    for code, rate in rates.items():
        escaped = code.replace("\\", "\\\\").replace("'", "\\'")
        cases.append(f"WHEN '{escaped}' THEN {float(rate)!r}D")
    factor = f"CASE {currency} {' '.join(cases)} ELSE 1D END" if cases else "1D"
    return round_cents(f"(CAST({amount} AS DOUBLE) * {factor})")
