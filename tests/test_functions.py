import math
from decimal import Decimal
from fractions import Fraction

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F
import pytest

from orefold.functions.exact import ExactSum
from orefold.functions.money import to_usd
from orefold.functions.numbers import at_least_one, not_negative, number, percent, round_cents

SLOW = settings(
    max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def test_numbers_from_text(spark):
    texts = ["5", " 3 ", "1.5", "0.5", "abc", "", None, "-1", "NaN", "1e1"]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    got = df.select(
        "x", F.expr(number(df, "x")).alias("n"), F.expr(at_least_one(df, "x")).alias("one"),
        F.expr(not_negative(df, "x")).alias("pos"),
    ).collect()
    by_text = {r.x: r for r in got}
    assert by_text[" 3 "].n == 3.0
    assert [by_text[t].n for t in ("abc", "", None)] == [None] * 3
    assert [by_text[t].one for t in ("5", "1.5", "0.5", "-1", "NaN")] == [
        True, True, False, False, False,
    ]
    assert [by_text[t].pos for t in ("5", "-1", "NaN", "0.5")] == [True, False, False, True]


def test_typed_numbers_are_left_alone(spark):
    df = spark.range(1)
    assert "cast" not in df.selectExpr(number(df, "id"))._jdf.queryExecution().toString().lower()


@pytest.mark.parametrize(
    "amount, currency, usd",
    [
        (100.0, "MXN", 5.8),
        (1000000.0, "COP", 240.0),
        (10.0, "PEN", 2.7),
        (50.5, "USD", 50.5),
        (7.0, "EUR", 7.0),
        (1.005, None, 1.01),
        (-1.005, None, -1.01),
        (None, "MXN", None),
        (0.0, "USD", 0.0),
    ],
)
def test_usd(spark, amount, currency, usd):
    df = spark.createDataFrame([(amount, currency)], "a double, c string")
    assert df.selectExpr(to_usd("a", "c")).first()[0] == usd


def test_usd_takes_other_rates(spark):
    df = spark.createDataFrame([(10.0, "EUR"), (10.0, "MXN")], "a double, c string")
    rows = df.selectExpr(to_usd("a", "c", {"EUR": 1.1})).collect()
    assert [r[0] for r in rows] == [11.0, 10.0]


@SLOW
@given(st.lists(st.floats(width=64) | st.none(), min_size=1, max_size=60))
def test_round_cents_equals_round(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    rows = df.select(
        F.round("x", 2).cast("string").alias("a"), F.expr(round_cents("x")).cast("string").alias("b")
    ).collect()
    assert [r.a for r in rows] == [r.b for r in rows]


def test_round_cents_on_ties(spark):
    df = spark.range(-200_000, 200_000, 1, 4).select((F.col("id") / 1000.0 + 0.005).alias("x"))
    same = F.round("x", 2).cast("string").eqNullSafe(F.expr(round_cents("x")).cast("string"))
    assert df.filter(~same).isEmpty()


@SLOW
@given(
    st.lists(
        st.tuples(st.integers(0, 10**6), st.integers(1, 10**6)), min_size=1, max_size=60
    )
)
def test_percent_of_whole_counts(spark, pairs):
    df = spark.createDataFrame(pairs, "l bigint, t bigint")
    got = [r[0] for r in df.selectExpr(percent("CAST(l AS DOUBLE)", "CAST(t AS DOUBLE)")).collect()]
    want = [math.floor(Fraction(10_000 * l, t) + Fraction(1, 2)) / 100 for l, t in pairs]
    assert got == want


def test_percent_odd_values(spark):
    rows = [(1.5, 3.0), (1.0, 800.0), (-1.0, 800.0), (None, 2.0), (2.0, 0.0), (12.0, 10.0),
            (1e13, 2e13)]
    df = spark.createDataFrame(rows, "l double, t double")
    got = [r[0] for r in df.selectExpr(percent("CAST(l AS DOUBLE)", "CAST(t AS DOUBLE)")).collect()]
    assert got == [50.0, 0.13, -0.13, None, None, 120.0, 50.0]


amounts = st.integers(-(10**10), 10**10).map(lambda c: c / 100)


@SLOW
@given(st.lists(st.tuples(amounts | st.none(), st.integers(1, 3)), min_size=1, max_size=80))
def test_exact_sum(spark, rows):
    df = spark.createDataFrame(rows, "x double, g int")
    part = ExactSum("p")
    once = df.groupBy("g").agg(*part.first("x"))
    got = {r.g: (r.t, r.m) for r in once.select("g", part.total().alias("t"), part.mean().alias("m")).collect()}
    for group in {g for _, g in rows}:
        kept = [Decimal(str(x)) for x, g in rows if g == group and x is not None]
        if not kept:
            assert got[group] == (None, None)
            continue
        total = sum(kept)
        numerator, count = int(total * 100), len(kept)
        size = (2 * abs(numerator) + count) // (2 * count)
        assert got[group] == (float(total), (-size if total < 0 else size) / 100)
    twice = once.agg(*part.again("2L")).select(part.total()).first()[0]
    everything = [Decimal(str(x)) for x, _ in rows if x is not None]
    assert twice == (float(2 * sum(everything)) if everything else None)


def test_exact_sum_of_large_values_and_what_no_decimal_holds(spark):
    part = ExactSum("p")

    def total(values):
        df = spark.createDataFrame([(v,) for v in values], "x double")
        grouped = df.agg(*part.first("x"))
        return grouped.select(part.total(), part.mean()).first()

    assert total([1e12, 0.25]) == (1e12 + 0.25, 500000000000.13)
    assert math.isnan(total([1.0, float("nan")])[0])
    assert total([float("inf"), 1.0])[0] == float("inf")
    assert total([0.01] * 1000)[0] == 10.0
