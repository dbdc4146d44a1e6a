"""Work of a batch run that is done once, and by many tasks."""

import pytest

from orefold.operators import metrics
from orefold.plans import batch
from orefold.sources.csv_files import write_csv
from rows import frames, sorted_rows


@pytest.fixture
def silver(spark, space):
    for entity, df in frames(spark).items():
        write_csv(df, space.landing, entity)
    return batch.build_silver(batch.load_bronze(spark, space.landing, space.schema), space.schema)


def test_gold_sums_the_enrollments_once(spark, space, silver, monkeypatch):
    calls = []
    for name in ("money_per_course", "enrollments_per_course"):
        made = getattr(metrics, name)
        monkeypatch.setattr(metrics, name, lambda *a, n=name, f=made, **k: calls.append(n) or f(*a, **k))
    gold = batch.build_gold(silver, space.schema)
    assert calls == ["money_per_course"]
    monkeypatch.undo()
    enrollments, courses = silver["enrollments"], silver["courses"]
    rates = metrics.completion_rate(silver["progress"], courses)
    expected = {
        batch.GOLD_COMPLETION: rates,
        batch.GOLD_LOW_ENGAGEMENT: metrics.low_engagement(rates, enrollments),
        batch.GOLD_REVENUE: metrics.revenue_by_instructor(enrollments, courses, silver["instructors"]),
        batch.GOLD_CATEGORIES: metrics.revenue_by_category(enrollments, courses),
    }
    for name, df in expected.items():
        assert gold[name].columns == df.columns
        assert repr(sorted_rows(gold[name])) == repr(sorted_rows(df))
    assert not spark.catalog.tableExists(space.table("enrollment_sums"))


def test_sums_go_when_a_metric_fails(spark, space, silver, monkeypatch):
    def broken(*args, **options):
        raise RuntimeError("no revenue")

    monkeypatch.setattr(metrics, "revenue_by_category", broken)
    with pytest.raises(RuntimeError, match="no revenue"):
        batch.build_gold(silver, space.schema)
    assert not spark.catalog.tableExists(space.table("enrollment_sums"))
