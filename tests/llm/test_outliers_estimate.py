"""The robust estimate: independent of layout, drawn towards all rows smoothly, near the best core."""

import itertools

import numpy as np
import pandas as pd
import pytest

from orefold.llm import outliers

FLAT = ["g_all boolean", "g_lang string", "g_source string", *[f"f{i} double" for i in range(4)]]


def test_layout_makes_no_difference(docs):
    def judged(df):
        return {(r.doc_id, r.n_words): (r.kept, r.distance) for r in outliers.judge(df).collect()}

    one, other = judged(docs), judged(docs.repartition(7))
    assert one.keys() == other.keys()
    for key, (kept, distance) in one.items():
        assert other[key][0] == kept
        assert other[key][1] == distance or other[key][1] == pytest.approx(distance, rel=1e-9)


def rows_of(values, source):
    return [(False, "en", source, *map(float, v)) for v in values]


def test_core_is_near_the_least_determinant(spark, empty):
    """Concentration steps against all subsets of a small group."""
    rng = np.random.default_rng(3)
    values = rng.normal(0, [0.5, 0.3, 0.4, 0.6], (12, 4))
    values[:2] += 8
    share = 0.75
    best = min(itertools.combinations(range(12), 9), key=lambda c: np.linalg.det(np.cov(values[list(c)].T, bias=True)))
    table = spark.createDataFrame(rows_of(values, "a"), ", ".join(FLAT))
    est = outliers.fit_mcd(table, share, 12).toPandas().iloc[0]
    # One group: its own estimate and that of all rows are the same.
    centre = est[[f"c{i}" for i in range(4)]].to_numpy(float)
    assert 0 not in best and 1 not in best
    assert np.abs(centre - values[list(best)].mean(axis=0)).max() < 0.35


def test_small_groups_are_drawn_to_all_rows():
    moments = lambda n, c, v: {"n": n, "rows": n, **{f"c{i}": c for i in range(4)}, **{f"s{i}": 0.0 for i in range(4)}, **{f"p{i}{j}": n * v * (i == j) for i in range(4) for j in range(i, 4)}}
    whole = moments(10_000, 0.0, 1.0)
    centres = []
    for n in (1, 199, 200, 201, 10**6):
        frame = pd.DataFrame([{"g_all": False, "g_lang": "en", "g_source": None, **moments(n, 4.0, 0.25)}])
        centres.append(outliers._drawn(frame, whole, 0.75)["c0"][0])
    assert centres == pytest.approx([4 * n / (n + 200) for n in (1, 199, 200, 201, 10**6)])
