"""Dimension-sharded rounds against plain Python integers."""

import hashlib
import math
import random

import pytest

from orefold.llm import centroids


def brute(rows, k, dims, rounds):
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    given = lambda i: (i is None, hashlib.sha256(f"3:{i}".encode()).hexdigest())
    centres = [v for _, v in sorted(kept, key=lambda r: (given(r[0]), r[1]))[:k]]
    square = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    near = lambda v: min((square(v, c), j) for j, c in enumerate(centres))
    for _ in range(rounds):
        own = [near(v)[1] for _, v in kept]
        for j in range(len(centres)):
            mine = [v for (_, v), o in zip(kept, own, strict=True) if o == j]
            if mine:
                centres[j] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
    found = [(i, *near(v)) for i, v in kept]
    total = {j: sum(d for _, d, o in found if o == j) for j in range(k)}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((i, o, d, total[o], sum(total.values()), digest[o]) for i, d, o in found), key=repr)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(9)
    out = [(i, [rng.gauss(i % 5, 1.0) for _ in range(10)]) for i in range(120)]
    out += [(3, out[3][1]), (3, out[3][1]), (4, out[9][1]), (None, out[5][1])]  # repeated rows, one id twice, no id
    out += [(200, out[7][1]), (201, out[7][1])]  # ties
    out += [(300, None), (301, []), (302, [1.0] * 9), (303, [1.0] * 9 + [None]), (304, [1.0] * 9 + [float("nan")]), (305, [float("-inf")] + [0.0] * 9)]
    return out


@pytest.mark.parametrize(("width", "block"), [(4, 7), (3, 1000), (10, 50)])
def test_like_brute_force(monkeypatch, spark, empty, rows, width, block):
    monkeypatch.setattr(centroids, "BLOCK_ROWS", block)
    table = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, id string, `cluster` int").repartition(3)
    out = centroids.cluster(table, k=4, dims=10, rounds=5, width=width)
    assert sorted(map(tuple, out.collect()), key=repr) == brute(rows, 4, 10, 5)


def test_few_vectors(spark, empty):
    table = spark.createDataFrame([(1, [0.5, -0.5]), (2, [3.0, 1e300])], "vec_id long, embedding array<double>")
    few = centroids.cluster(table, dims=2)
    assert sorted((r.vec_id, r.distance) for r in few.collect()) == [(1, 0), (2, 0)]
    none = centroids.cluster(table, dims=3)
    assert none.columns == few.columns and none.count() == 0


def test_leaves_nothing(spark, empty, rows):
    before = {t.name for t in spark.catalog.listTables()}
    centroids.cluster(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), k=2, dims=10, rounds=1)
    assert {t.name for t in spark.catalog.listTables()} == before
