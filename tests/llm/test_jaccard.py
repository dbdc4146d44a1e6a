"""The n-gram Jaccard join against all pairs."""

import random

import numpy as np
import pyarrow as pa
import pytest

from orefold.llm import blocks, classes, jaccard
from test_operators import brute_near


def groups(seed, sizes, edits, words=70):
    """Groups of copies of a text, each with some words replaced."""
    rng = random.Random(seed)
    rows = []
    for g, size in enumerate(sizes):
        base = [f"w{g}x{i}" if i % 3 else rng.choice(["the", "of", "and"]) for i in range(words)]
        for _ in range(size):
            copy = list(base)
            for _ in range(rng.randint(0, edits)):
                copy[rng.randrange(words)] = f"e{rng.randint(0, 60)}"
            rows.append((len(rows), " ".join(copy)))
    rng.shuffle(rows)
    return rows


def found(df):
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in df.collect())


@pytest.mark.parametrize(("k", "percent", "small", "text"), [(3, 90, 8, 6 << 20), (3, 90, 1, 2000), (2, 70, 2, 5000)])
def test_like_all_pairs(monkeypatch, docs, given, k, percent, small, text):
    monkeypatch.setattr(jaccard, "SMALL", small)
    monkeypatch.setattr(jaccard, "BLOCK_TEXT", text)
    monkeypatch.setattr(jaccard, "RANGE_KEYS", 3000)
    assert found(jaccard.join(docs, k, percent)) == brute_near(given, k, percent)


@pytest.mark.parametrize(("small", "words", "edits"), [(2, 70, 3), (2, 160, 4), (500, 70, 3)])
def test_groups_of_copies(monkeypatch, spark, empty, small, words, edits):
    """Chains of links, members far from the least edited one, and groups without any."""
    monkeypatch.setattr(jaccard, "SMALL", small)
    rows = groups(words + small, [180, 60, 9, 3, 2], edits, words)
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    table = classes.stored(table, "test_groups")
    expected = brute_near(rows, 3, 90)
    assert found(jaccard.join(table)) == expected
    assert len({c for *_, c in expected}) > 5


def test_filters_lose_nothing(spark, empty):
    """Every linked pair shares a prefix row that passes all filters."""
    rows = groups(1, [40, 12, 5], 4)
    table = classes.stored(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), "test_filters")
    named = classes.named_rows(table, 3, "test")
    sets = {n: set(s) for n, s in table.select("text").mapInArrow(lambda b: classes._full(b, 3), "name binary, s array<long>").collect()}
    members = jaccard.prefixes(table, named, 3, 90)
    x, y = members.alias("x"), members.alias("y")
    joined = x.join(y, "node").where("x.name < y.name").selectExpr("x.name", "y.name", "true")
    passed = x.join(y, "node").where("x.name < y.name").where(jaccard.may_link("x", "y", 90)).selectExpr("x.name", "y.name")
    passed = {tuple(map(bytes, r)) for r in passed.collect()}
    linked = {
        (bytes(a), bytes(b)) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b])
    }
    assert linked <= passed
    assert len(passed) < joined.count()


def test_prefix_length():
    n = np.arange(1, 500)
    for percent in (50, 80, 90, 100):
        needed = np.array([min(o for o in range(1, x + 1) if 100 * o >= percent * x) for x in n])
        assert (jaccard.prefix_length(n, percent) == n - needed + 1).all()


def test_reordered_table_is_noticed():
    with pytest.raises(ValueError, match="another order"):
        jaccard._prefixes(pa.table({"block": []}), pa.table({"asker": ["a"]}), 90)


def test_empty_table_and_repeated_rows(spark, empty):
    assert jaccard.join(empty).count() == 0
    rows = [(5, "a b"), (5, "a b"), (None, "A B"), (None, None), (7, ""), (8, "x " * 40), (9, "x " * 80), (None, "only")]
    table = spark.createDataFrame([(*r, "z", 1) for r in rows], "doc_id long, text string, name string, `n` int")
    out = sorted((tuple(r) for r in jaccard.join(table).select("doc_id", "n_shingles", "component_id").collect()), key=repr)
    assert out == sorted([(5, 1, 5), (5, 1, 5), (None, 1, 5), (None, 0, None), (7, 0, 7), (8, 1, 8), (9, 1, 8), (None, 1, None)], key=repr)


def test_names_of_sets():
    texts = [b"a b c d", b"A B  C\tD", b"a b c d e", b""]
    data = np.frombuffer(b"".join(texts), np.uint8)
    block = blocks.Block(data, np.append(0, np.cumsum([len(t) for t in texts])))
    hashes, _, edges = classes.distinct_shingles(block, 3)
    names = classes.set_names(hashes, edges).to_pylist()
    assert names[0] == names[1] != names[2] and len(set(names)) == 3
