"""Pairs of ``op10_near`` and ``op11_jaccard`` that need no full sets take none along."""

import random

from orefold.llm import classes


def _texts(share, n, words=400):
    """Texts that share ``share`` of their words in one run, each with an end of its own."""
    common = [f"c{i}" for i in range(words)]
    for i in range(n):
        rng = random.Random(i)
        yield i, " ".join(common[: int(words * share)] + [f"o{rng.random()}" for _ in range(words - int(words * share))])


def test_unlike_pairs_take_no_full_sets_along(spark, monkeypatch):
    # Halves in common: far from linked. The last two differ in one word.
    rows = [*_texts(0.5, 12), (100, " ".join(f"z{i}" for i in range(300))), (101, " ".join(f"z{i}" for i in range(299)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    named = classes.classes_of(classes.named_rows(docs, 4, "t"), "t")
    a, b = named.select("name", "n").alias("a"), named.select("name", "n").alias("b")
    pairs = a.crossJoin(b).where("a.name < b.name").select(*classes.pair("a", "b"))
    kept, store = {}, classes.stored

    def seen(df, label):
        kept[label] = store(df, label)
        return kept[label]

    monkeypatch.setattr(classes, "stored", seen)
    measured = classes.confirmed(pairs, named, docs, 4, 80, "t")
    assert measured.count() == 14 * 13 // 2
    assert measured.where("linked").count() == 1
    possible = kept["t_possible"].where("possible")
    # The pairs of the 12 would be 66 of these.
    assert 1 <= possible.count() <= 3


def test_parity_bits_are_at_most_the_unlike_shingles(spark):
    docs = spark.createDataFrame([*_texts(0.9, 6), *[(i + 10, t) for i, t in _texts(0.2, 6, 9)]], "doc_id long, text string")
    sets = docs.select("text").mapInArrow(lambda b: classes._sketched(b, 3), classes.SETS)
    rows = sets.collect()
    assert len(rows) == 12
    for x in rows:
        for y in rows:
            flipped = sum(((x[w] ^ y[w]) & (2**64 - 1)).bit_count() for w in classes.WIDE)
            unlike = len(set(x.shingles) ^ set(y.shingles))
            assert flipped <= unlike and flipped % 2 == unlike % 2
