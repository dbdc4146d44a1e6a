import random

import pytest
from pyspark.sql import functions as F

from orefold.llm.stored import importable

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n):
    syllables = ["an", "re", "the", "ti", "on", "sh", "lo", "mi", "ka", "vu"]
    words = ["".join(rng.choices(syllables, k=rng.randint(2, 4))) for _ in range(n)]
    return " ".join(w + ("." if i % 9 == 8 else "") for i, w in enumerate(words))


def rows():
    rng = random.Random(5)
    out = [(i, prose(rng, rng.randint(5, 120)), "en" if i % 2 else "de", f"s{i % 4}", 0) for i in range(60)]
    base = prose(rng, 100).split(" ")
    for i in range(60, 90):  # near copies, and a few edits too many
        copy = list(base)
        for _ in range(rng.randint(0, 8)):
            copy[rng.randrange(len(copy))] = "edit" + str(rng.randint(0, 10**6))
        out.append((i, " ".join(copy), "en", "s1", 0))
    out += [(i, out[3][1], "en", "s2", 0) for i in range(90, 95)]  # exact copies
    out += [(95, None, None, None, None), (96, "", "en", "s1", 0), (97, " \n\t", "", "", 0), (98, "Ünï cödé, it's 12345", "fr", "s1", 0)]
    out += [(99, prose(rng, 30_000), "en", "s3", 0), (100, "A b", "en", "s1", 0), (101, "a B", "en", "s1", 0)]
    out += [(3, out[3][1], "en", "s1", 0), (102, out[5][1] + "\n" + out[5][1], "en", "s1", 0)]
    return out


@pytest.fixture(scope="session")
def docs(spark):
    importable(spark)
    # Extra columns whose names the operators use themselves.
    extra = [F.lit(i).alias(n) for i, n in enumerate(("row", "n", "hash", "places", "size", "copies", "key", "name"))]
    return spark.createDataFrame(rows(), SCHEMA).select("*", *extra).coalesce(2)


@pytest.fixture(scope="session")
def empty(spark):
    importable(spark)
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def given():
    return rows()


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(i, int(i % 5 > 0), int(i % 7 == 0)) for i in range(60)], "doc_id long, quality int, toxic int")
