"""Held-out rows of the given tables, of which nothing was learnt."""

import os
import zlib

import pytest

from orefold.llm import queries, toxicity

SF_DIR = "/root/testdata/sf0.1"


def test_held_out_rows(spark):
    if not os.path.isdir(SF_DIR):
        pytest.skip("no test tables")
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect() if r.toxic is not None}
    found = queries.op1_toxicity(spark, SF_DIR).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in found)
    held_out = [(r.predicted, labels[r.doc_id]) for r in found if r.held_out and r.doc_id in labels]
    caught = sum(p for p, y in held_out if y)
    assert caught >= 130 and sum(p for p, y in held_out if not y) <= 10


def test_whole_tokens_come_before_stems():
    scores = toxicity.Scores({"abcdef": 2.0, "abcd*": 0.75})
    assert [scores[t] for t in ("abcdef", "abcdxyz", "abc", "zzz")] == [2.0, 0.75, None, None]
    assert toxicity.TOKEN.findall("it's 1abcdefghij_k") == ["it", "s", "abcdefghij", "k"]
