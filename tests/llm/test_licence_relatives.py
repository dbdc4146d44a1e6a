"""Relatives and versions, and the passage rule against a plain walk over words."""

import random
import re

import pytest

from orefold.llm import licences

NOTICES = {
    "This library is licensed under the GNU Lesser General Public License, version 2.1.": ["lgpl-2.1"],
    "This work is licensed under the GNU General Public License, version 2.": ["gpl-2.0"],
    "This work is licensed under the GNU General Public License, version 3.": ["gpl-3.0"],
    "This work is licensed under the GNU General Public License, version 1.": [],
    "This work is licensed under the GNU Lesser General Public License, version 2.": [],
    "Licensed under the Apache License, Version 1.1.": ["apache-1.1"],
    "Licensed under the Apache License, Version 1.0.": [],
    "Licensed under the Apache License, Version 2.0.": ["apache-2.0"],
    "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.": ["cc-by-sa-4.0"],
    "This work is licensed under a Creative Commons Attribution 3.0 International License.": [],
    "This work is licensed under a Creative Commons Attribution 4.0 International License.": ["cc-by-4.0"],
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.": ["mpl-2.0"],
    "Licensed under the Mozilla Public License, Version 1.1.": [],
    "SPDX-License-Identifier: Apache-2.0": ["apache-2.0"],
    "SPDX-License-Identifier: Zlib": [],
    "Licensed under the BSD 2-Clause License.": ["bsd-2-clause"],
    "you may use the license of any version, 2.0 or 3, and the General Public may not": [],
}


@pytest.fixture(scope="module")
def model(docs):
    return licences.fit(docs.select("doc_id", "text"))


def test_relatives(spark, model):
    rows = list(enumerate(NOTICES))
    rows += [(100 + i, "prose that goes on for a while " * 4 + n + " and prose that goes on " * 3) for i, n in rows]
    found = {r.doc_id: r.families for r in licences.label(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    expected = {i: NOTICES[n] for i, n in enumerate(NOTICES)}
    assert found == expected | {100 + i: f for i, f in expected.items()}


def test_margin_is_taken_from_the_lines(model):
    none = max(model.intercepts[1:]) - model.intercepts[0]
    assert model.threshold != 0 and model.threshold >= none


def plain_words(text):
    text = re.sub(r"[^\w.\-]+|_", " ", text.lower())
    return [w for w in (re.sub(r"^[.\-]+|[.\-]+$", "", x) for x in text.split()) if w]


def walk(text, model):
    """Families of which a sentence stands in the text with enough of its pairs and all that decide, place by place."""
    own = plain_words(text)
    pairs = [" ".join(p) for p in zip(own, own[1:])]
    out = set()
    for t in model.sentences:
        for start in range(-len(t.pairs), len(pairs)):
            there = {i for i, g in enumerate(t.pairs) if 0 <= start + i < len(pairs) and pairs[start + i] == g}
            if len(there) >= licences.CONFIRM * len(t.pairs) and there >= set(t.needs):
                out.add(t.family)
    return out


def test_passages_like_a_walk(spark, model):
    rng = random.Random(11)
    given = [s.replace("*", "") for f in licences.TEMPLATES.values() for s in f]
    rows = []
    for i in range(150):
        w = rng.choice(given).split()
        if rng.random() < 0.5:  # a word of the notice changed
            w[rng.randrange(len(w))] = rng.choice(["the", "3", "2.0", "any", "lesser", "work"])
        filler = [rng.choice(["rain", "town", "of", "license", "version", "the", "under", "2.0"]) for _ in range(rng.randint(0, 30))]
        rows.append((i, " ".join([*filler, "\n" if i % 3 else " ", *w, "~", *filler[::-1]])))
    table = spark.createDataFrame(rows, "doc_id long, text string")
    bare = licences.replace(model, threshold=float("-inf"))
    found = {r.doc_id: set(r.families) for r in licences.label(table, bare).collect()}
    for i, text in rows:
        walked = walk(text, model)
        # Of several families on the same words the nearest stays.
        assert found[i] <= walked and bool(found[i]) == bool(walked), (text, found[i], walked)
