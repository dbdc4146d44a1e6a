"""Licence scan: a trained paragraph classifier.

A paragraph is a line with words, or a passage of a text whatever its lines. Its features are the
word pairs and triples of the templates. A multinomial logistic regression with an L1 penalty (so
that few weights remain) tells licence families, near relatives and versions among them, from
ordinary text, which is a class of its own, ``unknown``. The margin that a family needs over
``unknown`` is taken from all lines of the corpus: at most ``FALSE_ALARMS`` of those that are like no
template exceed it. What passes is compared with the family's template, sentence by sentence: a
share of ``CONFIRM`` of the pairs of one sentence must be there, and all pairs that decide
(marked in the templates), such as a version or the word that tells a licence from its relative.

A notice may stand inside a longer line or run over several lines. So texts are looked
through as runs of words as well, whatever their lines: where a template's sentence comes at about
its places, the words from the first to the last of them are a passage, with the family's margin
over ``unknown`` from the passage's own grams. Of passages of several families on the same words
the one nearest its template stays. Texts without any word that decides need no look.

Everything runs as DataFrame operations, training by Spark's own library.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, replace

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import SparseVector
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .stored import stored

#: Public notices, by family and sentence. A word with a star decides together with the word
#: before it: without that pair the sentence does not count. Sentences that relatives share have none.
TEMPLATES = {
    "apache-2.0": [
        "Licensed under the Apache *License, Version *2.0 (the License)",
        "you may not use this file except in compliance with the License",
        "You may obtain a copy of the License at the address below",
        "SPDX-License-Identifier: *Apache-2.0",
    ],
    "apache-1.1": ["Licensed under the Apache Software *License, Version *1.1", "Licensed under the Apache *License, Version *1.1", "SPDX-License-Identifier: *Apache-1.1"],
    "mit": [
        "Released under the MIT *License",
        "Licensed under the MIT *License",
        "Permission is hereby *granted, free of *charge, to any *person obtaining a copy of this software and associated documentation files",
        "to deal in the Software without restriction",
        "SPDX-License-Identifier: *MIT",
    ],
    "gpl-2.0": ["This work is licensed under the GNU *General Public *License, version *2", "under the terms of the GNU *General Public *License version *2 as published by the Free Software Foundation", "SPDX-License-Identifier: *GPL-2.0-only"],
    "gpl-3.0": [
        "This work is licensed under the GNU *General Public *License, version *3",
        "under the terms of the GNU *General Public *License version *3 as published by the Free Software Foundation",
        "This program is free software: you can redistribute it and/or modify it",
        "SPDX-License-Identifier: *GPL-3.0-only",
    ],
    "lgpl-2.1": ["This work is licensed under the GNU *Lesser *General Public *License, version *2.1", "under the terms of the GNU *Lesser *General Public *License version *2.1 as published by the Free Software Foundation", "SPDX-License-Identifier: *LGPL-2.1-only"],
    "lgpl-3.0": ["This work is licensed under the GNU *Lesser *General Public *License, version *3", "under the terms of the GNU *Lesser *General Public *License version *3 as published by the Free Software Foundation", "SPDX-License-Identifier: *LGPL-3.0-only"],
    "agpl-3.0": ["This work is licensed under the GNU *Affero *General Public *License, version *3", "under the terms of the GNU *Affero *General Public *License version *3 as published by the Free Software Foundation", "SPDX-License-Identifier: *AGPL-3.0-only"],
    "mpl-2.0": ["This Source Code Form is subject to the terms of the Mozilla *Public *License, v. *2.0", "Licensed under the Mozilla *Public *License, Version *2.0", "SPDX-License-Identifier: *MPL-2.0"],
    "cc-by-nc-4.0": ["Licensed under CC *BY-NC *4.0", "This work is licensed under a Creative Commons *Attribution-NonCommercial *4.0 International License", "SPDX-License-Identifier: *CC-BY-NC-4.0"],
    "cc-by-sa-4.0": ["Licensed under CC *BY-SA *4.0", "This work is licensed under a Creative Commons *Attribution-ShareAlike *4.0 International License", "SPDX-License-Identifier: *CC-BY-SA-4.0"],
    "cc-by-4.0": ["Licensed under CC *BY *4.0", "This work is licensed under a Creative Commons *Attribution *4.0 International License", "SPDX-License-Identifier: *CC-BY-4.0"],
    "bsd-3-clause": ["Licensed under the BSD *3-Clause License", "SPDX-License-Identifier: *BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"],
    "bsd-2-clause": ["Licensed under the BSD *2-Clause License", "SPDX-License-Identifier: *BSD-2-Clause"],
    "all-rights-reserved": ["Copyright the authors", "All rights *reserved", "No part of this publication may be reproduced without prior permission"],
}
UNKNOWN = "unknown"
#: Ordinary lines, chosen by hash from all texts, that training sees.
ORDINARY_LINES = 2_000
#: Of the lines that are like no template, the share that may exceed the margin.
FALSE_ALARMS = 0.0005
#: Steps of the grid that margins are counted on.
GRID = 1000
#: A line with less than this share of every sentence's pairs is like no template.
UNLIKE = 0.3
#: Training cuts templates to runs of these numbers of words.
CUTS = (3, 5, 7, 10, 16)
CONFIRM = 0.6
PENALTY = 0.0001
#: Sentences of a template, to compare passages with: those of so many words at least.
LEAST_WORDS = 2
#: Passages and grams of a text meet by stretches of so many words.
STRETCH = 64


def words(text: Column) -> Column:
    """Lower-case words of letters, digits, dots and hyphens, without dots at their ends."""
    cleaned = F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}.\-]+", " ")
    return F.split(F.trim(F.regexp_replace(cleaned, r"(?<![\p{L}\p{N}])[.\-]+|[.\-]+(?![\p{L}\p{N}])", "")), " +")


def grams(given: Column) -> Column:
    """Distinct pairs and triples of neighbouring words."""
    at = lambda k: F.transform(
        F.when(F.size(given) >= k, F.sequence(F.lit(1), F.size(given) - (k - 1))).otherwise(F.array().cast("array<int>")),
        lambda i: F.array_join(F.slice(given, i, k), " "),
    )
    return F.array_distinct(F.concat(at(2), at(3)))


@dataclass(frozen=True)
class Sentence:
    """One sentence of a family's template: its pairs, and which of them decide."""

    family: str
    number: int
    pairs: list[str]
    needs: list[int]


@dataclass(frozen=True)
class Model:
    """Weights by gram and family, intercepts, the margin needed over ``unknown``, template sentences, words that texts must have one of."""

    weights: dict[str, list[float]]
    intercepts: list[float]
    families: list[str]
    threshold: float
    sentences: list[Sentence]
    keys: list[str]


def _has(text: Column, keys: list[str]) -> Column:
    """Whether a text has one of the words, in any case and between any marks."""
    parts = F.split(F.lower(text), r"[^\p{L}\p{N}]+")
    return F.arrays_overlap(parts, F.array(*[F.lit(k) for k in keys]))


def lines(docs: DataFrame) -> DataFrame:
    """(doc_id, place, line) of every line with words and all other columns but text; places count from 0 over all lines."""
    others = [F.col(c) for c in docs.columns if c not in ("doc_id", "text")]
    split = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), *others, F.posexplode(F.split(F.col("text").cast("string"), "\n")).alias("place", "line")
    )
    return split.where(F.col("line").rlike(r"[\p{L}\p{N}]"))


def _sentence_words(spark: SparkSession) -> list[tuple[str, int, list[str], list[str]]]:
    """(family, number, words, words with their stars) of the templates' sentences."""
    rows = [(f, i, s.replace("*", ""), s.replace("*", "x0star")) for f, given in TEMPLATES.items() for i, s in enumerate(given)]
    out = spark.createDataFrame(rows, "family string, number int, s string, starred string")
    return [(r.family, r.number, r.w, r.m) for r in out.select("family", "number", words(F.col("s")).alias("w"), words(F.col("starred")).alias("m")).collect()]


def sentences(spark: SparkSession) -> list[Sentence]:
    """Those that decide something; the others are for training alone."""
    out = []
    for family, number, w, marked in _sentence_words(spark):
        needs = [i - 1 for i, m in enumerate(marked) if m.startswith("x0star")]
        if needs and len(w) >= LEAST_WORDS:
            out.append(Sentence(family, number, [" ".join(p) for p in zip(w, w[1:], strict=False)], needs))
    return out


def _templates(spark: SparkSession) -> DataFrame:
    given = _sentence_words(spark)
    whole = [(f, [x for g, _, w, _ in given if g == f for x in w]) for f in TEMPLATES]
    rows = spark.createDataFrame([*whole, *((f, w) for f, _, w, _ in given)], "family string, w array<string>")
    cut = [
        rows.select("family", F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - (n - 1)))).alias("i"), "w").select(
            "family", F.slice("w", F.col("i"), n).alias("w")
        )
        for n in CUTS
    ]
    out = rows
    for part in cut:
        out = out.unionByName(part)
    return out


def _keys(docs: DataFrame, known: list[Sentence]) -> list[str]:
    """The rarest word, over all texts, of the pairs that decide in each sentence. A text that has none of these words
    has no sentence that counts."""
    parts = {(s.family, s.number): sorted({x for i in s.needs for x in re.split(r"[ .\-]+", s.pairs[i])}) for s in known}
    every = F.array(*[F.lit(x) for x in sorted({x for p in parts.values() for x in p})])
    found = docs.select(F.explode(F.array_intersect(F.split(F.lower(F.col("text").cast("string")), r"[^\p{L}\p{N}]+"), every)).alias("word"))
    seen = {r.word: r["count"] for r in found.groupBy("word").count().collect()}  # some dozens
    return sorted({min(p, key=lambda x: (seen.get(x, 0), -len(x), x)) for p in parts.values()})


def fit(docs: DataFrame) -> Model:
    """Train on cuts of the templates and on ordinary lines: those without a word such as licensed or rights.

    ``ORDINARY_LINES`` of the corpus are chosen by hash to train on; a corpus without lines
    trains on the templates alone. The margin is taken from all lines.
    """
    spark = docs.sparkSession
    families = [UNKNOWN, *sorted(TEMPLATES)]
    samples = _templates(spark).select("family", grams(F.col("w")).alias("grams"))
    known = sorted({g for r in samples.select("grams").collect() for g in r.grams})  # some hundreds
    starts = ["licensed", "license", "copyright", "rights", "permission", "redistribution"]
    bare = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    # By the hash alone, so that only what is chosen is looked at; a share of the lines that holds some times as
    # many as are wanted, so that tasks send few of them to the one that sorts.
    total = _line_count(bare)
    share = min(1.0, 4 * ORDINARY_LINES / max(total, 1))
    hashed = lines(bare).select("line", F.xxhash64("line").alias("h"))
    chosen = hashed.where(F.pmod("h", F.lit(1 << 30)) <= int(share * (1 << 30))).orderBy("h", "line").limit(ORDINARY_LINES)
    ordinary = chosen.select(words(F.col("line")).alias("w")).where(~F.arrays_overlap("w", F.array(*[F.lit(x) for x in starts])))
    held = F.array(*[F.lit(g) for g in known])
    told = ordinary.select(F.array_intersect(grams(F.col("w")), held).alias("grams")).collect()
    rows = [(0.0, r.grams) for r in told] + [(0.0, [])]
    rows += [(float(families.index(r.family)), r.grams) for r in samples.collect()]
    place = {g: i for i, g in enumerate(known)}
    vector = lambda gs: SparseVector(len(known), {place[g]: 1.0 for g in gs})
    data = spark.createDataFrame([(label, vector(gs)) for label, gs in rows], ["label", "features"]).coalesce(1)
    model = LogisticRegression(regParam=PENALTY, elasticNetParam=1.0, family="multinomial", maxIter=40, standardization=False).fit(data)
    matrix = model.coefficientMatrix.toArray()[: len(families)]
    intercepts = model.interceptVector.toArray().tolist()[: len(families)]
    weights = {g: matrix[:, i].tolist() for g, i in place.items() if abs(matrix[:, i]).max() > 1e-6}
    given = sentences(spark)
    draft = Model(weights, intercepts, families, float("-inf"), given, _keys(bare, given))
    return replace(draft, threshold=_margin(bare, draft, total))


def _line_count(docs: DataFrame) -> int:
    return docs.agg(F.sum(F.regexp_count(F.col("text"), F.lit(r"(?m)^.*[\p{L}\p{N}].*$"))).alias("n")).first().n or 0


def _margin(docs: DataFrame, draft: Model, total: int) -> float:
    """The margin that ``FALSE_ALARMS`` of the lines like no template exceed. Lines of texts without a key word
    can't be confirmed and count as not exceeding it."""
    unlike = _whole_lines(_texts(docs, draft), draft).where(F.col("overlap") < UNLIKE)
    # Counted on a grid, so that some thousand numbers are sent whatever the number of lines.
    cells = unlike.groupBy(F.floor(F.col("margin") * GRID).alias("cell")).agg(F.sum("copies")).collect()
    left, least = int(FALSE_ALARMS * total), max(draft.intercepts[1:]) - draft.intercepts[0]  # that of a line without any weighted gram
    for cell, n in sorted(map(tuple, cells), reverse=True):
        left -= n
        if left < 0:
            return max(least, (cell + 1) / GRID)
    return least


def _texts(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, row, text) of texts that can have a weighted gram; ``row`` names equal texts."""
    text = F.col("text").cast("string")
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).where(_has(F.col("text"), model.keys))
    return stored(given.select("doc_id", F.xxhash64("text").alias("row"), "text"), "licences_texts")


def _whole_lines(texts: DataFrame, model: Model) -> DataFrame:
    """Lines as ``scan`` has them, with row and copies."""
    spark = texts.sparkSession
    weights = spark.createDataFrame(list(model.weights.items()), "gram string, w array<double>")  # no more than the templates have grams
    found = lines(texts)
    found = found.where(_has(F.col("line"), model.keys)).withColumn("words", words(F.col("line")))
    # Lines have no name of their own where rows repeat, so the line goes along and is counted.
    given = found.groupBy("doc_id", "row", "place", "words").agg(F.count("*").alias("copies"))
    scored = given.select("*", F.explode(grams(F.col("words"))).alias("gram")).join(F.broadcast(weights), "gram")
    sums = [F.sum(F.col("w")[c]).alias(f"z{c}") for c in range(len(model.families))]
    scored = scored.groupBy("doc_id", "row", "place", "words", "copies").agg(*sums)
    z = [F.col(f"z{c}") + F.lit(b) for c, b in enumerate(model.intercepts)]
    best = F.greatest(*[F.struct(x.alias("z"), F.lit(f).alias("family")) for x, f in zip(z[1:], model.families[1:], strict=True)])
    judged = scored.select("doc_id", "row", "place", "words", "copies", (best["z"] - z[0]).alias("margin"), best["family"].alias("family"))
    judged = judged.where(F.col("margin") > model.threshold)
    given = [(t.family, t.pairs, [t.pairs[i] for i in t.needs]) for t in model.sentences]
    templates = spark.createDataFrame(given, "family string, pairs array<string>, needs array<string>")
    pair = F.transform(F.sequence(F.lit(1), F.size("words") - 1), lambda i: F.array_join(F.slice("words", i, 2), " "))
    compared = judged.where(F.size("words") > 1).join(F.broadcast(templates), "family").withColumn("mine", F.array_distinct(pair))
    overlap = F.size(F.array_intersect("mine", "pairs")) / F.least(F.size("mine"), F.size("pairs"))
    decided = (overlap >= CONFIRM) & (F.size(F.array_except("needs", "mine")) == 0)
    compared = compared.select("doc_id", "row", "place", "family", "margin", overlap.alias("overlap"), decided.alias("confirmed"), "copies")
    # The sentence that says most for the family.
    nearest = F.max(F.struct("confirmed", "overlap")).alias("best")
    compared = compared.groupBy("doc_id", "row", "place", "family", "margin", "copies").agg(nearest)
    return compared.select("doc_id", "row", "place", "family", "margin", "best.overlap", "best.confirmed", "copies")


def _hits(texts: DataFrame, grams_: DataFrame) -> DataFrame:
    """(doc_id, row, i, place, till, gram, copies): the known grams of each text; i counts words, place and till are the lines of the first two."""
    split = F.transform(
        F.split("text", "\n"),
        lambda line, place: F.transform(F.filter(words(line), lambda w: w != ""), lambda w: F.struct(place.alias("place"), w.alias("w"))),
    )
    named = texts.select("doc_id", "row", F.flatten(split).alias("all")).where(F.size("all") > 1)
    pairs = sorted({" ".join(r.gram.split(" ")[:2]) for r in grams_.collect()})  # of some hundred grams
    at = lambda i: F.element_at("all", i)
    each = F.transform(
        F.sequence(F.lit(1), F.size("all") - 1),
        lambda i: F.struct(
            i.alias("i"),
            at(i)["place"].alias("place"),
            at(i + 1)["place"].alias("till"),
            F.concat_ws(" ", at(i)["w"], at(i + 1)["w"]).alias("two"),
            F.when(i + 2 <= F.size("all"), at(F.least(i + 2, F.size("all")))["w"]).alias("third"),
        ),
    )
    # A triple begins with a known pair or ends a passage's; other places are left out before rows are made of them.
    each = F.filter(each, lambda e: e["two"].isin(pairs))
    rows = named.select("doc_id", "row", F.explode(each).alias("e")).select("doc_id", "row", "e.i", "e.place", "e.till", "e.two", "e.third")
    rows = rows.select("doc_id", "row", "i", "place", "till", F.explode(F.array("two", F.concat("two", F.lit(" "), "third"))).alias("gram"))
    found = rows.join(F.broadcast(grams_), "gram")
    return stored(found.groupBy("doc_id", "row", "i", "place", "till", "gram").agg(F.count("*").alias("copies")), "licences_hits")


def _passages(texts: DataFrame, model: Model) -> DataFrame:
    """(doc_id, row, place, till, family, margin, overlap, copies) of sentences of templates, wherever they stand, from line place to line till."""
    spark = texts.sparkSession
    given = [(t.family, t.number, len(t.pairs), i, g, t.needs) for t in model.sentences for i, g in enumerate(t.pairs)]
    pairs = spark.createDataFrame(given, "family string, sentence int, pairs int, at int, gram string, needs array<int>")
    weights = spark.createDataFrame(list(model.weights.items()), "gram string, w array<double>")
    hits = _hits(texts, pairs.select("gram").union(weights.select("gram")).distinct())
    # In a sentence that stands in the text, word and place differ by the same number, give or take some words
    # put in or left out. Such differences go by steps of the sentence's length, and by steps half a length on.
    apart, length = F.col("i") - F.col("at"), F.col("pairs") + 1
    steps = F.array(2 * F.floor(apart / length), 2 * F.floor((apart + length / 2) / length) + 1)
    found = hits.join(F.broadcast(pairs), "gram").withColumn("step", F.explode(steps))
    found = found.groupBy("doc_id", "row", "family", "sentence", "pairs", "needs", "step").agg(
        F.collect_set("at").alias("shared"),
        F.array_sort(F.collect_set("i")).alias("held"),
        F.min("place").alias("place"),
        F.max("till").alias("till"),
        F.max("copies").alias("copies"),
    )
    decided = F.size(F.array_except("needs", "shared")) == 0
    found = found.withColumn("overlap", F.size("shared") / F.col("pairs")).where((F.col("overlap") >= CONFIRM) & decided)
    found = found.withColumn("lo", F.element_at("held", 1)).withColumn("hi", F.element_at("held", -1))
    found = found.select("doc_id", "row", "family", "held", "lo", "hi", "place", "till", "copies", "overlap").distinct()
    stretch = lambda lo, hi: F.explode(F.sequence(F.floor(lo / STRETCH), F.floor(hi / STRETCH)))
    # The words of the last pair are the passage's, and so are triples that end with them.
    scored = found.withColumn("stretch", stretch(F.col("lo"), F.col("hi"))).alias("p").join(
        hits.withColumn("stretch", F.floor(F.col("i") / STRETCH)).alias("h"),
        F.expr("p.doc_id <=> h.doc_id AND p.row = h.row AND p.stretch = h.stretch AND h.i BETWEEN p.lo AND p.hi")
        & ((F.col("h.i") < F.col("p.hi")) | (F.size(F.split("h.gram", " ")) == 2)),
    )
    names = [f"p.{c}" for c in found.columns]
    scored = scored.select(*names, "h.gram").distinct().join(F.broadcast(weights), "gram")
    own = F.element_at("w", F.array_position(F.array(*[F.lit(f) for f in model.families]), F.col("family")).cast("int"))
    scored = scored.groupBy(*found.columns).agg(F.sum(own).alias("own"), F.sum(F.col("w")[0]).alias("none"))
    start = F.element_at(F.create_map(*[x for f, b in zip(model.families, model.intercepts, strict=True) for x in (F.lit(f), F.lit(b))]), F.col("family"))
    scored = scored.withColumn("margin", F.col("own") + start - F.col("none") - F.lit(model.intercepts[0])).where(F.col("margin") > model.threshold)
    scored = stored(scored.drop("own", "none"), "licences_passages")
    # Another family's passage that has half the pairs or more of the shorter one.
    spread = lambda: scored.withColumn("stretch", stretch(F.col("lo"), F.col("hi")))
    both = F.size(F.array_intersect("x.held", "y.held"))
    nearer = F.expr("struct(y.overlap, y.margin, y.family) > struct(x.overlap, x.margin, x.family)")
    beaten = spread().alias("x").join(
        spread().alias("y"),
        F.expr("x.doc_id <=> y.doc_id AND x.row = y.row AND x.stretch = y.stretch AND x.family <> y.family")
        & (2 * both >= F.least(F.size("x.held"), F.size("y.held")))
        & nearer,
    )
    beaten = beaten.select("x.doc_id", "x.row", "x.family", "x.held").distinct()
    left = scored.alias("s").join(
        beaten.alias("b"), F.expr("s.doc_id <=> b.doc_id AND s.row = b.row AND s.family = b.family AND s.held = b.held"), "left_anti"
    )
    return left.select("doc_id", "row", "place", "till", "family", "margin", "overlap", "copies")


def scan(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, place, family, margin, overlap, confirmed) of every line that has a weighted gram and isn't unknown,
    of the texts that have a word that decides.

    A line without any weighted gram has the score of its intercepts, which is unknown's.
    Null and empty texts have no lines; equal rows come out as often as they are there.
    Lines are taken whole; ``label`` also finds notices inside lines and over several.
    """
    if not model.weights:
        nothing = "CAST(NULL AS STRING) AS family", "0D AS margin", "0D AS overlap", "false AS confirmed"
        return lines(docs.select("doc_id", "text")).where("false").selectExpr("doc_id", "place", *nothing)
    out = _whole_lines(_texts(docs, model), model).drop("row")
    return out.select(*out.columns[:-1], F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")).drop("copy")


def label(docs: DataFrame, model: Model) -> DataFrame:
    """One row for each doc_id: ``families`` (confirmed ones, sorted; empty: unknown) and ``n_lines`` that show them.

    A notice that runs over several lines shows on the one it begins on, and on those that
    would show its family alone. Rows of one doc_id count as one document; null ids as one, too. An
    empty table gives no rows. Columns other than doc_id and text are not read.
    """
    every = docs.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    if not model.weights:
        return every.select("doc_id", F.array().cast("array<string>").alias("families"), F.lit(0).cast("long").alias("n_lines"))
    texts = _texts(docs, model)
    names = ["doc_id", "row", "place", "family", "copies"]
    passages = stored(_passages(texts, model), "licences_left")
    # A line that is part of a passage may look like another family by itself.
    covered = passages.select("doc_id", "row", F.explode(F.sequence("place", "till")).alias("place"), "family")
    covered = covered.groupBy("doc_id", "row", "place").agg(F.collect_set("family").alias("there"))
    whole = _whole_lines(texts, model).where("confirmed").alias("l").join(
        covered.alias("c"), F.expr("l.doc_id <=> c.doc_id AND l.row = c.row AND l.place = c.place AND NOT array_contains(c.there, l.family)"), "left_anti"
    )
    shown = whole.select(*names).unionByName(passages.select(*names))
    shown = shown.groupBy("doc_id", "row", "place").agg(F.collect_set("family").alias("families"), F.max("copies").alias("copies"))
    hits = shown.groupBy("doc_id").agg(
        F.sort_array(F.array_distinct(F.flatten(F.collect_set("families")))).alias("families"), F.sum("copies").alias("n_lines")
    )
    out = every.alias("d").join(hits.alias("h"), F.expr("d.doc_id <=> h.doc_id"), "left")
    return out.select(
        "d.doc_id",
        F.coalesce("families", F.array().cast("array<string>")).alias("families"),
        F.coalesce("n_lines", F.lit(0)).alias("n_lines"),
    )
