"""Near-duplicates by a chosen-path set similarity join.

A text is the set of its word shingles. Texts with equal sets form a class, and the
classes are joined. Each class has ``COORDINATES`` minwise tokens (one-permutation
MinHash with optimal densification). In each of ``TREES`` independent trees all classes
start in one node; a node chooses a coordinate or two by a hash of its path (1.25 of them
on average, one over the similarity), and a class goes to the child that its token names.
So classes as similar as the threshold stay together in about one child per node, and
unlike ones part. Nodes of one class end. Nodes of at most ``SMALL`` classes, and those of
depth ``DEPTH``, are leaves; larger ones branch on. There are as many trees as it takes for
a pair at the threshold to share a leaf of that depth with probability ``RECALL``; ``lost``
counts in that all trees draw from the same tokens, which may agree less than the sets do.

All classes of a small leaf are paired with each other. In a large one, which holds copies
by the hundred, every class is first paired with one pivot, the class that the most others
have stayed with; then what is outside the leaf's largest component is paired with what is in
other components. A pair is made in one leaf only, the least that both are in, however many
trees bring it together. So copies by the thousand cost a few pairs each, and no link that
would join two components is skipped. Sketches pass over pairs that are far from alike: four
bits of each token, by chance far below the chance of missing a leaf, and a parity sketch, in which
each unlike bit is an unlike shingle. Links are confirmed on the full sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import blocks, fingerprints
from .classes import NO_ID, components, confirmed, distinct_shingles, joined_components, labelled, only_text, outcome, pair, set_names
from .stored import stored

COORDINATES = 64
#: Of pairs at the threshold, the share that meets in a leaf at least, also where all nodes go down to ``DEPTH``.
RECALL = 0.9999
SIMILAR = 0.8
SMALL = 12
DEPTH = 4
#: Pairs whose tokens agree in less than this share are passed over, if both sets have
#: ``SKETCHED`` shingles or more: at the threshold that would be five standard errors off.
SKETCH = 0.58
SKETCHED = 64
#: Of the nodes, those that choose two coordinates.
TWICE = 0.25
#: Classes of a large leaf that one task compares: a larger leaf is dealt into parts, and who meets all of it goes to each.
PART_ROWS = 2_000
SKETCHES = [f"s{i}" for i in range(4)]
PARITY = [f"p{i}" for i in range(4)]
FACTS = ["n", *SKETCHES, *PARITY]


def lost(trees: int, depth: int, similarity: float = SIMILAR) -> float:
    """The chance that no tree has two sets together at ``depth``, over all shares of tokens they may agree in."""
    n, total = COORDINATES, 0.0
    for agree in range(n + 1):
        a, apart = agree / n, 0.0
        for _ in range(depth):
            child = 1 - a + a * apart
            apart = (1 - TWICE) * child + TWICE * child**2
        total += math.comb(n, agree) * similarity**agree * (1 - similarity) ** (n - agree) * apart**trees
    return total


TREES = next(t for t in range(1, 1000) if lost(t, DEPTH) <= 1 - RECALL)


ROWS = "doc_id long, row long, n long, name binary, tokens array<int>, " + ", ".join(f"{s} long" for s in [*SKETCHES, *PARITY])


def _sets(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Set size, name of the set, its tokens and its sketches, of each text."""
    for batch in batches:
        for lo, hi, block in blocks.arrow_blocks(batch.column(2)):
            hashes, text, edges = distinct_shingles(block, k)
            table = np.full(block.n * COORDINATES, fingerprints._NONE)
            row = text * COORDINATES + (hashes % np.uint64(COORDINATES)).astype(np.int64)
            np.minimum.at(table, row, hashes)
            table = fingerprints.densify(table.reshape(block.n, COORDINATES))
            values = (table >> np.uint64(24)).astype(np.uint32).view(np.int32).ravel()
            bits = ((table >> np.uint64(24)) & np.uint64(15)).reshape(block.n, 4, 16) << (np.uint64(4) * np.arange(16, dtype=np.uint64))
            bits = np.bitwise_or.reduce(bits, axis=2).view(np.int64)
            # Each shingle flips one of 256 bits.
            spread = blocks.mix(hashes ^ np.uint64(0xA0761D6478BD642F))
            flips = np.zeros((len(hashes) + 1, 4), np.uint64)
            flips[np.arange(1, len(hashes) + 1), (spread >> np.uint64(6)) & np.uint64(3)] = np.uint64(1) << (spread & np.uint64(63))
            flips = np.bitwise_xor.accumulate(flips, axis=0)
            parity = (flips[edges[1:]] ^ flips[edges[:-1]]).view(np.int64)
            given = [c.slice(lo, hi - lo) for c in batch.columns[:2]]
            tokens = blocks.list_array(values, np.arange(block.n + 1) * COORDINATES)
            sketches = [pa.array(x[:, i].copy()) for x in (bits, parity) for i in range(4)]
            yield pa.record_batch(
                [*given, pa.array(np.diff(edges), pa.int64()), set_names(hashes, edges), tokens, *sketches],
                ["doc_id", "row", "n", "name", "tokens", *SKETCHES, *PARITY],
            )


def _alike(a: str, b: str, percent: int):
    """Whether the classes of two sides of a join may be similar enough, by set sizes and sketches."""
    unlike = []
    for s in SKETCHES:
        x = F.col(f"{a}.{s}").bitwiseXOR(F.col(f"{b}.{s}"))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
        unlike.append(F.bit_count(x.bitwiseAND(F.lit(0x1111111111111111))))
    flipped = [F.bit_count(F.col(f"{a}.{p}").bitwiseXOR(F.col(f"{b}.{p}"))) for p in PARITY]
    n_a, n_b = F.col(f"{a}.n"), F.col(f"{b}.n")
    fewer = F.least(n_a, n_b)
    near = (fewer < SKETCHED) | (sum(unlike[1:], unlike[0]) <= int((1 - SKETCH) * COORDINATES))
    possible = (100 + percent) * sum(flipped[1:], flipped[0]) <= (100 - percent) * (n_a + n_b)
    return near & possible & (100 * fewer >= percent * F.greatest(n_a, n_b))


def _once(a: str, b: str):
    """Whether this leaf is the least of those that both classes are in."""
    return F.array_min(F.array_intersect(f"{a}.nodes", f"{b}.nodes")) == F.col(f"{a}.node")


def _branch(members: DataFrame, level: int) -> DataFrame:
    """Children of the nodes: (node, name, tokens) for each coordinate that the node chooses."""
    draw = lambda salt: F.xxhash64(F.lit(salt), F.col("node"))
    one = F.pmod(draw(2 * level), F.lit(COORDINATES)).cast("int")
    other = F.pmod(draw(2 * level + 1), F.lit(COORDINATES)).cast("int")
    # A second coordinate for a quarter of the nodes.
    chosen = F.when(F.pmod(draw(-1 - level), F.lit(round(1 / TWICE))) == 0, F.array_distinct(F.array(one, other))).otherwise(F.array(one))
    spread = members.withColumn("c", F.explode(chosen))
    node = F.xxhash64("node", "c", F.element_at("tokens", F.col("c") + 1))
    return spread.withColumn("node", node).drop("c")


def _leaves(classes: DataFrame) -> DataFrame:
    """(node, name, size, nodes, facts of the class) of all leaves with more than one class.

    ``nodes``: the leaves of the same kind, small or large, that the class is in.
    """
    facts = classes.select("name", *FACTS)
    trees = F.explode(F.array(*[F.xxhash64(F.lit(1000 + t)) for t in range(TREES)]))
    members = classes.select(trees.alias("node"), "name", "tokens")
    # The first level is by far the largest, so tokens stay behind: only what shares a node gets them back.
    members = _branch(members, 0).select("node", "name")
    classes = classes.select("name", "tokens")
    found = []
    for level in range(1, DEPTH + 1):
        # Dealt out once, for the sizes (names are never null, and counting them takes the same columns) and for the join.
        members = members.repartition("node")
        sizes = members.groupBy("node").agg(F.count("name").alias("size")).where("size > 1")
        members = stored(members.join(sizes, "node"), f"near_level{level}")
        leaf = F.col("size") <= SMALL
        if level == DEPTH:
            found.append(members)
            break
        found.append(members.where(leaf))
        active = members.where(~leaf).drop("size")
        if active.isEmpty():
            break
        # Few classes are in large nodes, and deeper nodes have no others.
        branching = active.select("name").distinct()
        classes = stored(classes.join(branching, "name", "left_semi"), f"near_active{level}")
        members = _branch(active.join(classes, "name"), level).select("node", "name")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    out = stored(out.select("node", "name", "size", (F.col("size") > SMALL).alias("large")), "near_placed_leaves")
    out = out.repartition("name", "large")
    # A few dozen leaves a class: as many as all trees have for it.
    own = out.groupBy("name", "large").agg(F.collect_set("node").alias("nodes"), F.sum("size").alias("met"))
    return stored(out.join(own, ["name", "large"]).join(facts, "name"), "near_leaves")


def _within(leaves: DataFrame, percent: int) -> DataFrame:
    """All pairs of small leaves that may be linked, each in one leaf."""
    same = (F.col("x.node") == F.col("y.node")) & (F.col("x.name") < F.col("y.name"))
    return leaves.alias("x").join(leaves.alias("y"), same & _alike("x", "y", percent) & _once("x", "y")).select(*pair("x", "y"))


def _parts():
    return F.ceil(F.col("size") / PART_ROWS)


def _part():
    return F.pmod(F.xxhash64("name"), _parts())


def _every_part():
    return F.explode(F.sequence(F.lit(0).cast("long"), _parts() - 1))


def _star(leaves: DataFrame, percent: int) -> DataFrame:
    """Each class of a large leaf with the leaf's pivot."""
    pivots = leaves.groupBy("node").agg(F.max(F.struct("met", F.xxhash64("name").alias("h"), "name", "size", *FACTS)).alias("p"))
    pivots = pivots.select("node", *[F.col(f"p.{c}").alias(c) for c in ("name", "size", *FACTS)])
    same = (F.col("x.node") == F.col("y.node")) & (F.col("x.part") == F.col("y.part")) & (F.col("x.name") != F.col("y.name"))
    star = leaves.withColumn("part", _part()).alias("x").join(pivots.withColumn("part", _every_part()).alias("y"), same & _alike("x", "y", percent))
    return star.select(*pair("x", "y"))


def _across(leaves: DataFrame, placed: DataFrame, percent: int) -> DataFrame:
    """What is outside of a large leaf's largest component, with what is in its other components."""
    parts = stored(leaves.join(placed.select("name", F.col("label.name").alias("of")), "name"), "near_parts")
    counts = parts.groupBy("node", "of").agg(F.count("*").alias("m"))
    largest = counts.groupBy("node").agg(F.max(F.struct("m", "of")).alias("top"), F.count("*").alias("several")).where("several > 1")
    mixed = parts.join(largest, "node").withColumn("main", F.col("of") == F.col("top.of")).drop("top", "several", "met")
    mixed = stored(mixed.withColumn("part", _part()), "near_mixed")
    outside = mixed.where("NOT main").withColumn("part", _every_part())
    same = (F.col("x.node") == F.col("y.node")) & (F.col("x.part") == F.col("y.part"))
    # Of two components at most one is the largest, so one of the pair is outside in any leaf of both.
    apart = (F.col("x.of") != F.col("y.of")) & (F.col("y.main") | (F.col("x.name") < F.col("y.name")))
    apart = apart & _alike("x", "y", percent) & _once("x", "y")
    return outside.alias("x").join(mixed.alias("y"), same & apart).select(*pair("x", "y"))


def join(docs: DataFrame, k: int = 4, percent: int = 80) -> DataFrame:
    """doc_id, row, n_shingles and component_id of every row.

    Texts are linked if 100 * intersection >= ``percent`` * union of their sets of ``k``-word
    shingles, A-Z as a-z; shorter texts are one shingle; texts without words (null, empty)
    are linked with nothing. component_id is the least doc_id that is reached; null ids count
    as the largest, and a component of nothing else has a null id. Repeated rows and equal
    texts are in one class and so in one component. An empty table gives no rows. Only
    doc_id and text are read; ``row`` is a hash of both.
    """
    docs = only_text(docs)
    keyed = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("row"), "text")
    rows = stored(keyed.mapInArrow(lambda b: _sets(b, k), ROWS), "near_rows")
    order = F.coalesce("doc_id", F.lit(NO_ID))
    # Equal sets have equal tokens, so any will do; the holder is one row that has the set.
    classes = rows.where("n > 0").groupBy("name").agg(F.min(F.struct(order.alias("label"), "row", "tokens", *FACTS)).alias("f"))
    classes = stored(
        classes.select("name", F.struct("f.label", "name").alias("label"), F.col("f.row").alias("holder"), *[f"f.{c}" for c in ("tokens", *FACTS)]),
        "near_classes",
    )
    leaves = _leaves(classes)
    vertices = classes.select("name", "label")
    small, large = leaves.where("NOT large"), leaves.where("large")
    first = _within(small, percent).unionByName(_star(large, percent))
    measured = confirmed(first, classes, docs, k, percent, "near_first")
    placed = labelled(vertices, components(vertices, measured.where("linked")))
    new = _across(large, placed, percent).join(measured.select("a", "b"), ["a", "b"], "left_anti")
    more = confirmed(new, classes, docs, k, percent, "near_across").where("linked")
    return outcome(rows, joined_components(vertices, placed, more))


def keep(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """One document of each component, with all its columns: the one with the least doc_id.

    Rows equal in doc_id and text stay together; a component without any id stays whole.
    """
    names = docs.columns
    joined = join(docs, k, percent)
    chosen = joined.where("component_id IS NULL OR doc_id = component_id").select("row").distinct()
    rows = docs.select(
        F.struct(*[F.col(f"`{n}`") for n in names]).alias("all"),
        F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string")).alias("row"),
    )
    return rows.join(chosen, "row", "left_semi").select(*[F.col("all").getField(n).alias(n) for n in names])
