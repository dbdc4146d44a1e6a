"""Texts as sets of word shingles: classes of equal sets, links confirmed on full sets, components.

What the two similarity joins have in common. A class is known by a 128-bit name that its
set has in every task and run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import blocks
from .stored import stored

#: A null id is the largest.
NO_ID = (1 << 63) - 1
#: Rows that are looked up by broadcasting their hashes, of 8 bytes each, so that texts stay where they are;
#: more are looked up by a join of two shuffled sides.
BROADCAST_ROWS = 1_000_000
NAMED = "doc_id long, row long, n long, name binary"
#: Parity bits of a full set, 64 to a column: pairs that they show to be too unlike need no full sets.
WIDE = [f"w{i}" for i in range(16)]
SETS = "name binary, shingles array<long>, " + ", ".join(f"{w} long" for w in WIDE)


def distinct_shingles(block: blocks.Block, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of each text's distinct shingles in ascending order, the text of each, and where texts start."""
    hashes, at = blocks.shingles(block, k)
    text = np.repeat(np.arange(block.n), np.diff(at))
    order = np.lexsort((hashes, text))
    hashes, text = hashes[order], text[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    hashes, text = hashes[new], text[new]
    return hashes, text, np.searchsorted(text, np.arange(block.n + 1))


def set_names(hashes: np.ndarray, edges: np.ndarray) -> pa.Array:
    """Two sums over a set name it: 128 bits, so that no two sets of a large corpus share a name."""
    names = []
    for salt in (0x5851F42D4C957F2D, 0x14057B7EF767814F):
        total = np.append(np.uint64(0), np.cumsum(blocks.mix(hashes ^ np.uint64(salt)), dtype=np.uint64))
        names.append(blocks.mix(total[edges[1:]] - total[edges[:-1]] + np.diff(edges).astype(np.uint64)))
    name = np.stack(names, axis=1).astype("<u8").tobytes()
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(edges) - 1, [None, pa.py_buffer(name)]).cast(pa.binary())


def _named(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, block in blocks.arrow_blocks(batch.column(2)):
            hashes, _, edges = distinct_shingles(block, k)
            given = [c.slice(lo, hi - lo) for c in batch.columns[:2]]
            yield pa.record_batch([*given, pa.array(np.diff(edges), pa.int64()), set_names(hashes, edges)], ["doc_id", "row", "n", "name"])


def _full(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, _, block in blocks.arrow_blocks(batch.column(0)):
            hashes, _, edges = distinct_shingles(block, k)
            yield pa.record_batch([set_names(hashes, edges), blocks.list_array(hashes.view(np.int64), edges)], ["name", "shingles"])


def _sketched(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """``_full`` with parity bits: each shingle flips one, so each unlike bit of two sets is an unlike shingle."""
    for batch in _full(batches, k):
        sets = batch.column(1)
        edges = np.asarray(sets.offsets).astype(np.int64)
        hashes = np.asarray(sets.values).view(np.uint64)[edges[0]:edges[-1]]
        bit = (blocks.mix(hashes ^ np.uint64(0xD6E8FEB86659FD93)) % np.uint64(64 * len(WIDE))).astype(np.int64)
        words = np.zeros((batch.num_rows, len(WIDE)), np.uint64)
        of = np.repeat(np.arange(batch.num_rows), np.diff(edges))
        np.bitwise_xor.at(words, (of, bit >> 6), np.uint64(1) << (bit & 63).astype(np.uint64))
        wide = [pa.array(words[:, i].copy().view(np.int64)) for i in range(len(WIDE))]
        yield pa.record_batch([*batch.columns, *wide], ["name", "shingles", *WIDE])


def only_text(docs: DataFrame) -> DataFrame:
    """doc_id and text alone, whatever else the table holds."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def named_rows(docs: DataFrame, k: int, label: str) -> DataFrame:
    """doc_id, row (a hash of id and text), n (set size) and name of the set, of every row; stored."""
    keyed = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("row"), "text")
    return stored(keyed.mapInArrow(lambda b: _named(b, k), NAMED), f"{label}_rows")


def classes_of(rows: DataFrame, label: str) -> DataFrame:
    """name, n, label (the least id, and the name) and holder (one row that has the set) of each set; stored."""
    order = F.coalesce("doc_id", F.lit(NO_ID))
    found = rows.where("n > 0").groupBy("name").agg(F.min(F.struct(order.alias("label"), "row", "n")).alias("f"))
    return stored(found.select("name", F.struct("f.label", "name").alias("label"), F.col("f.row").alias("holder"), "f.n"), f"{label}_classes")


def pair(a: str, b: str) -> list:
    """Names and set sizes of two sides of a join, the least name first."""
    sides = [F.struct(f"{x}.name", f"{x}.n") for x in (a, b)]
    low, high = F.least(*sides), F.greatest(*sides)
    return [low["name"].alias("a"), high["name"].alias("b"), low["n"].alias("n_a"), high["n"].alias("n_b")]


def confirmed(pairs: DataFrame, classes: DataFrame, docs: DataFrame, k: int, percent: int, label: str) -> DataFrame:
    """Each pair (a, b, n_a, n_b) once, and whether its full sets link it; stored."""
    pairs = pairs.groupBy("a", "b").agg(F.first("n_a").alias("n_a"), F.first("n_b").alias("n_b"))
    pairs = stored(pairs, f"{label}_pairs")
    # One document of each class that is in a pair gives the full set.
    asked = pairs.select("a").union(pairs.select("b")).distinct().toDF("name")
    holders = stored(classes.join(asked, "name").select("holder"), f"{label}_holders")
    if holders.count() <= BROADCAST_ROWS:
        holders = F.broadcast(holders)
    texts = docs.select(F.xxhash64("doc_id", "text").alias("holder"), "text").join(holders, "holder", "left_semi")
    # Sets that nobody asked for meet no pair below, so they need not be taken out here.
    sets = stored(texts.select("text").mapInArrow(lambda b: _sketched(b, k), SETS), f"{label}_sets")
    # Unlike bits are at most the unlike shingles, so no link is lost; only the other pairs take full sets along.
    wide = sets.groupBy("name").agg(*[F.first(w).alias(w) for w in WIDE])
    sides = pairs.join(wide.toDF("b", *[f"b_{w}" for w in WIDE]), "b").join(wide.toDF("a", *[f"a_{w}" for w in WIDE]), "a")
    flipped = [F.bit_count(F.col(f"a_{w}").bitwiseXOR(F.col(f"b_{w}"))) for w in WIDE]
    possible = (100 + percent) * sum(flipped[1:], flipped[0]) <= (100 - percent) * (F.col("n_a") + F.col("n_b"))
    sides = stored(sides.select("a", "b", "n_a", "n_b", possible.alias("possible")), f"{label}_possible")
    sets = sets.groupBy("name").agg(F.first("shingles").alias("shingles"))
    with_both = sides.where("possible").join(sets.toDF("b", "set_b"), "b").join(sets.toDF("a", "set_a"), "a")
    shared = F.size(F.array_intersect("set_a", "set_b"))
    linked = 100 * F.col("shared") >= percent * (F.col("n_a") + F.col("n_b") - F.col("shared"))
    measured = with_both.withColumn("shared", shared).select("a", "b", linked.alias("linked"))
    return stored(measured.unionByName(sides.where("NOT possible").select("a", "b", F.lit(False).alias("linked"))), f"{label}_measured")


def components(vertices: DataFrame, links: DataFrame) -> DataFrame:
    """(name, label): the least ``label`` that the links (a, b) reach from each vertex that has any.

    A label ends with its vertex's name. Each round every vertex takes the least label
    beside it, then the label that this label's vertex has. Ends when nothing changes.
    """
    ends = stored(links.select("a", "b").union(links.select("b", "a")), "near_ends")
    now = stored(ends.select(F.col("a").alias("name")).distinct().join(vertices, "name").select("name", "label"), "near_labels")
    while True:
        beside = ends.join(now.toDF("b", "near"), "b").groupBy("a").agg(F.min("near").alias("near"))
        step = now.join(beside.toDF("name", "near"), "name")
        step = stored(step.select("name", F.col("label").alias("old"), F.least("label", "near").alias("label")), "near_step")
        owner = step.select(F.col("name").alias("owner"), F.col("label").alias("further"))
        jumped = step.join(owner, F.col("label.name") == F.col("owner"))
        jumped = stored(jumped.select("name", "old", F.least("label", "further").alias("label")), "near_labels")
        now = jumped.select("name", "label")
        if jumped.where("label < old").isEmpty():
            return now


def labelled(vertices: DataFrame, labels: DataFrame) -> DataFrame:
    """Every vertex with its label: its own if ``labels`` has none."""
    placed = vertices.join(labels.withColumnRenamed("label", "found"), "name", "left")
    return stored(placed.select("name", F.coalesce("found", "label").alias("label")), "near_classed")


def joined_components(vertices: DataFrame, placed: DataFrame, links: DataFrame) -> DataFrame:
    """``placed`` after links that join whole components, each named by its label's class."""
    part = placed.select("name", F.col("label.name").alias("part"))
    joined = links.select("a", "b").join(part.toDF("a", "part_a"), "a").join(part.toDF("b", "part_b"), "b")
    wider = components(vertices, joined.select(F.col("part_a").alias("a"), F.col("part_b").alias("b")).where("a <> b").distinct())
    wider = wider.select(F.col("name").alias("part"), F.col("label").alias("found"))
    classed = placed.join(wider, F.col("label.name") == F.col("part"), "left")
    return classed.select("name", F.coalesce("found", "label").alias("label"))


def outcome(rows: DataFrame, placed: DataFrame) -> DataFrame:
    """doc_id, row, n_shingles and component_id of every row."""
    out = rows.join(placed.select("name", "label.label"), "name", "left")
    found = F.when(F.col("n") == 0, F.col("doc_id")).when(F.col("label") < NO_ID, F.col("label"))
    return out.select("doc_id", "row", F.col("n").alias("n_shingles"), found.alias("component_id"))
