"""N-gram Jaccard join by rare-first prefix filtering.

Each text is the set of its word n-grams, ordered by how many texts of the whole table hold
them, the rarest first (ties by hash). Two sets that are similar enough share one of the first
``n - need + 1`` n-grams of each, the prefix; n-grams that only one text holds take up most of a
prefix and are met by nobody, so little is left to join. Sets that share a prefix n-gram pass
the length filter, the positional filter (what can still be shared from there on) and the
suffix filter (what differs from there on, at least: n-grams behind the shared one flip the bits
of a parity sketch, and each unlike bit is an unlike n-gram). None of these loses a link. Pairs
that pass are compared once, on their full sets.

How many texts hold an n-gram is counted block by block: a block of texts names each of its
n-grams once, in the order of their hashes; one task counts a range of hashes and answers each
block with those that occur elsewhere too. Texts don't move, and neither does what is unique.

In a list of many sets, copies by the hundred, all sets are first compared with the one that
has the shared n-gram earliest, which is the least edited. Those that are then outside of the
list's largest component are joined with what is in other components. So a group of any size
costs a few comparisons a set, and no link that would join two components is skipped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from . import blocks
from .classes import classes_of, components, confirmed, distinct_shingles, joined_components, labelled, named_rows, only_text, outcome, pair, set_names
from .encoding import packed, unpacked
from .stored import stored

#: Bytes of text in a block.
BLOCK_TEXT = 6 << 20
#: N-grams that a task counts at once, about.
RANGE_KEYS = 2_000_000
#: Sets of a list that are all compared with each other.
SMALL = 8
#: Sets of a long list that one task compares: a longer list is dealt into parts, and who meets all of it goes to each.
PART_ROWS = 2_000
SKETCH = [f"p{i}" for i in range(4)]


def _text_blocks(batches: Iterator[pa.RecordBatch], k: int, ranges: int) -> Iterator[tuple]:
    """Blocks of a task's texts: a name that shows from what it was made, the set names, each text's
    n-grams as places in the block's sorted distinct n-grams, and where each range of those starts."""
    part, number = TaskContext.get().partitionId(), 0
    starts = np.array([-(-(r << 64) // ranges) for r in range(ranges)], dtype=np.uint64)
    for batch in batches:
        column = batch.column(0).cast(pa.large_binary()).fill_null(b"")
        sizes = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False))
        lo = 0
        while lo < len(column):
            before = sizes[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(sizes, before + BLOCK_TEXT, side="right")))
            names, hashes, counts = [], [], []
            for _, _, block in blocks.arrow_blocks(column.slice(lo, hi - lo)):
                own, _, edges = distinct_shingles(block, k)
                names.append(set_names(own, edges))
                hashes.append(own)
                counts.append(np.diff(edges))
            every = np.concatenate(hashes)
            keys, place = np.unique(every, return_inverse=True)
            bounds = np.append(np.searchsorted(keys, starts), len(keys))
            mark = int(blocks.mix(np.array([np.bitwise_xor.reduce(keys) if len(keys) else 0], np.uint64))[0]) ^ len(every)
            yield f"{part}-{number}-{mark:x}", pa.concat_arrays(names), np.concatenate(counts), keys, place, bounds
            number += 1
            lo = hi


def _packed_planes(values: np.ndarray, kind: str) -> bytes:
    return _planes(values, kind)[0].as_py()


def _planes(values: np.ndarray, kind: str) -> pa.Array:
    # First bytes, second bytes and so on apart: they compress better than mixed.
    size = int(kind[2])
    return packed(values.astype(kind).view(np.uint8).reshape(-1, size).T.tobytes())


def _from_planes(raw: bytes, kind: str) -> np.ndarray:
    planes = np.frombuffer(unpacked(raw), np.uint8).reshape(int(kind[2]), -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _asked(batches: Iterator[pa.RecordBatch], k: int, ranges: int) -> Iterator[pa.RecordBatch]:
    for name, _, _, keys, place, bounds in _text_blocks(batches, k, ranges):
        held = np.bincount(place, minlength=len(keys))
        some = np.flatnonzero(np.diff(bounds)).tolist()
        # One batch a block, a row for each range that it has n-grams of.
        cut = [slice(bounds[r], bounds[r + 1]) for r in some]
        columns = [
            pa.array([name] * len(some)),
            pa.array(some, pa.int32()),
            pa.array([_packed_planes(keys[c], "<u8") for c in cut], pa.binary()),
            pa.array([_packed_planes(held[c], "<u4") for c in cut], pa.binary()),
        ]
        yield pa.record_batch(columns, ["block", "range", "keys", "held"])


def _counted(table: pa.Table) -> pa.Table:
    """Of each block's n-grams of one range: those that several texts of the table hold."""
    keys = [_from_planes(raw.as_py(), "<u8") for raw in table.column("keys")]
    held = np.concatenate([_from_planes(raw.as_py(), "<u4") for raw in table.column("held")]).astype(np.int64)
    every = np.concatenate(keys)
    order = np.argsort(every, kind="stable")
    every = every[order]
    first = np.flatnonzero(np.append(True, every[1:] != every[:-1]))
    total = np.empty(len(every), np.int64)
    total[order] = np.repeat(np.add.reduceat(held[order], first), np.diff(np.append(first, len(every))))
    edges = np.append(0, np.cumsum([len(x) for x in keys]))
    out = {"block": table.column("block"), "range": table.column("range"), "which": [], "keys": [], "held": []}
    for own, lo, hi in zip(keys, edges[:-1], edges[1:], strict=True):
        which = np.flatnonzero(total[lo:hi] > 1)
        out["which"].append(_packed_planes(which, "<u4"))
        out["keys"].append(_packed_planes(own[which], "<u8"))
        out["held"].append(_packed_planes(total[lo:hi][which], "<u8"))
    return pa.table({c: pa.array(v, pa.binary()) if c in ("which", "keys", "held") else v for c, v in out.items()})


def _places(batches: Iterator[pa.RecordBatch], k: int, ranges: int) -> Iterator[pa.RecordBatch]:
    for name, names, counts, _, place, bounds in _text_blocks(batches, k, ranges):
        # Places ascend within a text, so the steps between them are small.
        steps = np.diff(place, prepend=0)
        row = [[name], pa.ListArray.from_arrays(pa.array([0, len(names)], pa.int32()), names), _planes(counts, "<u4"), _planes(steps, "<i4"), _planes(bounds, "<u4")]
        yield pa.record_batch(row, ["block", "names", "counts", "steps", "bounds"])


def prefix_length(n: np.ndarray, percent: int) -> np.ndarray:
    """N-grams of a set of ``n`` among which it shares one with every set as similar as the threshold."""
    return n - -(-percent * n // 100) + 1


def _prefixes(asked: pa.Table, got: pa.Table, percent: int) -> pa.Table:
    if asked.num_rows != 1:
        raise ValueError("the documents were read in another order the second time; store them first")
    one = asked.to_pylist()[0]
    counts, bounds = _from_planes(one["counts"], "<u4").astype(np.int64), _from_planes(one["bounds"], "<u4").astype(np.int64)
    place = np.cumsum(_from_planes(one["steps"], "<i4").astype(np.int64))
    held, keys = np.ones(bounds[-1], np.int64), np.zeros(bounds[-1], np.uint64)
    for r, which, own, total in zip(*(got.column(c).to_pylist() for c in ("range", "which", "keys", "held")), strict=True):
        at = bounds[r] + _from_planes(which, "<u4")
        held[at], keys[at] = _from_planes(total, "<u8"), _from_planes(own, "<u8")
    text = np.repeat(np.arange(len(counts)), counts)
    # N-grams of this text alone come first; what follows is ranked by its count, then its hash.
    met = held[place] > 1
    single = counts - np.bincount(text[met], minlength=len(counts))
    limit = prefix_length(counts, percent)
    met &= (single < limit)[text]
    text, place = text[met], place[met]
    order = np.lexsort((place, held[place], text))
    text, place = text[order], place[order]
    first = np.searchsorted(text, np.arange(len(counts) + 1))
    position = single[text] + np.arange(len(text)) - first[text]
    key = keys[place]
    bits = blocks.mix(key ^ np.uint64(0xA0761D6478BD642F))
    sketch = np.zeros((len(key), 4), np.uint64)
    sketch[np.arange(len(key)), (bits >> np.uint64(6)) & np.uint64(3)] = np.uint64(1) << (bits & np.uint64(63))
    sketch = np.bitwise_xor.accumulate(sketch, axis=0) if len(key) else sketch
    behind = sketch[first[text + 1] - 1] ^ sketch if len(key) else sketch
    out = np.flatnonzero(position < limit[text])
    names = pa.array(one["names"], pa.binary())
    return pa.table(
        {
            "node": pa.array(key[out].view(np.int64)),
            "name": names.take(pa.array(text[out])),
            "n": pa.array(counts[text[out]], pa.int64()),
            "pos": pa.array(position[out], pa.int64()),
            "alone": pa.array(single[text[out]], pa.int64()),
            **{s: pa.array(behind[out, i].view(np.int64)) for i, s in enumerate(SKETCH)},
        }
    )


def prefixes(docs: DataFrame, rows: DataFrame, k: int, percent: int) -> DataFrame:
    """(node, name, n, pos, sketch of what is behind) of each class and prefix n-gram that others may share."""
    ranges = max(1, -(-(rows.agg(F.sum("n")).first()[0] or 0) // RANGE_KEYS))
    texts = docs.select("text")
    asked = texts.mapInArrow(lambda b: _asked(b, k, ranges), "block string, range int, keys binary, held binary")
    counted = asked.groupBy("range").applyInArrow(_counted, "block string, range int, which binary, keys binary, held binary")
    places = texts.mapInArrow(lambda b: _places(b, k, ranges), "block string, names array<binary>, counts binary, steps binary, bounds binary")
    schema = "node long, name binary, n long, pos long, alone long, " + ", ".join(f"{s} long" for s in SKETCH)
    found = places.groupBy("block").cogroup(counted.withColumnRenamed("block", "asker").groupBy("asker")).applyInArrow(
        lambda a, g: _prefixes(a, g, percent), schema
    )
    # Equal texts have equal prefixes: one row for each class.
    found = found.groupBy("node", "name").agg(*[F.first(c).alias(c) for c in ("n", "pos", "alone", *SKETCH)])
    return stored(found, "jaccard_prefixes")


def may_link(a: str, b: str, percent: int) -> Column:
    """Length, positional and suffix filter for two rows of one list.

    ``alone`` n-grams of a set, which no other text holds, come first and are unlike in any case.
    """
    n_a, n_b, p_a, p_b, s_a, s_b = (F.col(f"{x}.{c}") for c in ("n", "pos", "alone") for x in (a, b))
    length = 100 * F.least(n_a, n_b) >= percent * F.greatest(n_a, n_b)
    # Shared at most: as many as either has before, the n-gram itself, as many as either has behind.
    most = F.least(p_a - s_a, p_b - s_b) + 1 + F.least(n_a - p_a, n_b - p_b) - 1
    positional = (100 + percent) * most >= percent * (n_a + n_b)
    flipped = [F.bit_count(F.col(f"{a}.{s}").bitwiseXOR(F.col(f"{b}.{s}"))) for s in SKETCH]
    # Unlike at least: what is alone, how many more either has before, and the unlike bits of what is behind.
    unlike = s_a + s_b + F.abs((p_a - s_a) - (p_b - s_b)) + sum(flipped[1:], flipped[0])
    suffix = (100 + percent) * unlike <= (100 - percent) * (n_a + n_b)
    return length & positional & suffix


def linked(members: DataFrame, classes: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """(name, label) of every class: the least label that links reach, over all pairs that share a list."""
    sizes = members.groupBy("node").agg(F.count("*").alias("size")).where("size > 1")
    members = stored(members.join(sizes, "node"), "jaccard_members")
    small, large = members.where(F.col("size") <= SMALL), members.where(F.col("size") > SMALL)
    same = F.col("x.node") == F.col("y.node")
    within = small.alias("x").join(small.alias("y"), same & (F.col("x.name") < F.col("y.name")) & may_link("x", "y", percent))
    # Of a long list, the set that has the n-gram earliest; its copies go to all parts of the list.
    parts = F.ceil(F.col("size") / PART_ROWS)
    part, every_part = F.pmod(F.xxhash64("name"), parts), F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))
    dealt = large.withColumn("part", part)
    least = large.groupBy("node").agg(F.min(F.struct("pos", F.xxhash64("name").alias("h"), "name", "n", "alone", "size", *SKETCH)).alias("p"))
    least = least.select("node", *[F.col(f"p.{c}").alias(c) for c in ("name", "n", "pos", "alone", "size", *SKETCH)])
    copied = least.withColumn("part", every_part)
    star = dealt.alias("x").join(
        copied.alias("y"), same & (F.col("x.part") == F.col("y.part")) & (F.col("x.name") != F.col("y.name")) & may_link("x", "y", percent)
    )
    first = within.select(*pair("x", "y")).unionByName(star.select(*pair("x", "y")))
    measured = confirmed(first, classes, docs, k, percent, "jaccard_first")
    vertices = classes.select("name", "label")
    placed = labelled(vertices, components(vertices, measured.where("linked")))
    # What is outside of a long list's largest component, with what is in others.
    found = stored(large.join(placed.select("name", F.col("label.name").alias("of")), "name"), "jaccard_parts")
    counts = found.groupBy("node", "of").agg(F.count("*").alias("m"))
    largest = counts.groupBy("node").agg(F.max(F.struct("m", "of")).alias("top"), F.count("*").alias("several")).where("several > 1")
    mixed = found.join(largest, "node").withColumn("main", F.col("of") == F.col("top.of")).drop("top", "several")
    mixed = stored(mixed.withColumn("part", part), "jaccard_mixed")
    outside = mixed.where("NOT main").withColumn("part", every_part)
    apart = (F.col("x.of") != F.col("y.of")) & (F.col("y.main") | (F.col("x.name") < F.col("y.name")))
    across = outside.alias("x").join(mixed.alias("y"), same & (F.col("x.part") == F.col("y.part")) & apart & may_link("x", "y", percent))
    new = across.select(*pair("x", "y")).join(measured.select("a", "b"), ["a", "b"], "left_anti")
    more = confirmed(new, classes, docs, k, percent, "jaccard_across").where("linked")
    return joined_components(vertices, placed, more)


def join(docs: DataFrame, k: int = 3, percent: int = 90) -> DataFrame:
    """doc_id, row, n_shingles and component_id of every row.

    Texts are linked if 100 * intersection >= ``percent`` * union of their sets of ``k``-word
    n-grams, A-Z as a-z; shorter texts are one n-gram; texts without words (null, empty)
    are linked with nothing. component_id is the least doc_id that is reached; null ids count
    as the largest, and a component of nothing else has a null id. Repeated rows and equal
    texts are in one class and so in one component. An empty table gives no rows. Only
    doc_id and text are read; ``row`` is a hash of both. ``docs`` is read several times and
    must give the same rows in the same order, as a table read from files does; else the job fails.
    """
    docs = only_text(docs)
    rows = named_rows(docs, k, "jaccard")
    classes = classes_of(rows, "jaccard")
    return outcome(rows, linked(prefixes(docs, rows, k, percent), classes, docs, k, percent))
