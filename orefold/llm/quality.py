"""Quality classifier by importance resampling.

Two bag-of-n-gram models over the same ``BUCKETS`` hash buckets of words and word
pairs: the target's from labelled good texts, the raw one's from all texts. The log of
their ratio, summed over a text's n-grams, is its importance weight. A Gumbel number
from a hash of the row is added, and the k texts with the largest sums are kept: a
sample without replacement by weight. k is the number of texts whose weight is
not below -``MARGIN``: those that the target model explains about as well as the raw one,
or better. Marks count as words of their own, joined to the
letters or not; digits count as one digit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import blocks
from .stored import stored

BUCKETS = 1 << 14
#: Added to every bucket's count, as a share of the mean count.
SMOOTH = 0.01
#: Labelled good texts that the target model is fitted on, chosen by hash.
TRAIN_ROWS = 20_000
SEED = 29
#: Nats that a text may be explained worse by the target model; Gumbel numbers are hardly ever below -3.
MARGIN = 3.0

_KIND = np.zeros(256, np.uint8)  # 0 space, 1 letter (all of UTF-8 beyond ASCII), 2 digit, 3 mark
_KIND[33:127] = 3
_KIND[48:58] = 2
_KIND[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of some texts, and the text that each is from."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    kind = _KIND[data]
    new = np.empty(len(data), bool)
    new[0] = True
    # A run of letters or digits is a token, and so is a run of one mark.
    new[1:] = (kind[1:] != kind[:-1]) | ((kind[1:] == 3) & (data[1:] != data[:-1]))
    new[offsets[:-1][offsets[:-1] < len(data)]] = True
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], len(data))
    held = kind[starts] > 0
    starts, ends = starts[held], ends[held]
    block = blocks.Block.__new__(blocks.Block)
    block.data = data
    hashes = block.span_hash(starts, ends, lower=True)
    what = kind[starts]
    # All numbers are one token, and so are all runs of the same mark.
    hashes = np.where(what == 2, np.uint64(2), np.where(what == 3, blocks._BYTE[data[starts]], hashes))
    text = np.searchsorted(offsets, starts, side="right") - 1
    pairs = blocks.windows(hashes, 2)
    pairs[hashes[1:] == hashes[:-1]] = np.uint64(0)  # a token said twice, whichever it is
    same = text[1:] == text[:-1]
    single = (blocks.mix(hashes) % np.uint64(BUCKETS)).astype(np.int64)
    double = (pairs[same] % np.uint64(BUCKETS)).astype(np.int64)
    return np.concatenate([single, double]), np.concatenate([text, text[1:][same]])


def _counts(texts: DataFrame) -> np.ndarray:
    """How often each bucket occurs in a table of texts; one row of sums comes from each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for _, _, block in blocks.arrow_blocks(batch.column(0)):
                total += np.bincount(features(block.data, block.offsets)[0], minlength=BUCKETS)
        used = np.flatnonzero(total)
        yield pa.record_batch([pa.array(used, pa.int64()), pa.array(total[used])], ["bucket", "n"])

    rows = texts.select(F.col("text").cast("string")).mapInArrow(run, "bucket long, n long")
    out = np.zeros(BUCKETS)
    for r in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # BUCKETS rows at most
        out[r.bucket] = r.n
    return out


def fit(docs: DataFrame, labels: DataFrame) -> np.ndarray:
    """Log ratio of target to raw for each bucket; zeros where no good text is labelled."""
    good = labels.where("doc_id IS NOT NULL AND quality > 0").select("doc_id").distinct()
    order = F.xxhash64(F.lit(SEED), "doc_id")
    picked = [r.doc_id for r in good.orderBy(order, "doc_id").limit(TRAIN_ROWS).collect()]
    if not picked:
        return np.zeros(BUCKETS)
    sample = docs.sparkSession.createDataFrame([(i,) for i in picked], "doc_id long")
    target = _counts(docs.join(F.broadcast(sample), "doc_id", "left_semi"))
    raw = _counts(docs)
    if not target.sum():
        return np.zeros(BUCKETS)
    target += SMOOTH * target.mean()
    raw += SMOOTH * raw.mean()
    return np.log(target / target.sum()) - np.log(raw / raw.sum())


def weigh(docs: DataFrame, ratios: np.ndarray) -> DataFrame:
    """doc_id, two hashes of the row (ids and text), log_weight and its sum with a Gumbel number (``key``)."""
    shared = docs.sparkSession.sparkContext.broadcast(ratios)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weights = []
            for _, _, block in blocks.arrow_blocks(batch.column(3)):
                bucket, text = features(block.data, block.offsets)
                # Without any n-gram numpy counts in integers.
                weights.append(np.bincount(text, weights=shared.value[bucket], minlength=block.n).astype(float))
            weight = np.concatenate(weights) if weights else np.zeros(0)
            even = blocks.mix(batch.column(1).to_numpy().astype(np.uint64))
            even = ((even >> np.uint64(11)).astype(float) + 0.5) / 2.0**53
            yield pa.record_batch(
                [*batch.columns[:3], pa.array(weight), pa.array(weight - np.log(-np.log(even)))],
                ["doc_id", "row_a", "row_b", "log_weight", "key"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), *_row_hashes(), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, row_a long, row_b long, log_weight double, key double")


def _row_hashes() -> list:
    return [F.xxhash64(F.lit(SEED + i), F.col("doc_id"), F.col("text")).alias(n) for i, n in enumerate(("row_a", "row_b"))]


def threshold(rows: DataFrame, k: int) -> tuple[float, int]:
    """The k-th largest key, and how many rows have a larger one: counts in ever finer ranges."""
    low, high = rows.agg(F.min("key"), F.max("key")).first()
    above, steps = 0, 1024
    while low < high:
        width = (high - low) / steps
        cell = F.least(F.lit(steps - 1), F.greatest(F.lit(0), F.floor((F.col("key") - low) / width))).cast("int")
        inside = rows.where(F.col("key").between(low, high))
        counts = {r.cell: r.n for r in inside.groupBy(cell.alias("cell")).agg(F.count("*").alias("n")).collect()}
        for i in sorted(counts, reverse=True):
            if above + counts[i] >= k:
                ends = inside.where(cell == i).agg(F.min("key"), F.max("key")).first()
                if tuple(ends) == (low, high):
                    return high, above
                low, high = ends
                break
            above += counts[i]
    return low, above


def select(docs: DataFrame, labels: DataFrame, k: int | None = None) -> DataFrame:
    """Every row's weights with ``kept``; k of them are kept, in all (None: as many as have a weight of -``MARGIN`` or more).

    Null and empty texts have weight 0: nothing speaks against them. Equal rows have
    equal keys, and of rows with the k-th largest key all are kept. An empty table gives
    no rows. Texts are read whole; columns other than doc_id and text are not read.
    """
    rows = stored(weigh(docs, fit(docs, labels)), "quality_weights")
    if k is None:
        k = rows.where(F.col("log_weight") >= -MARGIN).count()
    if k <= 0:
        return rows.withColumn("kept", F.lit(False))
    least, _ = threshold(rows, k)
    return rows.withColumn("kept", F.col("key") >= F.lit(least))


def keep(docs: DataFrame, labels: DataFrame, k: int | None = None) -> DataFrame:
    """The rows of ``docs`` that ``select`` keeps, with all their columns."""
    names = docs.columns
    chosen = select(docs, labels, k).where("kept").select("row_a", "row_b").distinct()
    rows = docs.select(F.struct(*[F.col(f"`{n}`") for n in names]).alias("row"), *_row_hashes())
    return rows.join(chosen, ["row_a", "row_b"], "left_semi").select(*[F.col("row").getField(n).alias(n) for n in names])
