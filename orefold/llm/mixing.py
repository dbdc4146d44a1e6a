"""Mixing sources to target weights by subset sums.

Per source, the documents of each exact length are counted. A target takes whole
copies of the source first; of what is left, all but some thousand words are taken evenly
from all lengths, and a bounded knapsack over the documents left fills the remaining
budget. Where no sum of lengths fills it exactly, less is taken evenly and more is left to
the knapsack, at last everything: the result is the nearest sum there is. Which documents of a
length are taken depends on a hash of seed, doc_id and text, so reruns agree.

Only sums per source and counts per length meet on one task; documents are ranked
within (source, length, bucket), where a bucket is one of ``BUCKETS`` hash ranges.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from .stored import stored

#: Hash ranges that a length's documents are ranked in.
BUCKETS = 1024
#: The words that are left to the knapsack at first; eight times as many whenever it can't fill them.
KNAPSACK = 1 << 13

WORDS = r"[^\x20\x09-\x0D]+"


def word_count(text):
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def shares(sizes: list[int], weights: list[float], limit: float = 3.0) -> list[float]:
    """Share the sum of sizes by weight, none above ``limit`` times its size.

    Sharing the excess again by weight, until none is above, ends where every
    source has min(limit * size, level * weight); the level is found by sorting.
    """
    total = float(sum(sizes))
    ratio = [limit * s / w for s, w in zip(sizes, weights, strict=True)]
    rest, weight, level = total, float(sum(weights)), 0.0
    for i in sorted(range(len(sizes)), key=lambda i: ratio[i]):
        level = rest / weight if weight else 0.0
        if ratio[i] >= level:
            break
        rest -= limit * sizes[i]
        weight -= weights[i]
    return [min(limit * s, level * w) for s, w in zip(sizes, weights, strict=True)]


def fit(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each length to take, so that no other choice is nearer to the budget.

    Sums are multiples of the lengths' common divisor, so the search ends with a sum that is as
    near as any multiple. Of two sums equally near either may be taken.
    """
    lengths, counts = lengths.astype(np.int64), counts.astype(np.int64)
    total = int((lengths * counts).sum())
    if budget <= 0 or not total:
        return np.zeros(len(lengths), np.int64)
    if budget >= total:
        return counts.copy()
    step = int(np.gcd.reduce(lengths[(lengths > 0) & (counts > 0)]))
    nearest = min(budget % step, step - budget % step)
    window = KNAPSACK
    while True:
        taken, off = _fit_window(lengths, counts, budget, total, window)
        if off == nearest or window >= budget:
            return taken
        window *= 8


def _fit_window(lengths: np.ndarray, counts: np.ndarray, budget: int, total: int, window: int) -> tuple[np.ndarray, int]:
    """The best choice that takes all but about ``window`` words evenly, and how far off it is."""
    usable = (lengths > 0) & (counts > 0)
    taken = np.zeros(len(lengths), np.int64)
    if budget > window:
        # Python's integers: count times budget may pass 64 bits.
        taken[usable] = [int(c) * (budget - window) // total for c in counts[usable]]
    rest = budget - int((lengths * taken).sum())
    for i in np.argsort(-lengths, kind="stable"):
        # What rounding down has left goes to one more document of the longest lengths.
        if rest <= 2 * window or not usable[i]:
            break
        if taken[i] < counts[i] and lengths[i] <= rest - window:
            taken[i] += 1
            rest -= int(lengths[i])
    # One more document of some lengths: bits say which sums can be reached.
    mask = (1 << (2 * rest + 1)) - 1
    reached, items = [1], []
    for i in np.flatnonzero(usable & (taken < counts) & (lengths <= 2 * rest)):
        if (reached[-1] >> rest) & 1:
            break
        for n in _powers_of_two(int(min(counts[i] - taken[i], 2 * rest // lengths[i]))):
            items.append((int(i), n))
            reached.append(reached[-1] | ((reached[-1] << (n * int(lengths[i]))) & mask))
    sums = reached[-1]
    below = (sums & ((1 << (rest + 1)) - 1)).bit_length() - 1
    above = sums >> (rest + 1)
    first_above = (above & -above).bit_length() + rest if above else None
    goal = below if first_above is None or rest - below <= first_above - rest else first_above
    off = abs(rest - goal)
    for (i, n), before in zip(reversed(items), reversed(reached[:-1]), strict=True):
        if not (before >> goal) & 1:
            taken[i] += n
            goal -= n * int(lengths[i])
    return taken, off


def _powers_of_two(n: int) -> list[int]:
    """Numbers whose sums are all of 0 to n."""
    out, step = [], 1
    while n > 0:
        out.append(min(step, n))
        n -= out[-1]
        step *= 2
    return out


def copies(docs: DataFrame, weights=(1, 2, 3), limit: float = 3.0, seed: int = 11) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, and two hashes of the row.

    ``weights`` repeat over the sources by code point, null last. A null or empty
    text has size 0. Of rows equal in doc_id, source and text it does not matter
    which is taken. An empty table gives no rows. The list of sources (name and sum
    of words) is the one thing that goes through the driver.
    """
    spark = docs.sparkSession
    bare = stored(
        docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), *_hashes(seed)), "mixing"
    ).withColumn("bucket", F.pmod(F.shiftright("row_a", 20), F.lit(BUCKETS)).cast("int"))
    totals = bare.groupBy("source").agg(F.sum("size").alias("n")).collect()
    totals.sort(key=lambda r: (r.source is None, (r.source or "").encode("utf-8")))
    targets = shares([r.n for r in totals], [weights[i % len(weights)] for i in range(len(totals))], limit)
    plan = spark.createDataFrame(
        [(r.source, r.n, t, int(min(t // r.n, limit)) if r.n else 0) for r, t in zip(totals, targets, strict=True)],
        "source string, source_size long, target double, full long",
    )
    buckets = bare.groupBy("source", "size", "bucket").agg(F.count("*").alias("n"))
    lengths = buckets.groupBy("source", "size").agg(F.sum("n").alias("n"))
    wanted = lengths.alias("l").join(plan.alias("p"), F.expr("l.source <=> p.source")).select("l.*", "source_size", "target", "full")

    def take(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("size")
        one = group.iloc[0]
        rest = int(round(one.target - int(one.full) * int(one.source_size)))
        extra = fit(group["size"].to_numpy(), group["n"].to_numpy(), rest)
        return group[["source", "size", "source_size", "target", "full"]].assign(extra=extra)

    schema = "source string, size long, source_size long, target double, full long, extra long"
    taken = stored(wanted.groupBy("source").applyInPandas(take, schema), "mixing_taken")
    earlier = Window.partitionBy("source", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    marks = buckets.withColumn("earlier", F.coalesce(F.sum("n").over(earlier), F.lit(0))).alias("b").join(
        taken.alias("t"), F.expr("b.source <=> t.source AND b.size = t.size")
    ).selectExpr("t.*", "bucket", "extra - earlier AS left")
    rank = F.row_number().over(Window.partitionBy("source", "size", "bucket").orderBy("row_a", "row_b", "doc_id"))
    return bare.withColumn("rank", rank).alias("r").join(
        marks.alias("m"), F.expr("r.source <=> m.source AND r.size = m.size AND r.bucket = m.bucket")
    ).selectExpr("r.doc_id", "r.source", "r.size", "source_size", "target", "full + CAST(rank <= left AS LONG) AS copies", "row_a", "row_b")


def _hashes(seed: int) -> list:
    parts = [F.col("doc_id"), F.col("source"), F.col("text")]
    return [F.xxhash64(F.lit(seed), *parts).alias("row_a"), F.xxhash64(F.lit(seed + 1), *parts).alias("row_b")]


def mix(docs: DataFrame, weights=(1, 2, 3), limit: float = 3.0, seed: int = 11) -> DataFrame:
    """The mixture itself: each row of ``docs`` as many times as it is taken, with all its columns.

    Nulls, repeated rows and empty tables as in ``copies``.
    """
    names = docs.columns
    taken = copies(docs, weights, limit, seed).where("copies > 0")
    # Equal rows are told apart by their number, on either side.
    number = F.row_number().over(Window.partitionBy("row_a", "row_b").orderBy(F.col("copies").desc()))
    taken = taken.select("row_a", "row_b", "copies", number.alias("number"))
    number = F.row_number().over(Window.partitionBy("row_a", "row_b").orderBy("row_a"))
    rows = docs.select(F.struct(*[F.col(f"`{n}`") for n in names]).alias("row"), *_hashes(seed)).withColumn("number", number)
    out = rows.join(taken, ["row_a", "row_b", "number"])
    repeated = out.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
    return repeated.select(*[F.col("row").getField(n).alias(n) for n in names])
