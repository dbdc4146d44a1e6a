"""Quality rules: base rules, then robust multivariate outliers per language and source.

``statistics`` counts words, symbols, repeated lines and repeated words of whole
texts. Of the texts that pass the base rules, a vector of transformed statistics is
compared with a minimum-covariance-determinant estimate of its (lang, source) group:
the mean and covariance of that ``SHARE`` of the group whose covariance determinant
is least, found by concentration steps from the group's medians. Each step is two
grouped aggregates (a quantile of the distances, then sums and products), so a group
of any size is only ever summed, never gathered. Each group's estimate is drawn towards that
of all rows, the more the fewer rows it has, by one formula at every size. Texts further away
than the chi-squared bound, in Mahalanobis distance, are rejected. Quantiles are taken of
values on a grid, from exact counts, so they do not depend on how rows are dealt to tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import blocks
from .stored import stored

WINDOW = 8
#: Of a group, the rows that the estimate rests on.
SHARE = 0.75
STEPS = 6
#: The estimate over all rows counts as much as this many rows of a group's own.
PRIOR_ROWS = 200.0
#: Steps of the grids that quantiles are taken on: of statistics, and of logarithms of distances.
GRID = 1000
#: Chi-squared with four degrees of freedom is above this with probability 0.001.
BOUND = 18.467
#: Words of the group's mean kind that are added to each text, so that short texts don't stray by chance.
PRIOR_WORDS = 50.0
FEATURES = ["f0", "f1", "f2", "f3"]
KEYS = ["g_all", "g_lang", "g_source"]
#: Added to variances: word length, log symbols a word, shares of repeats. The first only guards the inverse. Most
#: texts have no symbols and repeats at all, so the core's variance of the others is none and these are their scale.
FLOORS = [0.03**2, 0.02**2, 0.06**2, 0.05**2]

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_STATS = "doc_id long, lang string, source string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, base_failed boolean"


def _repeated(hashes: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per entry: does it occur again in its group, and is it there before."""
    order = np.lexsort((np.arange(len(hashes)), hashes, group))
    same = np.zeros(len(hashes), bool)
    if len(hashes) > 1:
        same[1:] = (hashes[order][1:] == hashes[order][:-1]) & (group[order][1:] == group[order][:-1])
    more = same.copy()
    more[:-1] |= same[1:]
    twice, later = np.empty_like(same), np.empty_like(same)
    twice[order], later[order] = more, same
    return twice, later


def count_block(block: blocks.Block) -> dict[str, np.ndarray]:
    n = block.n
    text = np.repeat(np.arange(n), block.n_words)
    inside = ~blocks._SPACE[block.data]
    whole = (block.data & 0xC0) != 0x80
    # Words in windows found twice or more.
    every = blocks.windows(block.word_hash(), WINDOW)
    valid = np.flatnonzero(text[: len(every)] == text[WINDOW - 1 :]) if len(every) else np.zeros(0, np.int64)
    twice, _ = _repeated(every[valid], text[valid])
    edge = np.zeros(len(text) + 1, np.int64)
    np.add.at(edge, valid[twice], 1)
    np.add.at(edge, valid[twice] + WINDOW, -1)
    repeat_words = np.bincount(text[np.cumsum(edge[:-1]) > 0], minlength=n)
    # Lines with a word that equal an earlier line of the text.
    cuts = np.flatnonzero(block.data == 0x0A)
    starts = np.sort(np.concatenate([block.offsets[:-1], cuts + 1]))
    line_text = np.sort(np.concatenate([np.arange(n), np.searchsorted(block.offsets, cuts, side="right") - 1]))
    ends = np.append(starts[1:] - 1, len(block.data))
    last = np.append(line_text[1:] != line_text[:-1], True)
    ends[last] = block.offsets[1:][line_text[last]]
    words = np.searchsorted(block.starts, ends) - np.searchsorted(block.starts, starts)
    full = words > 0
    _, later = _repeated(block.span_hash(starts[full], ends[full]), line_text[full])
    return {
        "n_words": block.n_words,
        "word_chars": block.count(inside & whole),
        "n_symbols": block.count(_SYMBOL[block.data]),
        "n_dup_lines": np.bincount(line_text[full][later], minlength=n),
        "n_repeat_words": repeat_words,
        "n_lines": np.bincount(line_text[full], minlength=n),
    }


def statistics(docs: DataFrame) -> DataFrame:
    """The counts of every row; a null or empty text has none of anything."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, block in blocks.arrow_blocks(batch.column(3)):
                c = {k: v.astype(np.int64) for k, v in count_block(block).items()}
                failed = (c["n_words"] < 20) | (100 * c["n_repeat_words"] > 30 * c["n_words"])
                ids = {n: batch.column(i).slice(lo, hi - lo) for i, n in enumerate(("doc_id", "lang", "source"))}
                yield pa.record_batch(ids | c | {"base_failed": failed})

    texts = docs.select(F.col("doc_id").cast("long"), F.col("lang").cast("string"), F.col("source").cast("string"), F.col("text").cast("string"))
    return texts.mapInArrow(run, _STATS)


def consistency(share: float) -> float:
    """By how much the covariance of a normal distribution is larger than that of its core, the nearest ``share``, in four dimensions."""
    low, high = 0.0, 200.0
    for _ in range(100):
        half = (low + high) / 4
        low, high = (2 * half, high) if 1 - math.exp(-half) * (1 + half) < share else (low, 2 * half)
    half = low / 2
    return share / (1 - math.exp(-half) * (1 + half + half**2 / 2))


def _covariances(moments: pd.DataFrame, share: float) -> tuple[np.ndarray, np.ndarray]:
    """Centres and covariances from n, sums and products of each group's core of this ``share``."""
    p = len(FEATURES)
    n = moments["n"].to_numpy()[:, None]
    mean = moments[[f"s{i}" for i in range(p)]].to_numpy() / n
    square = np.stack([[moments[f"p{min(i, j)}{max(i, j)}"].to_numpy() for j in range(p)] for i in range(p)]).transpose(2, 0, 1) / n[:, :, None]
    # Sums are taken about the former centres, so little is lost to cancellation.
    cov = square - mean[:, :, None] * mean[:, None, :]
    # The core of a normal distribution is narrower than the whole.
    return mean + moments[[f"c{i}" for i in range(p)]].to_numpy(), consistency(share) * cov


def _table(keys: pd.DataFrame, centres: np.ndarray, covs: np.ndarray) -> pd.DataFrame:
    p = len(FEATURES)
    upper = np.triu_indices(p)
    inverse = np.linalg.inv(covs + np.diag(FLOORS))[:, upper[0], upper[1]]
    names = [f"c{i}" for i in range(p)] + [f"q{i}{j}" for i in range(p) for j in range(i, p)]
    rows = pd.DataFrame(np.concatenate([centres, inverse], axis=1), columns=names)
    return pd.concat([keys.reset_index(drop=True), rows], axis=1)


def _estimates(moments: pd.DataFrame, share: float) -> pd.DataFrame:
    """Mean and inverse covariance of each group's core."""
    return _table(moments[KEYS], *_covariances(moments, share))


def _drawn(moments: pd.DataFrame, whole: dict, share: float) -> pd.DataFrame:
    """The same, each drawn towards the estimate of all rows by ``PRIOR_ROWS`` rows of that."""
    centres, covs = _covariances(moments, share)
    [centre], [cov] = _covariances(pd.DataFrame([whole]), share)
    own = (moments["rows"] / (moments["rows"] + PRIOR_ROWS)).to_numpy()[:, None]
    centres = own * centres + (1 - own) * centre
    covs = own[:, :, None] * covs + (1 - own)[:, :, None] * cov
    return _table(moments[KEYS], centres, covs)


def _distance():
    p = len(FEATURES)
    terms = [f"{'' if i == j else '2 * '}q{i}{j} * (f{i} - c{i}) * (f{j} - c{j})" for i in range(p) for j in range(i, p)]
    return F.expr(" + ".join(terms))


def _join(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    # The estimates are read from files, so Spark knows their size and broadcasts them where they are small.
    names = [c for c in estimates.columns if c not in KEYS]
    same = " AND ".join(f"r.{k} <=> e.{k}" for k in KEYS)
    return rows.alias("r").join(estimates.alias("e"), F.expr(same)).select("r.*", *names)


def vectors(stats: DataFrame) -> DataFrame:
    """Rows that pass the base rules with their group and transformed statistics."""
    passed = stats.where("NOT base_failed")
    sums = passed.groupBy("lang", "source").agg(
        F.count("*").alias("rows"), (F.sum("word_chars") / F.sum("n_words")).alias("mean_length")
    )
    sums = stored(sums, "outliers_groups")
    typical = F.lit(PRIOR_WORDS)
    return passed.alias("r").join(sums.alias("s"), F.expr("r.lang <=> s.lang AND r.source <=> s.source")).select(
        "r.*",
        F.lit(False).alias("g_all"),
        F.col("r.lang").alias("g_lang"),
        F.col("r.source").alias("g_source"),
        ((F.col("word_chars") + typical * F.col("mean_length")) / (F.col("n_words") + typical)).alias("f0"),
        F.log1p(F.col("n_symbols") / (F.col("n_words") + typical)).alias("f1"),
        (F.col("n_dup_lines") / (F.col("n_lines") + 5)).alias("f2"),
        (F.col("n_repeat_words") / (F.col("n_words") + typical)).alias("f3"),
    )


def _quantile(value: str, share: float) -> str:
    """The quantile of a value on the grid, by exact counts of the cells, of which there are few."""
    return f"percentile(floor({value} * {GRID}), {share}D) / {GRID}"


def fit_mcd(rows: DataFrame, share: float = SHARE, steps: int = STEPS) -> DataFrame:
    """A stored table of centre (c) and inverse covariance (q) of each group of ``rows``.

    Groups by null language or source are groups of their own.
    """
    p = len(FEATURES)
    # All rows also count to one group of all.
    every = rows.select(*KEYS, *FEATURES).withColumn("all", F.explode(F.array(F.lit(True), F.lit(False))))
    every = every.select(
        F.col("all").alias("g_all"), *[F.when(~F.col("all"), F.col(k)).alias(k) for k in KEYS[1:]], *FEATURES
    )
    medians = [F.expr(f"{_quantile(f'f{i}', 0.5)} AS c{i}") for i in range(p)]
    start = every.groupBy(*KEYS).agg(*medians)
    same = [F.lit((1.0 / FLOORS[i]) if i == j else 0.0).alias(f"q{i}{j}") for i in range(p) for j in range(i, p)]
    estimates = stored(start.select("*", *same), "mcd_start")
    for step in range(steps):
        near = _join(every, estimates).withColumn("d", F.log1p(F.greatest(_distance(), F.lit(0.0))))
        bounds = near.groupBy(*KEYS).agg(F.expr(f"{_quantile('d', share)} + 1D / {GRID} AS bound"), F.count("*").alias("rows"))
        core = _join(near, stored(bounds, "mcd_bound")).where("d <= bound")
        about = [F.expr(f"f{i} - c{i}") for i in range(p)]
        sums = [F.sum(about[i]).alias(f"s{i}") for i in range(p)] + [F.first(f"c{i}").alias(f"c{i}") for i in range(p)]
        sums += [F.sum(about[i] * about[j]).alias(f"p{i}{j}") for i in range(p) for j in range(i, p)]
        moments = core.groupBy(*KEYS).agg(F.count("*").alias("n"), F.first("rows").alias("rows"), *sums)
        if step == steps - 1:
            moments = stored(moments, "mcd_moments")
            whole = moments.where("g_all").first()
            if whole is None:
                return estimates
            drawn = whole.asDict()
            moments = moments.where("NOT g_all")
            last = moments.mapInPandas(lambda frames: (_drawn(f, drawn, share) for f in frames if len(f)), estimates.schema)
            return stored(last, "mcd_last")
        estimates = stored(
            moments.mapInPandas(lambda frames: (_estimates(f, share) for f in frames if len(f)), estimates.schema), "mcd_step"
        )
    return estimates


def judge(docs: DataFrame, bound: float = BOUND) -> DataFrame:
    """The statistics of every row, with ``distance`` (null if the base rules reject it) and ``kept``.

    Null and empty texts fail the base rules. Equal rows are judged alike. An empty
    table gives no rows. Only doc_id, lang, source and text are read.
    """
    stats = stored(statistics(docs), "outliers_stats")
    rows = stored(vectors(stats), "outliers_vectors")
    estimates = fit_mcd(rows)
    names = stats.columns
    passed = _join(rows, estimates).withColumn("distance", _distance())
    passed = passed.select(*names, "distance", (F.col("distance") <= bound).alias("kept"))
    failed = stats.where("base_failed").select(*names, F.lit(None).cast("double").alias("distance"), F.lit(False).alias("kept"))
    return passed.unionByName(failed)
