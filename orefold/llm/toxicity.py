"""Toxicity by maximum-scoring segments over token log-odds.

Log-odds of a token between labelled toxic and other texts, with an informative
Dirichlet prior (the pooled counts) and shrunk by its standard error, minus a drift
that makes the expected score of ordinary text negative. In each text all maximal
scoring segments are found in one linear scan. Segment scores of ordinary text follow
an extreme-value law, P(best >= s) = 1 - exp(-K n exp(-lambda s)); the text's
significance sums what its segments are worth under it, and a logistic curve turns
that into the score. Digits, marks and case don't count: a token is a run of letters, read
whole. A token without evidence of its own falls back on its stem, that of all tokens
beginning with the same letters. By how many standard errors log-odds are shrunk is chosen
on labelled rows that the counts were not taken from.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .stored import stored

#: Labelled texts that the token counts are taken from, of either label; chosen by hash.
TRAIN_ROWS = 20_000
#: Labelled texts, others than these, that the curves are fitted on.
CURVE_ROWS = 10_000
#: The prior's weight: this share of the pooled counts is added to either side.
PRIOR_SHARE = 0.05
#: Standard errors by which log-odds are shrunk towards 0: the curve rows choose among these.
SHRINKS = (1.0, 2.0, 3.0, 4.0)
#: Log-odds that shrink to less than this count as none.
LEAST = 0.5
DRIFT = 0.1
#: Letters of a stem.
STEM = 4
TOKEN = re.compile(r"[^\W\d_]+")


def stem(token: str) -> str:
    """What tokens that begin alike share; no token has the mark."""
    return token[:STEM] + "*"


class Scores(dict):
    """Scores of tokens and stems; a token that has none takes its stem's, or None."""

    def __missing__(self, token: str) -> float | None:
        found = self.get(stem(token))
        if len(self) < 2_000_000:  # remembered, within bounds
            self[token] = found
        return found


@dataclass(frozen=True)
class Model:
    """Token scores (others score -drift), extreme-value law and curve."""

    scores: Scores
    drift: float
    lam: float
    k: float
    slope: float
    offset: float


def maximal_segments(at: list[int], scores: list[float], drift: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments, as (first token, last token, score).

    ``at`` and ``scores`` are the tokens with scores of their own, in order; each token
    between them scores ``-drift``. Linear time: candidates are kept with the sums left
    and right of them, and joined while a join gains (Ruzzo and Tompa's scan).
    """
    found: list[tuple[int, int, float, float]] = []  # first, last, sum before, sum through
    total, reached = 0.0, -1
    for place, score in zip(at, scores, strict=True):
        total -= drift * (place - reached - 1)
        reached = place
        before, total = total, total + score
        if score <= 0:
            continue
        first, last, left, right = place, place, before, total
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= left:
                j -= 1
            if j < 0 or found[j][3] >= right:
                found.append((first, last, left, right))
                break
            first, left = found[j][0], found[j][2]
            del found[j:]
    return [(a, b, right - left) for a, b, left, right in found]


def segments(text: str, model: Model) -> tuple[list[tuple[int, int, float]], int]:
    """Maximal segments of a text, and its number of tokens."""
    tokens = TOKEN.findall(text.lower())
    scores = model.scores
    own = [(i, s) for i, t in enumerate(tokens) if (s := scores[t]) is not None]
    return maximal_segments([i for i, _ in own], [s for _, s in own], model.drift), len(tokens)


def significance(found: list[tuple[int, int, float]], n: int, model: Model) -> float:
    """Minus log10 of the chance of segments like these in n ordinary tokens, summed over the significant ones."""
    total = 0.0
    for _, _, score in found:
        expected = model.k * max(n, 1) * math.exp(-min(model.lam * score, 700.0))
        if expected < 1:
            total -= math.log10(max(-math.expm1(-expected), 1e-300))
    return total


def probability(value: float, model: Model) -> float:
    return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, model.slope * value + model.offset))))


def _train_part(doc_id):
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3


def _log_odds(totals: dict[bool, float]) -> tuple[Column, Column]:
    """Log-odds of a token with the counts ``toxic`` and ``other``, and their standard error."""
    weight = PRIOR_SHARE * (totals[True] + totals[False])
    toxic, other = F.col("toxic").cast("double"), F.col("other").cast("double")
    prior = PRIOR_SHARE * (toxic + other)
    a, b = toxic + prior, other + prior
    delta = F.log(a / (totals[True] + weight - a)) - F.log(b / (totals[False] + weight - b))
    return delta, F.sqrt(1 / a + 1 / b)


def _draft(counts: list, odds: dict[str, tuple[float, float]], others: float, shrink: float) -> Model:
    """Scores at one strength of shrinking, and their extreme-value law over the ordinary texts."""
    scores = Scores()
    for token, (delta, error) in odds.items():
        if abs(delta) - shrink * error >= LEAST:
            scores[token] = math.copysign(abs(delta) - shrink * error, delta)
    known = {t: o for t, _, o in counts if t in scores}
    for token in [t for t in known if not t.endswith("*")]:
        if stem(token) in known:  # what has a score of its own doesn't fall back
            known[stem(token)] = max(known[stem(token)] - known[token], 0)
    values = np.array([scores[t] for t in known] + [-DRIFT])
    shares = np.array([known[t] / others for t in known])
    shares = np.append(shares, max(0.0, 1 - shares.sum()))
    drift = DRIFT
    while (values * shares).sum() >= 0:  # the law needs a negative mean
        drift *= 2
        values[-1] = -drift
    return Model(scores, drift, _root(values, shares), 1.0, 1.0, 0.0)


def _finished(draft: Model, curve: list[tuple[list[float], int, int]]) -> tuple[Model, float]:
    """The draft with its law and curve fitted on (segment scores, tokens, label) rows, and their log loss."""
    # P(best < s) = exp(-K n exp(-lambda s)) over the ordinary texts: K by maximum likelihood, given lambda.
    plain = [(max(f, default=0.0), n) for f, n, y in curve if not y]
    weight = sum(n * math.exp(-min(draft.lam * s, 700.0)) for s, n in plain)
    model = replace(draft, k=len(plain) / weight if weight else 1.0)
    x = np.array([significance([(0, 0, s) for s in f], n, model) for f, n, _ in curve])
    y = np.array([y for _, _, y in curve], float)
    slope, offset = _logistic(x, y, np.ones_like(x))
    p = 1 / (1 + np.exp(-np.clip(slope * x + offset, -30, 30)))
    loss = -float((y * np.log(p) + (1 - y) * np.log(1 - p)).sum())
    return replace(model, slope=slope, offset=offset), loss


def _root(scores: np.ndarray, shares: np.ndarray) -> float:
    """The positive lambda with sum(share * exp(lambda * score)) = 1."""
    high = 1e-3
    while (shares * np.exp(np.minimum(high * scores, 700))).sum() < 1 and high < 100:
        high *= 2
    low = 0.0
    for _ in range(60):
        mid = (low + high) / 2
        if (shares * np.exp(np.minimum(mid * scores, 700))).sum() < 1:
            low = mid
        else:
            high = mid
    return high


def _logistic(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve by Newton's steps; n counts equal rows."""
    w = np.zeros(2)
    z = np.stack([x, np.ones_like(x)], axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = z.T @ (n * (y - p)) - 1e-3 * w
        hess = (z * (n * p * (1 - p))[:, None]).T @ z + 1e-3 * np.eye(2)
        w = w + np.linalg.solve(hess, grad)
    return float(w[0]), float(w[1])


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn from labelled rows whose crc32(doc_id) mod 3 is not 1.

    Rows are taken by hash up to ``TRAIN_ROWS`` for the counts and ``CURVE_ROWS``, other
    ones, for the curves. Rows without label are not used. Without any label of either
    kind the model scores every text alike.
    """
    spark = docs.sparkSession
    marked = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    marked = marked.where(_train_part(F.col("doc_id")) != 1).withColumn("o", F.xxhash64(F.lit(17), "doc_id"))
    chosen = marked.orderBy("o", "doc_id").limit(TRAIN_ROWS + CURVE_ROWS)
    picked = [(r.doc_id, int(r.toxic)) for r in chosen.collect()]
    for_curve = len(picked) // 3 if len(picked) < TRAIN_ROWS + CURVE_ROWS else CURVE_ROWS
    sample = spark.createDataFrame(
        [(i, t, k < for_curve) for k, (i, t) in enumerate(picked)], "doc_id long, toxic int, curve boolean"
    )
    texts = docs.where("text IS NOT NULL").select("doc_id", "text").join(F.broadcast(sample), "doc_id")

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[str, list[int]] = {}
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                # Once a text: words that a single text repeats say little about others.
                own = set(TOKEN.findall(text.lower()))
                for token in own | {stem(t) for t in own}:
                    counts.setdefault(token, [0, 0])[toxic] += 1
            names = pa.array(list(counts), pa.string())
            values = np.array(list(counts.values()), np.int64).reshape(-1, 2)
            yield pa.record_batch([names, pa.array(values[:, 1]), pa.array(values[:, 0])], ["token", "toxic", "other"])

    counted = texts.where("NOT curve").select("text", F.expr("CAST(toxic > 0 AS INT) AS toxic")).mapInArrow(
        tokens, "token string, toxic long, other long"
    ).groupBy("token").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    counted = stored(counted, "toxicity_counts")
    sums = counted.agg(F.sum("toxic").alias("t"), F.sum("other").alias("o")).first()
    if not sums.t or not sums.o:
        return Model(Scores(), DRIFT, 1.0, 1.0, 0.0, -3.0)
    totals = {True: float(sums.t), False: float(sums.o)}
    # Of the sampled texts' tokens those that the weakest shrinking leaves a score, so their number
    # is bounded by ``TRAIN_ROWS`` texts.
    odds = _log_odds(totals)
    told = counted.select("*", odds[0].alias("delta"), odds[1].alias("error"))
    told = told.where(F.abs("delta") - min(SHRINKS) * F.col("error") >= LEAST).collect()
    counts = sorted((r.token, r.toxic, r.other) for r in told)
    odds = {r.token: (r.delta, r.error) for r in told}
    drafts = [_draft(counts, odds, totals[False], shrink) for shrink in SHRINKS]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [[segments(text, d) for d in drafts] for text in batch.column(0).to_pylist()]
            found = pa.array([[[s for _, _, s in f] for f, _ in each] for each in out], pa.list_(pa.list_(pa.float64())))
            yield pa.record_batch([found, pa.array([each[0][1] for each in out], pa.int64()), batch.column(1)], ["found", "n", "toxic"])

    curve = texts.where("curve").select("text", "toxic").mapInArrow(scan, "found array<array<double>>, n long, toxic int")
    curve = curve.collect()  # CURVE_ROWS at most
    fitted = [_finished(d, [(r.found[i], r.n, int(r.toxic > 0)) for r in curve]) for i, d in enumerate(drafts)]
    return min(fitted, key=lambda m: m[1])[0]


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score and the significant segments (first and last token, score) of every row.

    Null and empty texts have no segment and the score of text without any. Equal
    texts score alike; an empty table gives no rows; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            scores, passages = [], []
            for text in batch.column(1).to_pylist():
                found, n = segments(text or "", model)
                scores.append(probability(significance(found, n, model), model))
                passages.append(
                    [
                        {"first": a, "last": b, "score": s}
                        for a, b, s in found
                        if model.k * max(n, 1) * math.exp(-min(model.lam * s, 700.0)) < 0.05
                    ]
                )
            kind = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("score", pa.float64())]))
            yield pa.record_batch([batch.column(0), pa.array(scores), pa.array(passages, kind)], ["doc_id", "score", "passages"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, score double, passages array<struct<first: long, last: long, score: double>>")
