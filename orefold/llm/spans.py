"""Substring dedup by sliding sentence spans.

Texts are cut into sentences and these into clauses: a unit ends with a word in ``.!?,;:``, with
its line, or with a word that its own letters mark (one in ``MARKED``), so that a passage
is cut alike wherever it stands, in mid-sentence too. From every unit the shortest run of units
with at least ``LEAST_WORDS`` words, be it a dozen short ones or one long one, is hashed by its
words; a run that occurs more than once, in one text or in several, stays where
(doc_id, place) is least, and elsewhere all its units go. White space between words
makes no difference, case and marks do.

Of each run, count and least place are aggregated before and after the shuffle; only runs
that repeat are joined with their occurrences, by a plain join whose large partitions
adaptive execution splits, so a passage in a third of all texts meets no single task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from . import blocks
from .stored import stored

#: Words of a run at least.
LEAST_WORDS = 25
#: Of the words, one in this many ends a unit by its length and last letter.
MARKED = 16
_STOPS = np.frombuffer(b".!?,;:", np.uint8)


def units(block: blocks.Block) -> tuple[np.ndarray, np.ndarray]:
    """The first word of each unit, and where the units of each text start."""
    n = len(block.starts)
    if not n:
        return np.zeros(0, np.int64), np.zeros(block.n + 1, np.int64)
    opens = np.zeros(n, bool)
    opens[block.first[:-1][block.n_words > 0]] = True
    last = block.data[block.ends - 1]
    # A letter beyond ASCII counts as 0.
    marked = (block.ends - block.starts + np.where(last < 0x80, last, 0).astype(np.int64)) % MARKED == 0
    opens[1:] |= (np.isin(last, _STOPS) | marked)[:-1]
    lines = np.zeros(len(block.data) + 1, np.int64)
    np.cumsum(block.data == 0x0A, out=lines[1:])
    opens[1:] |= lines[block.starts[1:]] > lines[block.ends[:-1]]
    first = np.flatnonzero(opens)
    return first, np.searchsorted(first, block.first)


def runs(first: np.ndarray, at: np.ndarray, n_words: int, least_words: int) -> tuple[np.ndarray, np.ndarray]:
    """First unit and last unit of the shortest run from each unit that has enough words in its text."""
    text = np.repeat(np.arange(len(at) - 1), np.diff(at))
    ends = np.append(first[1:], n_words)
    # Words are numbered through, so a run ends with the first unit that ends far enough on.
    last = np.searchsorted(ends, first + least_words)
    start = np.flatnonzero(last < len(first))
    start = start[text[last[start]] == text[start]]
    return start, last[start]


def _runs(batches: Iterator[pa.RecordBatch], least_words: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, block in blocks.arrow_blocks(batch.column(2)):
            first, at = units(block)
            start, last = runs(first, at, len(block.starts), least_words)
            ends = np.append(first[1:], len(block.starts))
            # Hashed unit by unit, so that where they end counts as well.
            each = blocks.run_hash(block.word_hash(), first, ends)
            hashes = blocks.run_hash(each, start, last + 1)
            text = np.repeat(np.arange(block.n), np.diff(at))[start]
            which = pa.array(text)
            yield pa.record_batch(
                [
                    pa.array(hashes.view(np.int64)),
                    batch.column(0).slice(lo, hi - lo).take(which),
                    batch.column(1).slice(lo, hi - lo).take(which),
                    pa.array((start - at[text]).astype(np.int32)),
                ],
                ["hash", "doc_id", "row", "place"],
            )


def _cut(batches: Iterator[pa.RecordBatch], least_words: int) -> Iterator[pa.RecordBatch]:
    """The rows with their text without the units of the runs at ``places``, and counts of both."""
    for batch in batches:
        names = batch.schema.names
        texts, places = batch.column(names.index("text")), batch.column(names.index("places"))
        new_texts, counts, removed = [], [], []
        for lo, hi, block in blocks.arrow_blocks(texts):
            first, at = units(block)
            start, last = runs(first, at, len(block.starts), least_words)
            last_of = dict(zip(start.tolist(), last.tolist(), strict=True))
            counts += np.diff(at).tolist()
            for i in range(lo, hi):
                mine = places[i].as_py()
                if not mine:
                    new_texts.append(texts[i])
                    removed.append(0)
                    continue
                a, b = at[i - lo], at[i - lo + 1]
                gone = np.zeros(b - a, bool)
                for j in mine:
                    gone[j : last_of[a + j] - a + 1] = True
                # A unit goes with the white space up to the next one.
                begin = block.starts[first[a:b]]
                end = np.append(begin[1:], block.offsets[i - lo + 1])
                head = block.data[block.offsets[i - lo] : begin[0]].tobytes()
                kept = head + b"".join(block.data[s:e].tobytes() for s, e in zip(begin[~gone], end[~gone], strict=True))
                new_texts.append(pa.scalar(kept.rstrip(b" \t\n\r\f\v").decode("utf-8", "replace")))
                removed.append(int(gone.sum()))
        columns = {n: c for n, c in zip(names, batch.columns, strict=True) if n not in ("text", "places")}
        columns |= {
            "text": pa.array([t.as_py() for t in new_texts], pa.string()),
            "n_units": pa.array(counts, pa.int64()),
            "n_removed": pa.array(removed, pa.int64()),
        }
        yield pa.record_batch(columns)


def dedup(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """doc_id, text without repeated passages, n_units (before) and n_removed of every row.

    Texts without repeats stay byte for byte, null stays null. Empty texts have no
    units. Null ids come first in order. Rows equal in doc_id and text count as one
    and lose the same units. An empty table gives no rows. Other columns are not read;
    ``dedup_rows`` carries them.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return _dedup(rows, least_words).select("doc_id", "text", "n_units", "n_removed")


def dedup_rows(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """The rows of ``docs``, all their columns as they are but for the text."""
    names = docs.columns
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.struct(F.lit(0).alias("none"), *[F.col(f"`{n}`").alias(f"c{i}") for i, n in enumerate(names) if n != "text"]).alias("rest"),
    )
    out = _dedup(rows, least_words)
    return out.select(*[F.col("text") if n == "text" else F.col("rest").getField(f"c{i}").alias(n) for i, n in enumerate(names)])


def _dedup(rows: DataFrame, least_words: int) -> DataFrame:
    key = F.xxhash64("doc_id", "text")
    occurrences = rows.select("doc_id", key.alias("row"), "text").mapInArrow(
        lambda b: _runs(b, least_words), "hash long, doc_id long, row long, place int"
    )
    place = F.struct("doc_id", "row", "place")
    counted = occurrences.groupBy("hash").agg(F.count("*").alias("n"), F.min(place).alias("first"))
    repeated = stored(counted.where("n > 1").select("hash", "first"), "spans_repeated")
    others = occurrences.join(repeated, "hash").where(~place.eqNullSafe(F.col("first")))
    # A row has no more places than its text has units.
    places = others.groupBy("row").agg(F.collect_set("place").alias("places"))
    marked = rows.withColumn("row", key).join(places, "row", "left").drop("row")
    # As a type, not as text: fields of extra columns may have any name.
    carried = [f for f in marked.schema.fields if f.name not in ("text", "places")]
    added = [T.StructField("text", T.StringType()), *(T.StructField(n, T.LongType()) for n in ("n_units", "n_removed"))]
    return marked.mapInArrow(lambda b: _cut(b, least_words), T.StructType([*carried, *added]))


ORACLE = f"""
WITH line AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS l FROM documents),
listed AS (
  SELECT doc_id, l, list_filter(string_split_regex(line, '[ \t\r\f\v]+'), lambda w: w <> '') AS ws FROM line),
word AS (
  SELECT doc_id, l, len(ws) AS n, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM listed),
ended AS (
  SELECT *, i = n OR right(w, 1) IN ('.', '!', '?', ',', ';', ':')
    OR (strlen(w) + CASE WHEN unicode(right(w, 1)) < 128 THEN unicode(right(w, 1)) ELSE 0 END) % {MARKED} = 0 AS ends FROM word),
numbered AS (
  SELECT *, coalesce(sum(ends::INT) OVER (PARTITION BY doc_id ORDER BY l, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS u FROM ended),
unit AS (
  SELECT doc_id, u, string_agg(w, ' ' ORDER BY l, i) AS s, count(*) AS n FROM numbered GROUP BY doc_id, u),
place AS (
  SELECT *, sum(n) OVER (PARTITION BY doc_id ORDER BY u) AS through FROM unit),
whole AS (
  SELECT doc_id, list(s ORDER BY u) AS s FROM unit GROUP BY doc_id),
run AS (
  SELECT a.doc_id, a.u, b.u AS v FROM place a ASOF JOIN place b
    ON a.doc_id = b.doc_id AND a.through - a.n + {LEAST_WORDS} <= b.through),
spelled AS (
  SELECT run.doc_id, run.u, run.v, array_to_string(list_slice(s, CAST(u + 1 AS BIGINT), CAST(v + 1 AS BIGINT)), chr(10)) AS r
  FROM run JOIN whole USING (doc_id)),
found AS (
  SELECT doc_id, u, v, row_number() OVER (PARTITION BY r ORDER BY doc_id, u) AS nth FROM spelled),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(CAST(u AS BIGINT), CAST(v AS BIGINT) + 1)) AS u FROM found WHERE nth > 1),
kept AS (
  SELECT unit.doc_id, count(*) AS n_units, count(gone.u) AS n_removed,
         coalesce(string_agg(unit.s, ' ' ORDER BY unit.u) FILTER (WHERE gone.u IS NULL), '') AS text
  FROM unit LEFT JOIN gone ON unit.doc_id = gone.doc_id AND unit.u = gone.u
  GROUP BY unit.doc_id)
SELECT documents.doc_id, coalesce(n_units, 0) AS n_units, coalesce(n_removed, 0) AS n_removed,
       md5(coalesce(kept.text, '')) AS kept_md5
FROM documents LEFT JOIN kept USING (doc_id)
"""
