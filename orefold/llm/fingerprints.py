"""Document fingerprints by one-permutation MinHash.

Each word shingle is hashed once; its low bits choose a bin and the hash is the
value of which the bin keeps the least. An empty bin copies a filled one chosen by
a hash of (bin, attempt) that is the same for all documents, so equal sets stay equal
and similar sets stay alike (optimal densification). Of each bin the low ``BITS``
bits are kept, packed and written as base64. Unlike bins agree by chance in one of
2^BITS cases; ``likeness`` takes that out.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import blocks
from .stored import id_ranges, range_of, shuffle_partitions

BINS = 512
BITS = 8
SHINGLE = 5
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def bins_of(block: blocks.Block, k: int = SHINGLE, bins: int = BINS) -> np.ndarray:
    """Texts by bins: the least hash of each bin, densified; a text without words has only the largest number."""
    hashes, at = blocks.shingles(block, k)
    table = np.full(block.n * bins, _NONE)
    if len(hashes):
        row = np.repeat(np.arange(block.n, dtype=np.int64), np.diff(at))
        np.minimum.at(table, row * bins + (hashes % np.uint64(bins)).astype(np.int64), hashes)
    return densify(table.reshape(block.n, bins))


def densify(table: np.ndarray) -> np.ndarray:
    """Fill empty bins from filled ones of the same row; a row without any stays."""
    n, bins = table.shape
    filled = table != _NONE
    some = filled.sum(axis=1)
    one = some == 1
    if one.any():  # whatever the attempts, they end at the only filled bin
        table[one] = table[one].min(axis=1)[:, None]
    row, empty = np.nonzero(~filled & (some > 1)[:, None])
    attempt = 0
    while len(row):
        attempt += 1
        seed = blocks.mix(empty.astype(np.uint64) * np.uint64(0x100000001B3) + np.uint64(attempt << 20))
        donor = (seed % np.uint64(bins)).astype(np.int64)
        hit = filled[row, donor]
        table[row[hit], empty[hit]] = table[row[hit], donor[hit]]
        row, empty = row[~hit], empty[~hit]
    return table


def packed(table: np.ndarray, bits: int = BITS) -> list[str]:
    """Low bits of each bin as base64; empty for a text without words."""
    # Bits that chose the bin are the same in all values of the bin, so others are taken.
    low = (table >> np.uint64(32)).astype(np.uint64) & np.uint64((1 << bits) - 1)
    if bits == 8:
        rows = low.astype(np.uint8)
    else:
        wide = ((low[:, :, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
        rows = np.packbits(wide.reshape(len(table), -1), axis=1)
    blank = (table == _NONE).all(axis=1)
    return ["" if b else base64.b64encode(r.tobytes()).decode() for r, b in zip(rows, blank, strict=True)]


def likeness(a: np.ndarray, b: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Estimated Jaccard similarity of the texts in the same rows of two bin tables, 0 to 1.

    Two texts without words are alike (1), one with and one without are not (0).
    """
    mask = np.uint64((1 << bits) - 1)
    shift = np.uint64(32)
    same = (((a >> shift) & mask) == ((b >> shift) & mask)).mean(axis=1)
    by_chance = 2.0**-bits
    out = np.clip((same - by_chance) / (1 - by_chance), 0, 1)
    blank_a, blank_b = (a == _NONE).all(axis=1), (b == _NONE).all(axis=1)
    return np.where(blank_a | blank_b, (blank_a & blank_b).astype(float), out)


def fingerprint(docs: DataFrame, k: int = SHINGLE, bins: int = BINS, bits: int = BITS) -> DataFrame:
    """doc_id and fingerprint of every row; null and empty texts have the empty fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints: list[str] = []
            for _, _, block in blocks.arrow_blocks(batch.column(1)):
                prints += packed(bins_of(block, k, bins), bits)
            yield pa.record_batch([batch.column(0), pa.array(prints, pa.string())], ["doc_id", "fingerprint"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, fingerprint string")


def with_next(docs: DataFrame) -> DataFrame:
    """Rows laid out so that each task sees its documents in order, and after them the next one.

    Tasks hold ranges of doc_id between some of the ids. The first document of a range
    goes to the range before as well (to the last range, if it is the first of all),
    marked as ``only_next``. Only the bounds go through the driver, one for each task.
    """
    bounds = id_ranges(docs, shuffle_partitions(docs.sparkSession))
    # Null ids come first; they are ordered by text, as equal ids are.
    part = range_of(F.col("doc_id"), bounds)
    rows = docs.withColumn("part", part).withColumn("only_next", F.lit(False))
    firsts = rows.where(F.col("doc_id").isin(bounds) | F.col("doc_id").isNull())
    # All rows with the first id of a range go along: which of them comes first shows when sorted.
    ahead = firsts.withColumn("part", F.pmod(F.col("part") - 1, F.lit(len(bounds)))).withColumn("only_next", F.lit(True))
    return (
        rows.unionByName(ahead)
        .repartitionById(len(bounds), F.col("part"))
        .sortWithinPartitions("only_next", F.col("doc_id").asc_nulls_first(), "text")
    )


def compare_with_edits(docs: DataFrame, k: int = SHINGLE, bins: int = BINS, bits: int = BITS) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they and the next document's are.

    The edited text has the last floor(n_chars / 4) code points replaced by the first
    as many (or all) of the next document by doc_id, after the last by those of the
    first; null ids come first, equal ids go by text. Null texts are empty texts. The
    only document of a table is its own next one. An empty table gives no rows; other
    columns are not read.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple] = []  # the documents whose next one has not come yet
        size, ended = 0, False
        for batch in batches:
            if ended:
                continue
            for doc_id, text, only_next in zip(*(batch.column(i) for i in range(3)), strict=True):
                if ended:
                    break
                waiting.append((doc_id.as_py(), text.as_py()))
                size += len(waiting[-1][1])
                ended = only_next.as_py()
                if len(waiting) > 1 and (ended or size > blocks.BLOCK_BYTES or len(waiting) > 2000):
                    yield result(waiting)
                    waiting, size = waiting[-1:], len(waiting[-1][1])

    def result(rows: list[tuple]) -> pa.RecordBatch:
        texts = [t for _, t in rows]
        edited = []
        for text, following in zip(texts, texts[1:], strict=False):
            cut = len(text) // 4
            edited.append(text[: len(text) - cut] + following[:cut])
        tables = []
        for group in (texts, edited):
            parts = [bins_of(b, k, bins) for _, _, b in blocks.arrow_blocks(pa.array(group, pa.large_string()))]
            tables.append(np.concatenate(parts))
        own, changed = tables
        mine = own[:-1]
        return pa.record_batch(
            {
                "doc_id": pa.array([i for i, _ in rows[:-1]], pa.int64()),
                "n_chars": pa.array([len(t) for t in texts[:-1]], pa.int64()),
                "edited_sha256": [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in edited],
                "fingerprint": pa.array(packed(mine, bits), pa.string()),
                "edited_fingerprint": pa.array(packed(changed, bits), pa.string()),
                "near_edited": likeness(mine, changed, bits),
                "near_next": likeness(mine, own[1:], bits),
            }
        )

    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return with_next(rows).select("doc_id", "text", "only_next").mapInArrow(run, schema)
