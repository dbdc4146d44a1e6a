"""BPE encoding by a table of distinct words, and decoding.

Texts are split into words at ASCII white space, in blocks of neighbouring texts.
A block names each of its distinct words once, and the distinct words of all blocks
are dealt out by a hash of the word: one task meets a word from all blocks and encodes
it once. Its ids go back to the blocks that asked, where they are put at the word's
positions. So a frequent word moves once a block, not once an occurrence, and no
task holds more than a block or its share of the distinct words.

This holds for vocabularies whose pieces don't cross white space (with word ends,
white space dropped). Decoding looks each document's ids up in a table of pieces, as many as
the vocabulary has: ``decode_ids`` as a join of rows, ``encode`` in its blocks, so that ids
need no shuffle of their own.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from . import blocks
from .stored import shuffle_partitions

#: Bytes of text in a block.
BLOCK_TEXT = 6 << 20


def vocabulary(path: str) -> str:
    """The tokenizer file as text, for tasks on hosts that don't have the file."""
    with open(path, encoding="utf-8") as file:
        return file.read()


@lru_cache(2)
def tokenizer(description: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    made = Tokenizer.from_str(description)
    made.no_truncation()
    made.no_padding()
    return made


def id_type(description: str) -> str:
    return "<u2" if tokenizer(description).get_vocab_size() <= 1 << 16 else "<u4"


def encode_words(words: list[bytes], description: str) -> list[list[int]]:
    made = tokenizer(description)
    out: list[list[int]] = []
    for i in range(0, len(words), 10_000):
        batch = [w.decode("utf-8", "replace") for w in words[i : i + 10_000]]
        out += [e.ids for e in made.encode_batch_fast(batch, add_special_tokens=False)]
    return out


class TextBlock:
    """Neighbouring texts with their distinct words, ordered by shard and hash.

    ``index``: which distinct word each word is; ``n_words``: words of each text;
    ``bounds``: where the words of each shard start.
    """

    def __init__(self, column: pa.Array, n_shards: int):
        parts, starts, ends, counts = [], [], [], []
        column = column.cast(pa.large_binary()).fill_null(b"")
        _, where, what = column.buffers()
        offsets = np.frombuffer(where, np.int64)[column.offset : column.offset + len(column) + 1]
        self.data = np.frombuffer(what, np.uint8) if what is not None and what.size else np.zeros(0, np.uint8)
        for lo, _, block in blocks.arrow_blocks(column):
            parts.append(block.word_hash())
            starts.append(block.starts + offsets[lo])
            ends.append(block.ends + offsets[lo])
            counts.append(block.n_words)
        hashes = np.concatenate(parts)
        self.n_words = np.concatenate(counts)
        distinct, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        shard = (distinct % np.uint64(n_shards)).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        self.index = place[inverse]
        self.bounds = np.searchsorted(shard[order], np.arange(n_shards + 1))
        self.hashes = distinct[order]
        self.starts, self.ends = np.concatenate(starts)[first[order]], np.concatenate(ends)[first[order]]
        self.mark = int(blocks.mix(np.array([np.bitwise_xor.reduce(distinct), len(hashes)], np.uint64))[0])

    def words(self, which: slice | np.ndarray) -> list[bytes]:
        data = memoryview(self.data)
        return [bytes(data[a:b]) for a, b in zip(self.starts[which].tolist(), self.ends[which].tolist(), strict=True)]


def _text_blocks(batches: Iterator[pa.RecordBatch], n_shards: int) -> Iterator[tuple[str, pa.Array, TextBlock]]:
    """Blocks of a task's rows (doc_id, text), with a name that shows where and from what they were made."""
    part, number = TaskContext.get().partitionId(), 0
    for batch in batches:
        column = batch.column(1).cast(pa.large_binary())
        sizes = np.cumsum(pc.binary_length(column).fill_null(0).to_numpy(zero_copy_only=False))
        lo = 0
        while lo < len(column):
            before = sizes[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(sizes, before + BLOCK_TEXT, side="right")))
            block = TextBlock(column.slice(lo, hi - lo), n_shards)
            yield f"{part}-{number}-{block.mark:x}", batch.column(0).slice(lo, hi - lo), block
            number += 1
            lo = hi


def _words(batches: Iterator[pa.RecordBatch], n_shards: int) -> Iterator[pa.RecordBatch]:
    for name, _, block in _text_blocks(batches, n_shards):
        for shard in range(n_shards):
            lo, hi = block.bounds[shard : shard + 2]
            if hi > lo:
                words = packed(b" ".join(block.words(slice(lo, hi))))
                yield pa.record_batch([[name], pa.array([shard], pa.int32()), words], ["block", "shard", "words"])


def _places(batches: Iterator[pa.RecordBatch], n_shards: int) -> Iterator[pa.RecordBatch]:
    for name, ids, block in _text_blocks(batches, n_shards):
        # First bytes, second bytes and so on apart: they compress better than mixed.
        planes = block.index.astype("<u4").view(np.uint8).reshape(-1, 4).T
        columns = [[name], blocks_list(ids.cast(pa.int64())), blocks_list(pa.array(block.n_words.astype(np.int64)))]
        yield pa.record_batch([*columns, packed(planes.tobytes())], ["block", "doc_ids", "n_words", "places"])


def packed(raw: bytes) -> pa.BinaryArray:
    """One value, its length in eight bytes and then its bytes compressed."""
    return pa.array([len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)], pa.binary())


def unpacked(raw: bytes) -> bytes:
    return pa.decompress(raw[8:], int.from_bytes(raw[:8], "little"), "zstd", asbytes=True)


def blocks_list(values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def encode(docs: DataFrame, description: str, decode: bool = True) -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit integers) and, if asked, the decoded text of every row.

    Null and empty texts have no ids and decode to an empty text. Repeated rows come
    out as often as they are there, an empty table gives no rows, further columns are
    not read. ``docs`` is read twice and must give the same rows in the same order,
    as a table read from files does; else the job fails, and never mixes texts up.
    """
    spark = docs.sparkSession
    n_shards = shuffle_partitions(spark)
    shared = spark.sparkContext.broadcast(description)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    words = rows.mapInArrow(lambda b: _words(b, n_shards), "block string, shard int, words binary")

    def encode_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}  # the distinct words of this task's shards, encoded once
        counts, flat = np.zeros(0, np.int64), np.zeros(0, np.uint32)
        starts = np.zeros(1, np.int64)
        kind = id_type(shared.value)
        waiting: list[tuple] = []

        def answered() -> Iterator[pa.RecordBatch]:
            nonlocal counts, flat, starts
            new = [w for w in dict.fromkeys(w for _, _, ws in waiting for w in ws) if w not in known]
            if new:
                ids = encode_words(new, shared.value)
                known.update(zip(new, range(len(known), len(known) + len(new)), strict=True))
                counts = np.append(counts, [len(i) for i in ids])
                flat = np.append(flat, np.array([x for i in ids for x in i], np.uint32))
                starts = np.append(0, np.cumsum(counts))
            for block, shard, ws in waiting:
                at = np.fromiter((known[w] for w in ws), np.int64, len(ws))
                n = counts[at]
                own = flat[expanded(starts[at], n)].astype(kind)
                yield pa.record_batch(
                    [[block], pa.array([shard], pa.int32()), packed(n.astype("<u4").tobytes()), packed(own.tobytes())],
                    ["block", "shard", "counts", "ids"],
                )
            waiting.clear()

        size = 0
        for batch in batches:
            for block, shard, joined in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                waiting.append((block, shard, unpacked(joined).split(b" ")))
                size += len(joined)
                if size > blocks.BLOCK_BYTES:
                    yield from answered()
                    size = 0
        yield from answered()

    answers = words.repartition(n_shards, "shard").mapInArrow(encode_shard, "block string, shard int, counts binary, ids binary")
    places = rows.mapInArrow(
        lambda b: _places(b, n_shards), "block string, doc_ids array<long>, n_words array<long>, places binary"
    )

    def put_back(asked: pa.Table, got: pa.Table) -> pa.Table:
        if asked.num_rows != 1:
            raise ValueError("the documents were read in another order the second time; store them first")
        one = asked.to_pylist()[0]
        got = sorted(got.to_pylist(), key=lambda r: r["shard"])
        kind = id_type(shared.value)
        counts = np.concatenate([np.frombuffer(unpacked(r["counts"]), "<u4") for r in got] or [np.zeros(0, "<u4")]).astype(np.int64)
        flat = np.concatenate([np.frombuffer(unpacked(r["ids"]), kind) for r in got] or [np.zeros(0, kind)])
        starts = np.append(0, np.cumsum(counts))
        planes = np.frombuffer(unpacked(one["places"]), np.uint8).reshape(4, -1)
        index = np.ascontiguousarray(planes.T).view("<u4").ravel()
        n_words = np.array(one["n_words"], np.int64)
        n = counts[index]
        ids = flat[expanded(starts[index], n)].astype("<u4")
        ends = np.append(0, np.cumsum(n))[np.append(0, np.cumsum(n_words))]
        out = {"doc_id": pa.array(one["doc_ids"], pa.int64()), "ids": blocks.binary_array(ids, ends)}
        if decode:
            # The documents' own ids, in the order in which they are returned.
            out["decoded"] = decoded(ids, ends, *_piece_table(shared.value))
        return pa.table(out)

    schema = "doc_id long, ids binary" + ", decoded string" * decode
    return places.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(put_back, schema)


def expanded(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1 ... for counts[0] places, then the same from starts[1], and so on."""
    total = np.cumsum(counts)
    if not len(total) or not total[-1]:
        return np.zeros(0, np.int64)
    return np.arange(total[-1]) + np.repeat(starts - (total - counts), counts)


@lru_cache(2)
def _pieces(description: str) -> list[str]:
    """id to piece. A tokenizer without decoder joins pieces by blanks, as is done here."""
    if json.loads(description).get("decoder"):
        raise ValueError("only vocabularies without a decoder are put together by blanks")
    vocab = tokenizer(description).get_vocab()
    out = [""] * (max(vocab.values(), default=-1) + 1)
    for piece, i in vocab.items():
        out[i] = piece
    return out


@lru_cache(2)
def _piece_table(description: str) -> tuple[np.ndarray, np.ndarray]:
    """The id-to-piece table: all pieces with a blank after each, as bytes, and where each id's starts."""
    pieces = [p.encode("utf-8") + b" " for p in _pieces(description)]
    return np.frombuffer(b"".join(pieces), np.uint8), np.append(0, np.cumsum([len(p) for p in pieces]))


def decoded(ids: np.ndarray, ends: np.ndarray, data: np.ndarray, starts: np.ndarray) -> pa.Array:
    """The text of each document (ids from one of ``ends`` to the next), by looking its ids up in the table."""
    out = []
    lo = 0
    while lo < len(ends) - 1:
        # Some documents at once, so that the bytes of one step stay few.
        hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + (1 << 18), side="right")) - 1)
        own = ids[ends[lo] : ends[hi]].astype(np.int64)
        sizes = starts[own + 1] - starts[own]
        text = data[expanded(starts[own], sizes)]
        edges = np.append(0, np.cumsum(sizes))[ends[lo : hi + 1] - ends[lo]].tolist()
        raw = text.tobytes()
        out += [raw[a : max(a, b - 1)].decode("utf-8") for a, b in zip(edges, edges[1:], strict=False)]
        lo = hi
    return pa.array(out, pa.string())


def decode_ids(rows: DataFrame, description: str) -> DataFrame:
    """``rows`` with ``decoded``, from an ``ids`` array column: a join of positions with the table of pieces.

    The table is as large as the vocabulary and is broadcast. Null ids give null, none give an empty text.
    """
    table = rows.sparkSession.createDataFrame(list(enumerate(_pieces(description))), "id long, piece string")
    keyed = rows.withColumn("_row", F.monotonically_increasing_id())
    each = keyed.select("_row", F.posexplode("ids").alias("at", "id")).join(F.broadcast(table), "id")
    spelled = each.groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("at", "piece"))).alias("pieces"))
    text = F.coalesce(F.array_join(F.transform("pieces", lambda p: p["piece"]), " "), F.lit(""))
    joined = keyed.join(spelled, "_row", "left")
    return joined.withColumn("decoded", F.when(F.col("ids").isNotNull(), text)).drop("_row", "pieces")
