"""Cross-tokenizer alignment by lockstep merging of token ends.

Each text is encoded by a byte-level vocabulary (A) and by a piece vocabulary (B). Where a
token of both ends at the same byte, the text is cut; all tokens of A and of B between two
cuts form a group and are linked with each other. The merge of A's and B's ends runs for all
documents of a block at once: one state vector holds each document's place in A and in B, every
step moves the side that is behind (both, and emits a cut, where they are level), and finished
documents are taken out of the vector. Long documents are several rows of it, parted where
white space makes both vocabularies begin a new token.

Texts are encoded by stretches, a blank and what follows up to the next such blank. Neither
vocabulary has a token across their borders, so each distinct stretch is encoded once.

How many documents hold a pair of ids linked is counted in each block first, so few rows are
shuffled: one for each pair and block. Blocks keep their pairs in a stored table, and the
corpus-wide counts come back to the block that asked.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from . import blocks
from .encoding import expanded, packed, tokenizer, unpacked
from .stored import stored

#: Bytes of text in a block.
BLOCK_TEXT = 2 << 20
#: Stretches of a document that make one row of the state vector.
ROW_STRETCHES = 256
#: Stretches a task remembers; with more it starts anew.
KNOWN = 1_000_000
#: Stretches that are encoded at once.
ENCODED = 5_000
#: Groups with more links are counted by distinct ids instead of link by link.
LONG_GROUP = 4096

LINKED = (
    "block string, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
    "groups array<string>, n_pairs array<long>, pairs binary, times binary, keys array<long>, docs array<long>"
)
DIGESTS = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"

#: Bytes that may be, or end, white space of any script; before such a blank no stretch ends.
_OPEN = np.zeros(256, bool)
_OPEN[:0x21] = True
_OPEN[[0x7F, 0x85, *range(0x80, 0x8B), 0x9F, 0xA0, 0xA8, 0xA9, 0xAF]] = True


@lru_cache(2)
def pieces(model: bytes):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=model)


@lru_cache(2)
def bytes_of_a(description: str) -> list[bytes]:
    """Byte-level decoded tokens by id. Printable bytes stand for themselves, the others for characters from 256 on, in order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    byte = {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}
    vocab = json.loads(description)["model"]["vocab"]
    out = [b""] * (max(vocab.values(), default=-1) + 1)
    for token, i in vocab.items():
        out[i] = bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()
    return out


@lru_cache(2)
def bytes_of_b(model: bytes) -> list[bytes]:
    made = pieces(model)
    out = []
    for i in range(made.get_piece_size()):
        piece = made.id_to_piece(i)
        out.append(bytes([int(piece[3:5], 16)]) if made.is_byte(i) else piece.replace("▁", " ").encode("utf-8"))
    return out


class Stretches:
    """Ids of all stretches met so far, by hash, in flat arrays for each vocabulary."""

    def __init__(self, description: str, model: bytes):
        self.a, self.b = tokenizer(description), pieces(model)
        self.a.encode_special_tokens = True
        self.spelled_a, self.spelled_b = bytes_of_a(description), bytes_of_b(model)
        self.clear()

    def clear(self) -> None:
        self.hashes, self.place = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.ids = {s: np.zeros(0, np.int32) for s in "ab"}
        self.first = {s: np.zeros(1, np.int64) for s in "ab"}
        self.whole = np.zeros(0, bool)

    def learn(self, hashes: np.ndarray, data: memoryview, starts: np.ndarray, ends: np.ndarray) -> None:
        """``hashes``: distinct and new."""
        known = len(self.whole)
        raw = [bytes(data[s:e]) for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]
        whole, ids, counts = [self.whole], {s: [self.ids[s]] for s in "ab"}, {s: [] for s in "ab"}
        spell = lambda some, of: b"".join([of[i] for i in some])
        for lo in range(0, len(raw), ENCODED):
            some = raw[lo : lo + ENCODED]
            texts = [r.decode("utf-8") for r in some]
            ids_a = [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]
            ids_b = self.b.encode([t[1:] for t in texts], num_threads=1)  # puts a blank before each text
            whole.append(np.array([spell(x, self.spelled_a) == r == spell(y, self.spelled_b) for x, y, r in zip(ids_a, ids_b, some, strict=True)], bool))
            for s, own in (("a", ids_a), ("b", ids_b)):
                counts[s].append(np.fromiter(map(len, own), np.int64, len(own)))
                ids[s].append(np.array([i for x in own for i in x], np.int32))
        self.whole = np.concatenate(whole)
        for s in "ab":
            self.ids[s] = np.concatenate(ids[s])
            self.first[s] = np.append(self.first[s], self.first[s][-1] + np.cumsum(np.concatenate(counts[s])))
        order = np.argsort(hashes)
        at = np.searchsorted(self.hashes, hashes[order])
        self.hashes = np.insert(self.hashes, at, hashes[order])
        self.place = np.insert(self.place, at, known + order)

    def find(self, block: blocks.Block, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The place of each stretch, encoding those not met before."""
        hashes = block.span_hash(starts, ends)
        distinct, first = np.unique(hashes, return_index=True)
        if len(self.whole) + len(distinct) > KNOWN:
            self.clear()
        new = ~np.isin(distinct, self.hashes, assume_unique=True)
        if new.any():
            # Distinct ones come sorted by hash.
            self.learn(distinct[new], memoryview(block.data), starts[first[new]], ends[first[new]])
        return self.place[np.searchsorted(self.hashes, hashes)]

    def tokens(self, side: str, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the stretches in their order, and how many each has."""
        first = self.first[side]
        counts = first[places + 1] - first[places]
        return self.ids[side][expanded(first[places], counts)], counts


def lockstep(end_a: np.ndarray, end_b: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Groups (first token of A, after its last, first of B, after its last) of all rows, in the order of A.

    ``rows``: first and after the last token of A and the first of B, of each row of the state.
    """
    at_a, stop, at_b = rows[rows[:, 0] < rows[:, 1]].T.copy()
    from_a, from_b = at_a.copy(), at_b.copy()
    out = [np.zeros((4, 0), np.int64)]
    while len(at_a):
        a, b = end_a[at_a], end_b[at_b]
        cut = a == b
        at_a += a <= b
        at_b += b <= a
        if cut.any():
            out.append(np.stack([from_a[cut], at_a[cut], from_b[cut], at_b[cut]]))
            from_a, from_b = np.where(cut, at_a, from_a), np.where(cut, at_b, from_b)
        live = at_a < stop
        if not live.all():
            at_a, at_b, from_a, from_b, stop = at_a[live], at_b[live], from_a[live], from_b[live], stop[live]
    groups = np.concatenate(out, axis=1)
    return groups[:, np.argsort(groups[0])]


@lru_cache(1)
def _digits() -> tuple[np.ndarray, np.ndarray]:
    """Decimal numbers below 10^6, as bytes from the left, and their lengths."""
    n = np.arange(10**6)
    length = np.ones(len(n), np.int64)
    for p in range(1, 6):
        length += n >= 10**p
    table = np.zeros((len(n), 7), np.uint8)
    for i in range(6):
        has = length > i
        table[has, i] = 48 + n[has] // 10 ** (length[has] - 1 - i) % 10
    return table, length


def spelled(ids_a: np.ndarray, ids_b: np.ndarray, groups: np.ndarray, docs: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The groups of each of ``n`` documents as ``a1,a2|b1;a3|b2,b3``: all bytes, and where each document's start."""
    table, length = _digits()
    first_a, last_a, first_b, last_b = groups
    ids = np.empty(len(ids_a) + len(ids_b), np.int64)
    # A's tokens of a group come after B's of all groups before, B's after A's of their own group.
    ids[np.arange(len(ids_a)) + np.repeat(first_b, last_a - first_a)] = ids_a
    ids[np.arange(len(ids_b)) + np.repeat(last_a, last_b - first_b)] = ids_b
    after = np.full(len(ids), ord(","), np.uint8)
    after[last_a + first_b - 1] = ord("|")
    after[last_a + last_b - 1] = ord(";")
    final = np.append(docs[1:] != docs[:-1], True) if len(docs) else np.zeros(0, bool)
    after[(last_a + last_b - 1)[final]] = 0
    written, size = table[ids], length[ids]
    written[np.arange(len(ids)), size] = after
    at = np.append(0, np.cumsum(size + (after != 0)))
    tokens = np.bincount(docs, weights=(last_a - first_a + last_b - first_b).astype(float), minlength=n).astype(np.int64)
    return written[written != 0], at[np.append(0, np.cumsum(tokens))]


def _links(ids_a: np.ndarray, ids_b: np.ndarray, groups: np.ndarray, docs: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document, pair of ids), as one number, the document in the upper half, and how often each is linked."""
    first_a, last_a, first_b, last_b = groups
    n_a, n_b = last_a - first_a, last_b - first_b
    short = n_a * n_b <= LONG_GROUP
    at = expanded(first_a[short], n_a[short])
    times = np.repeat(n_b[short], n_a[short])
    a = np.repeat(ids_a[at], times)
    b = ids_b[expanded(np.repeat(first_b[short], n_a[short]), times)]
    doc = np.repeat(np.repeat(docs[short], n_a[short]), times)
    found = (doc.astype(np.uint64) << np.uint64(32)) + a.astype(np.uint64) * np.uint64(width) + b.astype(np.uint64)
    found, often = np.unique(found, return_counts=True)
    more, many = [found], [often]
    for g in np.flatnonzero(~short):
        a, of_a = np.unique(ids_a[first_a[g] : last_a[g]], return_counts=True)
        b, of_b = np.unique(ids_b[first_b[g] : last_b[g]], return_counts=True)
        key = a.astype(np.uint64)[:, None] * np.uint64(width) + b.astype(np.uint64)
        more.append((key + (np.uint64(docs[g]) << np.uint64(32))).ravel())
        many.append((of_a[:, None] * of_b).ravel())
    if len(more) == 1:
        return found, often
    found, inverse = np.unique(np.concatenate(more), return_inverse=True)
    total = np.zeros(len(found), np.int64)
    np.add.at(total, inverse, np.concatenate(many))
    return found, total


def align_block(column: pa.Array, known: Stretches) -> dict:
    """All numbers of the documents of one block, with its linked pairs."""
    n = len(column)
    _, where, what = column.buffers()
    offsets = np.frombuffer(where, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(what, np.uint8)[offsets[0] : offsets[-1]] if what is not None else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    some = np.diff(offsets) > 0
    # A blank before each text; texts without bytes have no tokens.
    data = np.insert(data, offsets[:-1][some], 0x20)
    first = np.append(0, np.cumsum(np.where(some, np.diff(offsets) + 1, 0)))
    block = blocks.Block(data, first)
    is_start = data == 0x20
    is_start[1:] &= ~_OPEN[data[:-1]]
    is_start[first[1:][some] - 1] = False
    is_start[first[:-1][some]] = True
    starts = np.flatnonzero(is_start)
    ends = np.append(starts[1:], len(data))
    places = known.find(block, starts, ends)
    doc = np.repeat(np.arange(n), np.diff(np.searchsorted(starts, first)))
    broken = np.zeros(n, bool)
    broken[doc[~known.whole[places]]] = True
    places, doc = places[~broken[doc]], doc[~broken[doc]]
    ids_a, of_a = known.tokens("a", places)
    ids_b, of_b = known.tokens("b", places)
    size_a = np.fromiter(map(len, known.spelled_a), np.int64, len(known.spelled_a))
    size_b = np.fromiter(map(len, known.spelled_b), np.int64, len(known.spelled_b))
    # Rows of the state begin with documents and with every so many of their stretches.
    in_doc = np.arange(len(doc)) - np.searchsorted(doc, doc)
    new_row = np.flatnonzero(in_doc % ROW_STRETCHES == 0)
    at_a, at_b = np.append(0, np.cumsum(of_a)), np.append(0, np.cumsum(of_b))
    rows = np.stack([at_a[new_row], np.append(at_a[new_row[1:]], at_a[-1])[: len(new_row)], at_b[new_row]], axis=1)
    groups = lockstep(np.cumsum(size_a[ids_a]), np.cumsum(size_b[ids_b]), rows)
    group_doc = np.repeat(doc, of_a)[groups[0]]
    text, edges = spelled(ids_a, ids_b, groups, group_doc, n)
    raw = memoryview(np.ascontiguousarray(text))
    has = np.bincount(group_doc, minlength=n)
    pairs, times = _links(ids_a, ids_b, groups, group_doc, len(known.spelled_b))
    keys = (pairs & np.uint64(0xFFFFFFFF)).astype("<u4")
    distinct, docs = np.unique(keys, return_counts=True)
    count = lambda which, of: np.bincount(which, weights=of, minlength=n).astype(np.int64)
    return {
        "n_a": count(doc, of_a),
        "n_b": count(doc, of_b),
        "n_groups": has,
        "n_links": count(group_doc, (groups[1] - groups[0]) * (groups[3] - groups[2])),
        "groups": [hashlib.sha256(raw[s:e]).hexdigest() if h else "" for s, e, h in zip(edges.tolist(), edges[1:].tolist(), has.tolist(), strict=False)],
        "n_pairs": np.bincount((pairs >> np.uint64(32)).astype(np.int64), minlength=n),
        "pairs": keys,
        "times": times,
        "keys": distinct,
        "docs": docs,
    }


def _planes(values: np.ndarray, kind: str) -> pa.Array:
    size = int(kind[2])
    return packed(values.astype(kind).view(np.uint8).reshape(-1, size).T.tobytes())


def _from_planes(raw: bytes, kind: str) -> np.ndarray:
    planes = np.frombuffer(unpacked(raw), np.uint8).reshape(int(kind[2]), -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _aligned(batches: Iterator[pa.RecordBatch], description: str, model: bytes) -> Iterator[pa.RecordBatch]:
    known = Stretches(description, model)
    if len(known.spelled_a) * len(known.spelled_b) > 1 << 32 or max(len(known.spelled_a), len(known.spelled_b)) > 10**6:
        raise ValueError("pairs of ids of these vocabularies don't fit 32 bits")
    part, number = TaskContext.get().partitionId(), 0
    one = lambda values: pa.array([values], pa.list_(pa.int64()))
    for batch in batches:
        column = batch.column(1).cast(pa.large_binary()).fill_null(b"")
        sizes = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False))
        lo = 0
        while lo < len(column):
            before = sizes[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(sizes, before + BLOCK_TEXT, side="right")))
            made = align_block(column.slice(lo, hi - lo), known)
            ids = batch.column(0).slice(lo, hi - lo)
            yield pa.record_batch(
                [
                    [f"{part}-{number}"],
                    pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                    *(one(made[c]) for c in ("n_a", "n_b", "n_groups", "n_links")),
                    pa.array([made["groups"]], pa.list_(pa.string())),
                    one(made["n_pairs"]),
                    _planes(made["pairs"], "<u4"),
                    _planes(made["times"], "<u8"),
                    one(made["keys"].astype(np.int64)),
                    one(made["docs"]),
                ],
                ["block", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "n_pairs", "pairs", "times", "keys", "docs"],
            )
            number += 1
            lo = hi


def _digest(asked: pa.Table, got: pa.Table) -> pa.Table:
    """The documents of one block with what the whole corpus says of their pairs."""
    one = {c: asked.column(c)[0] for c in asked.column_names}
    keys = got.column("key").to_numpy()
    order = np.argsort(keys)
    keys, held, best = keys[order], got.column("held").to_numpy()[order], got.column("best").to_numpy(zero_copy_only=False)[order]
    pairs, times = _from_planes(one["pairs"].as_py(), "<u4").astype(np.int64), _from_planes(one["times"].as_py(), "<u8").astype(np.int64)
    at = np.searchsorted(keys, pairs)
    n_pairs = one["n_pairs"].values.to_numpy()
    edges = np.append(0, np.cumsum(n_pairs))
    total = lambda x: np.diff(np.append(0, np.cumsum(x))[edges])
    return pa.table(
        {
            **{c: one[c].values for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")},
            "n_best": total(times * best[at]),
            "count_sum": total(times * held[at]),
            "groups_sha256": one["groups"].values,
        }
    )


def linked_blocks(docs: DataFrame, description: str, model: bytes) -> DataFrame:
    """Blocks of documents with their links (``LINKED``), stored: what is not shuffled again is read from there."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((description, model))
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return stored(rows.mapInArrow(lambda b: _aligned(b, *shared.value), LINKED), "alignment_blocks")


def pair_counts(linked: DataFrame) -> DataFrame:
    """key (id of A times the size of B, plus id of B) and held: how many documents hold the pair linked."""
    rows = linked.select(F.explode(F.arrays_zip("keys", "docs")).alias("p"))
    return rows.groupBy(F.col("p.keys").alias("key")).agg(F.sum("p.docs").alias("held"))


def align(docs: DataFrame, description: str, model: bytes) -> DataFrame:
    """Counts of tokens, groups and links of every row, and how common its links are in the corpus.

    ``n_best``: links whose pair has the highest count of its id of A, ties included; ``count_sum``:
    counts added up over links; ``groups_sha256``: of ``a1,a2|b1;a3|b2,b3``. Null and empty texts,
    and those that either vocabulary doesn't give back byte by byte, have zeros and an empty digest.
    Every row is a document of its own, repeated rows too; a null id stays null; an empty table
    gives no rows; further columns are not read. Strings of special tokens are ordinary text.
    """
    width = len(bytes_of_b(model))
    linked = linked_blocks(docs, description, model)
    counts = stored(pair_counts(linked).withColumn("a", F.expr(f"key div {width}")), "alignment_counts")
    # One row for each id of A: as many as that vocabulary has.
    highest = counts.groupBy("a").agg(F.max("held").alias("highest"))
    counts = counts.join(F.broadcast(highest), "a").select("key", "held", (F.col("held") == F.col("highest")).alias("best"))
    wanted = linked.select(F.col("block").alias("asker"), F.explode("keys").alias("key")).join(counts, "key")
    asked = linked.drop("keys", "docs")
    return asked.groupBy("block").cogroup(wanted.groupBy("asker")).applyInArrow(_digest, DIGESTS)
