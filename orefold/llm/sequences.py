"""Token ids in Arrow files of equal-length sequences.

A shard is a range of doc_id. Its documents' ids, each document ended by ``end_id``,
are one stream cut into sequences of ``LENGTH`` ids; the last is filled up and its mask
says so. An Arrow IPC file holds them as fixed-size lists in batches of ``ROWS``
sequences, so sequence i is row i % ROWS of batch i // ROWS and is read in place
from a memory map. A second file lists the documents with their places.

Each attempt of a task writes files of its own name; those of attempts that ended
well are named in a manifest, and only these are read.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Window, functions as F

from . import blocks, encoding
from .stored import id_ranges, new_folder, range_of, shuffle_partitions, stored

LENGTH = 1024
ROWS = 256
#: Distinct words that a Python worker remembers between batches.
REMEMBERED = 3_000_000

_memory: dict = {}


def _remembered(block: encoding.TextBlock, description: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts and starts of each distinct word's ids, and the ids.

    What a worker has encoded before is found by the word's 64-bit hash and not encoded again.
    """
    m, hashes = _memory, block.hashes
    if m.get("of") != description or len(m["hashes"]) > REMEMBERED:
        kind = encoding.id_type(description)
        m.update(of=description, hashes=np.zeros(0, np.uint64), place=np.zeros(0, np.int32))
        m.update(counts=np.zeros(0, np.int32), starts=np.zeros(0, np.int64), flat=np.zeros(0, kind))
    at = np.searchsorted(m["hashes"], hashes)
    there = np.minimum(at, max(len(m["hashes"]) - 1, 0))
    new = np.flatnonzero(m["hashes"][there] != hashes) if len(m["hashes"]) else np.arange(len(hashes))
    if len(new):
        ids = encoding.encode_words(block.words(new), description)
        counts = np.array([len(i) for i in ids], np.int32)
        n, used = len(m["counts"]), len(m["flat"])
        m["counts"] = np.append(m["counts"], counts)
        m["starts"] = np.append(m["starts"], used + np.cumsum(counts) - counts)
        m["flat"] = np.append(m["flat"], np.array([x for i in ids for x in i], m["flat"].dtype))
        every = np.append(m["hashes"], hashes[new])
        order = np.argsort(every, kind="stable")
        m["hashes"] = every[order]
        m["place"] = np.append(m["place"], np.arange(n, n + len(new), dtype=np.int32))[order]
        at = np.searchsorted(m["hashes"], hashes)
    place = m["place"][at]
    return m["counts"][place], m["starts"][place], m["flat"]


def encode_in_place(docs: DataFrame, description: str, end_id: int) -> DataFrame:
    """doc_id and ids (little-endian, two bytes if the vocabulary allows) of every row, with the end id."""
    shared = docs.sparkSession.sparkContext.broadcast(description)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, doc_ids, block in encoding._text_blocks(batches, 1):
            counts, starts, flat = _remembered(block, shared.value)
            n = counts[block.index]
            # The end id is one more word, after the last of each text.
            flat = np.append(flat, np.array([end_id], flat.dtype))
            after = np.cumsum(block.n_words)
            n = np.insert(n, after, 1)
            begin = np.insert(starts[block.index], after, len(flat) - 1)
            ids = flat[encoding.expanded(begin, n)]
            edges = np.append(0, np.cumsum(n))[np.append(0, np.cumsum(block.n_words + 1))]
            # Arrow's binary columns take 2 GB; a batch is far below.
            yield pa.record_batch([doc_ids, blocks.binary_array(ids, edges)], ["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, ids binary")


def _store(folder: str) -> tuple[fs.FileSystem, str]:
    system, path = fs.FileSystem.from_uri(folder)
    system.create_dir(path, recursive=True)
    return system, path


def write(docs: DataFrame, description: str, end_id: int, folder: str | None = None, length: int = LENGTH, rows: int = ROWS) -> DataFrame:
    """Write all documents in ascending doc_id order; returns the manifest, one row for each shard.

    Null ids come first, equal ids follow by their token ids. Null and empty texts are
    the end id alone. An empty table gives an empty manifest. Other columns are not read.
    """
    spark = docs.sparkSession
    folder = folder or new_folder(spark, "sequences")
    bounds = id_ranges(docs, shuffle_partitions(spark))
    wide = pa.uint16() if encoding.id_type(description) == "<u2" else pa.uint32()
    width = wide.bit_width // 8
    schema = pa.schema([("ids", pa.list_(wide, length)), ("mask", pa.list_(pa.uint8(), length))])
    listing = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = _store(folder)
        name, part, done, n_docs = f"{uuid.uuid4().hex}", None, 0, 0
        held = b""  # ids of a batch that is not full
        size = length * rows * width

        def batch_of(raw: bytes) -> pa.RecordBatch:
            ids = np.frombuffer(raw, f"<u{width}")
            n = -(-len(ids) // length) * length
            mask = np.arange(n) < len(ids)
            ids = np.concatenate([ids, np.zeros(n - len(ids), ids.dtype)])
            lists = [pa.FixedSizeListArray.from_arrays(pa.array(v, t), length) for v, t in ((ids, wide), (mask.view(np.uint8), pa.uint8()))]
            return pa.record_batch(lists, schema=schema)

        files = None
        for batch in batches:
            if not len(batch):
                continue
            if files is None:
                part = batch.column(0)[0].as_py()
                files = [system.open_output_stream(f"{path}/{name}.{end}") for end in ("arrow", "docs.arrow")]
                ids_file, docs_file = pa.ipc.new_file(files[0], schema), pa.ipc.new_file(files[1], listing)
            column = batch.column(2).cast(pa.large_binary())
            _, where, what = column.buffers()
            edges = np.frombuffer(where, np.int64)[column.offset : column.offset + len(column) + 1]
            n = np.diff(edges) // width
            starts = done + np.cumsum(n) - n
            docs_file.write_batch(pa.record_batch([batch.column(1), pa.array(starts), pa.array(n)], schema=listing))
            done, n_docs = done + int(n.sum()), n_docs + len(column)
            raw = memoryview(what)[int(edges[0]) : int(edges[-1])]
            at = 0
            while len(held) + len(raw) - at >= size:
                take = size - len(held)
                ids_file.write_batch(batch_of(held + bytes(raw[at : at + take])))
                held, at = b"", at + take
            held += bytes(raw[at:])
        if files is None:
            return
        if held:
            ids_file.write_batch(batch_of(held))
        for writer, file in ((ids_file, files[0]), (docs_file, files[1])):
            writer.close()
            file.close()
        yield pa.record_batch(
            {"part": pa.array([part], pa.int32()), "file": [f"{folder}/{name}"], "n_docs": pa.array([n_docs], pa.int64()), "n_ids": pa.array([done], pa.int64())}
        )

    encoded = encode_in_place(docs, description, end_id)
    placed = (
        encoded.select(range_of(F.col("doc_id"), bounds).alias("part"), "doc_id", "ids")
        .repartitionById(len(bounds), F.col("part"))
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "ids")
    )
    return stored(placed.mapInArrow(run, "part int, file string, n_docs long, n_ids long"), "sequences_manifest")


class Sequences:
    """Random access to a shard's sequences; local files are read in place from a memory map."""

    def __init__(self, file: str):
        system, path = fs.FileSystem.from_uri(file)
        local = isinstance(system, fs.LocalFileSystem)
        opened = [pa.memory_map(f"{path}.{e}") if local else system.open_input_file(f"{path}.{e}") for e in ("arrow", "docs.arrow")]
        self.ids, self.docs = map(pa.ipc.open_file, opened)
        self.rows = self.ids.get_batch(0).num_rows if self.ids.num_record_batches else 0

    def __getitem__(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and mask of sequence i, both in place: a byte of the file is a truth value."""
        ids, mask = self.ids.get_batch(i // self.rows).columns
        i %= self.rows
        return ids[i].values.to_numpy(), mask[i].values.to_numpy().view(np.bool_)

    def stream(self) -> Iterator[np.ndarray]:
        """The ids of each batch that the mask holds for, in place."""
        for i in range(self.ids.num_record_batches):
            ids, mask = self.ids.get_batch(i).columns
            yield ids.flatten().to_numpy()[: np.count_nonzero(mask.flatten().to_numpy())]

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """doc_id, start in the shard and ids of each document."""
        held, at = np.zeros(0, np.uint16), 0
        stream = self.stream()
        for i in range(self.docs.num_record_batches):
            for doc_id, start, n in zip(*(c.to_pylist() for c in self.docs.get_batch(i).columns), strict=True):
                parts, have = [held[at:]], len(held) - at
                while have < n:
                    parts.append(next(stream))
                    have += len(parts[-1])
                if len(parts) > 1:
                    held, at = np.concatenate(parts), 0
                yield doc_id, start, held[at : at + n]
                at += n


def read(manifest: DataFrame) -> DataFrame:
    """doc_id, start over all shards, n_tokens and ids_crc32 of every document, from the files of the manifest."""
    # One row for each shard; their sums are run up in one small task.
    before = F.coalesce(F.sum("n_ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shards = manifest.select("part", "file", before.cast("long").alias("base"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, file, base in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                out: list[tuple] = []
                for doc_id, start, ids in Sequences(file).documents():
                    out.append((doc_id, base + start, len(ids), zlib.crc32(ids.astype("<u4"))))
                    if len(out) == 10_000:
                        yield _listed(out)
                        out = []
                yield _listed(out)

    n = max(1, shuffle_partitions(manifest.sparkSession))
    return shards.repartition(n, "part").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _listed(rows: list[tuple]) -> pa.RecordBatch:
    names = ["doc_id", "start", "n_tokens", "ids_crc32"]
    return pa.record_batch([pa.array([r[i] for r in rows], pa.int64()) for i in range(4)], names)
