"""Centroid clustering by dimension-sharded Lloyd rounds.

Vectors become integers, ``floor(scale * x)``, and are cut into blocks of rows and into
shards of ``width`` neighbouring components. A task that holds a (block, shard) piece
knows that shard's slice of the centroids alone and gives the exact partial distances of
its rows; the pieces of a block are added up and each row takes its nearest centroid.
The assignment, a number a row, goes back to the pieces, and every shard adds up its own
components by centroid and makes its own next slice. All is integer arithmetic, so the
result does not depend on tasks, their order or retries.

Only centroids (``k`` times ``dims`` numbers) pass through the driver. Pieces are written
once, bucketed by block, so a round moves partial distances and assignments but no vectors.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from . import encoding
from .stored import new_folder, remove_folder, stored

#: Rows of a block, at most, and components of a shard.
BLOCK_ROWS = 8192
WIDTH = 32
#: Bytes of pieces that one task reads.
TASK_BYTES = 64 << 20
#: Components beyond this, either way, count as this: squared distances of 64 such ones still fit 64 bits.
LIMIT = 1 << 27


def integers(column: pa.Array, dims: int, scale: float) -> np.ndarray:
    """Rows by components."""
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    scaled = np.floor(flat.reshape(-1, dims) * scale)
    return np.clip(scaled, -LIMIT, LIMIT).astype(np.int64)


def narrow(values: np.ndarray) -> bytes:
    """The values in as few bytes as they fit, their type first, compressed."""
    kind = next(t for t in ("<i2", "<i4", "<i8") if not values.size or np.iinfo(t).min <= values.min() <= values.max() <= np.iinfo(t).max)
    raw = np.ascontiguousarray(values.astype(kind).reshape(-1)).view(np.uint8)
    # First bytes, second bytes and so on apart: they compress better than mixed.
    size = int(kind[2])
    return encoding.packed(bytes([size]) + raw.reshape(-1, size).T.tobytes())[0].as_py()


def widened(raw: bytes) -> np.ndarray:
    raw = encoding.unpacked(raw)
    size = raw[0]
    planes = np.frombuffer(raw, np.uint8, offset=1).reshape(size, -1)
    return np.ascontiguousarray(planes.T).view(f"<i{size}").ravel().astype(np.int64)


def _pieces(batches: Iterator[pa.RecordBatch], dims: int, scale: float, width: int) -> Iterator[pa.RecordBatch]:
    part, number = TaskContext.get().partitionId(), 0
    for batch in batches:
        for lo in range(0, batch.num_rows, BLOCK_ROWS):
            cut = batch.slice(lo, BLOCK_ROWS)
            ids, whole = cut.column(0), integers(cut.column(1), dims, scale)
            given = ids.is_valid().to_numpy(zero_copy_only=False).astype(np.int64)
            shards = range(0, dims, width)
            yield pa.record_batch(
                [
                    [f"{part}-{number}"] * len(shards),
                    pa.array([c // width for c in shards], pa.int32()),
                    pa.array([narrow(whole[:, c : c + width]) for c in shards], pa.binary()),
                    # One piece of a block knows the rows' ids and which of them are given.
                    pa.array([narrow(np.stack([ids.fill_null(0).to_numpy(), given])) if not c else None for c in shards], pa.binary()),
                ],
                ["block", "shard", "data", "ids"],
            )
            number += 1


def _squares(rows: np.ndarray, slice_: np.ndarray) -> np.ndarray:
    """Rows by centroids: exact squared distances over the components of one shard."""
    out = np.empty((len(rows), len(slice_)), np.int64)
    for j, centre in enumerate(slice_):
        apart = rows - centre
        out[:, j] = np.einsum("ij,ij->i", apart, apart)
    return out


def _partial(batches: Iterator[pa.RecordBatch], slices: list[np.ndarray], ids: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block, shard, data, own in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            of = slices[shard]
            squares = _squares(widened(data).reshape(-1, of.shape[1]), of)
            yield pa.record_batch(
                [[block], pa.array([narrow(squares)], pa.binary()), pa.array([own if ids else None], pa.binary())], ["block", "squares", "ids"]
            )


def _nearest(table: pa.Table, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Each row's centroid, the least number of equally near ones, and its squared distance."""
    total = 0
    for raw in table.column("squares"):
        total = total + widened(raw.as_py())
    total = total.reshape(-1, k)
    label = total.argmin(axis=1)
    return label, total[np.arange(len(total)), label]


def _labels(table: pa.Table, k: int) -> pa.Table:
    label, _ = _nearest(table, k)
    return pa.table({"block": [table.column("block")[0].as_py()], "labels": pa.array([narrow(label)], pa.binary())})


def _assigned(table: pa.Table, k: int) -> pa.Table:
    label, distance = _nearest(table, k)
    ids, given = next(widened(raw.as_py()) for raw in table.column("ids") if raw.is_valid).reshape(2, -1)
    return pa.table({"id": pa.array(ids, pa.int64(), mask=given == 0), "cluster": pa.array(label, pa.int32()), "distance": pa.array(distance, pa.int64())})


def _sums(batches: Iterator[pa.RecordBatch], k: int, dims: int, width: int) -> Iterator[pa.RecordBatch]:
    """Of each shard that the task meets: components added up by centroid, and rows of each centroid."""
    found: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        for shard, data, labels in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            label = widened(labels)
            rows = widened(data).reshape(len(label), -1)
            total, count = found.setdefault(shard, (np.zeros((k, rows.shape[1]), np.int64), np.zeros(k, np.int64)))
            order = np.argsort(label, kind="stable")
            which, first = np.unique(label[order], return_index=True)
            total[which] += np.add.reduceat(rows[order], first)
            count += np.bincount(label, minlength=k)
    for shard, (total, count) in found.items():
        at, of = np.divmod(np.arange(total.size), total.shape[1])
        yield pa.record_batch(
            [pa.array(np.full(total.size, shard), pa.int32()), pa.array(at, pa.int32()), pa.array(of + shard * width, pa.int32()), pa.array(total.ravel()), pa.array(count[at])],
            ["shard", "cluster", "component", "total", "rows"],
        )


def first_centroids(vectors: DataFrame, k: int, dims: int, scale: float, seed: str) -> np.ndarray:
    """The vectors whose seeded ids have the least hashes; of rows with one id, the least vector. ``k`` rows go to the driver."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    rows = vectors.select(digest.alias("h"), "id", "v").orderBy(F.asc_nulls_last("h"), "v").limit(k).select("v").toArrow()
    column = rows.column("v").combine_chunks()
    return integers(column, dims, scale) if len(column) else np.zeros((0, dims), np.int64)


def kept_vectors(table: DataFrame, vec_id: str, vector: str, dims: int) -> DataFrame:
    """id and v of the rows whose vector has ``dims`` components, none null, NaN or infinite."""
    v = F.col(f"`{vector}`").cast("array<double>")
    fit = (F.size(v) == dims) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return table.select(F.col(f"`{vec_id}`").cast("long").alias("id"), v.alias("v")).where(F.coalesce(fit, F.lit(False)))


def cluster(
    table: DataFrame, k: int = 8, dims: int = 64, rounds: int = 10, vec_id: str = "vec_id", vector: str = "embedding",
    scale: float = 1024.0, seed: str = "3", width: int = WIDTH,
) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of every kept vector.

    Null, short, long and non-finite vectors are left out. Repeated rows are vectors each; a
    null id is the last to become a first centroid. Of equally near centroids the smallest
    number counts; a centroid without vectors stays. Fewer than ``k`` vectors make as many
    centroids, an empty table gives no rows. Further columns are not read. Components beyond
    +-2^27 after scaling count as that, so that distances fit 64 bits.
    """
    spark = table.sparkSession
    vectors = kept_vectors(table, vec_id, vector, dims)
    centres = first_centroids(vectors, k, dims, scale, seed)
    k = len(centres)
    if not k:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    name, folder = f"lloyd_{uuid.uuid4().hex[:12]}", new_folder(spark, "lloyd_pieces")
    cut = vectors.mapInArrow(lambda b: _pieces(b, dims, scale, width), "block string, shard int, data binary, ids binary")
    cut = stored(cut, "lloyd_cut")
    size = cut.agg(F.sum(F.octet_length("data") + 64)).first()[0]
    # As many buckets as tasks of a bounded size need, and at least one a core.
    buckets = max(spark.sparkContext.defaultParallelism, -(-size // TASK_BYTES))
    cut.repartition(buckets, "block").write.bucketBy(buckets, "block").option("path", folder).format("parquet").saveAsTable(name)
    try:
        pieces = spark.table(name)

        def distances(ids: bool) -> DataFrame:
            slices = [centres[:, c : c + width] for c in range(0, dims, width)]
            return pieces.select("block", "shard", "data", "ids").mapInArrow(
                lambda b: _partial(b, slices, ids), "block string, squares binary, ids binary"
            ).groupBy("block")

        for _ in range(rounds):
            labels = distances(False).applyInArrow(lambda t: _labels(t, k), "block string, labels binary")
            # The assignment is the small side: it comes to the buckets, the pieces stay.
            back = pieces.select("block", "shard", "data").join(labels.hint("shuffle_hash"), "block").select("shard", "data", "labels")
            sums = back.mapInArrow(lambda b: _sums(b, k, dims, width), "shard int, cluster int, component int, total long, rows long")
            made = sums.groupBy("shard", "cluster", "component").agg(F.sum("total").alias("total"), F.sum("rows").alias("rows")).where("rows > 0")
            # Exact: a floor of integers, also of negative ones.
            new = made.select("cluster", "component", F.expr("(total - pmod(total, rows)) div rows").alias("c")).toArrow()
            centres = centres.copy()
            centres[new.column("cluster").to_numpy(), new.column("component").to_numpy()] = new.column("c").to_numpy()
        out = distances(True).applyInArrow(lambda t: _assigned(t, k), "id long, cluster int, distance long")
        out = stored(out, "lloyd_assigned")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        remove_folder(spark, folder)
    hashes = [hashlib.sha256(",".join(map(str, row)).encode()).hexdigest() for row in centres.tolist()]
    named = spark.createDataFrame(list(enumerate(hashes)), "cluster int, centroid_sha256 string")
    inertia = out.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    inertia = inertia.withColumn("inertia", F.sum("cluster_inertia").over(Window.partitionBy(F.lit(0))))
    # One row a centroid.
    found = out.join(F.broadcast(inertia), "cluster").join(F.broadcast(named), "cluster")
    return found.select(F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def oracle(k: int = 8, dims: int = 64, rounds: int = 10) -> str:
    """DuckDB SQL for ``cluster`` over the table ``embeddings``: its rounds one after another."""
    near = """SELECT vec_id, v, arg_min(j, (d, j)) AS cluster, min(d) AS distance FROM (
        SELECT rid, vec_id, v, j, list_sum(list_transform(list_zip(v, c), lambda x: (x[1] - x[2]) * (x[1] - x[2]))) AS d
        FROM kept, c{0}) GROUP BY rid, vec_id, v"""
    parts = [
        f"""kept AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
        FROM embeddings WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(CAST(x AS DOUBLE)))) = {dims})""",
        f"""c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h NULLS LAST, v) - 1 AS j, v AS c
        FROM (SELECT sha256('3:' || vec_id) AS h, v FROM kept) QUALIFY j < {k})""",
    ]
    for i in range(rounds):
        parts.append(f"a{i} AS MATERIALIZED ({near.format(i)})")
        parts.append(f"""c{i + 1} AS MATERIALIZED (SELECT o.j, coalesce(n.c, o.c) AS c FROM c{i} o LEFT JOIN (
            SELECT cluster, list((s - ((s % m) + m) % m) // m ORDER BY p) AS c FROM (
                SELECT cluster, p, CAST(sum(x) AS BIGINT) AS s, count(*) AS m
                FROM (SELECT cluster, unnest(v) AS x, generate_subscripts(v, 1) AS p FROM a{i}) GROUP BY cluster, p)
            GROUP BY cluster) n ON n.cluster = o.j)""")
    parts.append(f"last AS MATERIALIZED ({near.format(rounds)})")
    return "WITH " + ",\n".join(parts) + f"""
    SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, CAST(distance AS BIGINT) AS distance,
        CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia, CAST(sum(distance) OVER () AS BIGINT) AS inertia,
        sha256(array_to_string(c, ',')) AS centroid_sha256
    FROM last JOIN c{rounds} ON j = cluster"""
