"""File layout: rows of one range side by side in the same files.

One column: files hold narrow ranges of it. Several: the ranks of a row in each column are
written as bits, and their interleaved bits order the rows (a Z curve), so files are narrow
in every column and a range read on any of them skips most files by Parquet statistics.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.numbers import quoted

_HASH = "_row_hash"
_PLACE = "_row_place"
_CURVE = "_row_curve"
#: Bytes of stored input that go into one file.
FILE_BYTES = 128 << 20
#: Rows that the ranks of a Z curve are measured on. They decide where rows are put, never which.
SAMPLE_ROWS = 100_000
#: Bits of a rank: a column is cut into up to two to this many ranges.
BITS = 8


def _row_hash(df: DataFrame) -> Column:
    """A hash over all columns; Spark hashes no maps, so those go in as JSON text."""

    def part(field: T.StructField) -> Column:
        name = field.dataType.simpleString()
        return F.to_json(F.struct(field.name)) if "map<" in name else F.col(quoted(field.name))

    return F.xxhash64(*[part(f) for f in df.schema.fields])


def estimated_bytes(df: DataFrame) -> int:
    """What Catalyst expects ``df`` to hold, which for stored tables follows from their files."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def _placed(df: DataFrame) -> DataFrame:
    """``df`` with a hash and a place per row: where it was read. Both follow from the input
    alone, so a repeated task gives the same ones whatever the order of its rows, and no
    sort is needed for them. Copies of one row have one hash but come from many places."""
    return df.withColumn(_HASH, _row_hash(df)).withColumn(_PLACE, F.spark_partition_id())


def cluster_by(
    df: DataFrame, columns: str | Sequence[str], partitions: int | None = None
) -> DataFrame:
    """Range-partition by the columns and sort within, leaving the rows as they are.

    Written out, each file covers its own narrow range, and a range read skips the files
    outside by their Parquet statistics. A value that fills a large part of the table is
    split further by a hash of the row, and copies of one row by where they were read, so
    no single task receives much more than it would read.

    ``partitions`` defaults to one for each ``FILE_BYTES`` of the input. Rows are
    sorted once, after the exchange.
    """
    columns = [columns] if isinstance(columns, str) else list(columns)
    if partitions is None:
        partitions = max(1, -(-estimated_bytes(df) // FILE_BYTES))
    placed = _placed(df)
    key = columns[0]
    if len(columns) > 1:
        key = _CURVE
        ranks = [
            rank(F.col(quoted(c)), borders_of(values), df.schema[c].dataType)
            for c, values in zip(columns, samples(df, columns), strict=True)
        ]
        placed = placed.withColumn(_CURVE, z_value(ranks))
    spread = placed.repartitionByRange(partitions, key, _HASH, _PLACE)
    return spread.sortWithinPartitions(key).select(*[F.col(quoted(c)) for c in df.columns])


def samples(df: DataFrame, columns: Sequence[str]) -> list[list]:
    """About ``SAMPLE_ROWS`` values of each column, sorted, NULL left out; a bounded number, which
    goes through the driver."""
    rows = df.select(*[F.col(quoted(c)) for c in columns])
    share = min(1.0, SAMPLE_ROWS / max(rows.count(), 1))
    drawn = rows.sample(share, seed=0).collect()
    return [sorted(r[i] for r in drawn if r[i] is not None) for i in range(len(columns))]


def borders_of(values: Sequence, bits: int = BITS) -> list:
    """Where the ranges of a column begin, so that each holds about as many of the sorted values."""
    ranges = (1 << bits) - 1
    return sorted({values[i * len(values) // ranges] for i in range(ranges)}) if values else []


def rank(value: Column, borders: Sequence, kind: T.DataType) -> Column:
    """The number of the range that a value falls into, from 0 (NULL) up."""

    def below(lo: int, hi: int) -> Column:
        # Halved until one range is left, so a row passes few comparisons.
        if lo == hi:
            return F.lit(lo)
        middle = (lo + hi) // 2
        border = F.lit(borders[middle]).cast(kind)
        return F.when(value < border, below(lo, middle)).otherwise(below(middle + 1, hi))

    return F.when(value.isNull(), F.lit(0)).otherwise(below(0, len(borders)))


def z_value(ranks: Sequence[Column], bits: int = BITS) -> Column:
    """The bits of the ranks interleaved, the highest first."""
    out = F.lit(0).cast("bigint")
    for bit in range(bits):
        for i, one in enumerate(ranks):
            moved = F.shiftleft(F.bit_get(one.cast("bigint"), F.lit(bit)).cast("bigint"), bit * len(ranks) + i)
            out = out.bitwiseOR(moved)
    return out
