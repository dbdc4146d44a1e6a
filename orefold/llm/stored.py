"""Written tables that cut lineage, in the folder all executors share."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources.workspace import shared_folder


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/orefold_llm/{label}_{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write the rows and read them again: a lost executor repeats nothing before this."""
    folder = new_folder(df.sparkSession, label)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def remove_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def importable(spark: SparkSession) -> None:
    """Let the Python workers find this package where the driver has it (on a cluster, else, --py-files)."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment
    if root not in known.get("PYTHONPATH", "").split(os.pathsep):
        known["PYTHONPATH"] = os.pathsep.join(filter(None, [known.get("PYTHONPATH"), root]))


def id_ranges(docs: DataFrame, n: int) -> list[int]:
    """First ids of up to n ranges of doc_id, as even as a rank error of 1 in 100,000 lets them be.

    One number for each range goes through the driver. The first is the least id of all.
    """
    share = ",".join(f"{i / n!r}D" for i in range(n))
    found = docs.select(F.col("doc_id").cast("long").alias("i")).selectExpr(
        f"approx_percentile(i, array({share}), 100000) AS b", "min(i) AS least"
    ).first()
    return sorted({found.least, *(found.b or [])} - {None}) or [0]


def range_of(doc_id, bounds: list[int]):
    """The number of the range that an id belongs to; null ids are in the first."""
    marks = F.array(*[F.lit(b).cast("long") for b in bounds])
    passed = F.size(F.filter(marks, lambda b: b <= F.coalesce(doc_id, F.lit(bounds[0]))))
    return F.greatest(F.lit(0), passed - 1).cast("int")
