"""A fresh schema and folder for work that has to be written down.

Everything goes under the shared folder the cluster names in
``spark.checkpoint.dir``: executors on any host can read it, and it outlives them.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession

_SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    folder = spark.conf.get(_SETTING, "")
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {_SETTING} to a folder all executors can reach")
    # The warehouse is where tables without a place of their own go, too.
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/orefold_scratch"


@dataclass(frozen=True)
class Workspace:
    """``folder`` for files and checkpoints, ``schema`` for tables stored below it."""

    folder: str
    schema: str

    def table(self, name: str) -> str:
        return f"{self.schema}.{name}"

    @property
    def landing(self) -> str:
        return f"{self.folder}/landing"

    @property
    def checkpoints(self) -> str:
        return f"{self.folder}/checkpoints"


def new_workspace(spark: SparkSession, label: str = "run") -> Workspace:
    name = f"orefold_{label}_{uuid.uuid4().hex[:12]}"
    folder = f"{shared_folder(spark)}/{name}"
    spark.sql(f"CREATE SCHEMA {name} LOCATION '{folder}/tables'")
    return Workspace(folder, name)


def drop_workspace(spark: SparkSession, space: Workspace) -> None:
    """Drop the workspace's tables and remove its folder."""
    spark.sql(f"DROP SCHEMA IF EXISTS {space.schema} CASCADE")
    path = spark._jvm.org.apache.hadoop.fs.Path(space.folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
