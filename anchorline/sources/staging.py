"""Intermediate tables in shared storage.

A frame that several branches of a plan read is written once and read back, so the
ledger behind it is scanned once and a lost executor costs a re-read, not a
recomputation.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder; a temporary one only for a local session without it."""
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"{CHECKPOINT_DIR} must name a folder every executor can reach")
    return tempfile.mkdtemp(prefix="anchorline-")


class Staging:
    """One run's folder of staged tables.

    As a context manager it removes the folder when the run is over; else the caller does,
    with `remove`, once nothing reads the staged tables any more.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark = spark
        self.folder = f"{folder or shared_folder(spark)}/anchorline-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}-{uuid.uuid4().hex[:8]}"

    def table(self, df: DataFrame, name: str) -> DataFrame:
        """Write `df` now and return a frame that reads the written table."""
        path = self.path(name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    @staticmethod
    def observed(
        df: DataFrame, **metrics: Column
    ) -> tuple[DataFrame, Callable[[], dict[str, int]]]:
        """`df` with metrics that the next job over it takes on the way, and how to read them
        once that job is done."""
        seen = Observation(uuid.uuid4().hex)
        marked = df.observe(seen, *[column.alias(name) for name, column in metrics.items()])
        return marked, lambda: dict(seen.get)

    @staticmethod
    def rows_seen(df: DataFrame) -> tuple[DataFrame, Callable[[], int]]:
        """`observed` for the number of rows alone."""
        marked, found = Staging.observed(df, rows=F.count(F.lit(1)))
        return marked, lambda: found()["rows"]

    def counted(self, df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, dict[str, int]]:
        """`table`, with the number of rows written as `rows`, and other metrics beside it.

        They are taken as the table is written.
        """
        marked, found = self.observed(df, rows=F.count(F.lit(1)), **metrics)
        return self.table(marked, name), found()

    def remove(self) -> None:
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.folder)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

    def __enter__(self) -> Staging:
        return self

    def __exit__(self, *problem) -> None:
        self.remove()
