"""A folder of published versions. Readers see a version once all its tables are written."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from anchorline.sources.staging import Staging, shared_folder
from anchorline.sources.tables import read_bucketed, write_bucketed, write_csv

#: Pointers whose versions `prune` keeps, and the seconds for which it leaves anything alone.
KEEP = 30
GRACE = 24 * 3600
#: Seconds after which an unfinished pointer file counts as given up.
UNFINISHED = 60


class StaleInputError(RuntimeError):
    """A table that a publication was built on has been published anew meanwhile."""


@dataclass(frozen=True)
class Snapshot:
    """What was current at one moment: the pointer's number, and per table version and rows."""

    number: int = 0
    versions: dict[str, str] = field(default_factory=dict)
    rows: dict[str, int] = field(default_factory=dict)
    #: The last number in use; greater where its writer has not finished the file.
    last: int = 0


class Store:
    """Versions of published tables, and a numbered file of pointers to the current ones.

    A publication writes its tables into a folder of its own and then creates the pointer file
    with the next number, which names the current version of every table. Creating it fails
    when another writer has taken the number; then the pointers are read again, and the
    publication either follows the other or, where it was built on a table that the other
    replaced, is refused. A failure before that leaves every table as it was. The numbers give
    the order, no clock does.

    The file system's create-if-absent has to be atomic, as HDFS's is.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._text = jvm.org.apache.commons.io.IOUtils.toString
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._path(self.folder).getFileSystem(conf)

    def _names(self, folder: str) -> list[str]:
        path = self._path(f"{self.folder}/{folder}")
        if not self._fs.exists(path):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(path))

    def _pointer(self, number: int) -> str:
        return f"{self.folder}/current/{number:012}.json"

    def _numbers(self) -> list[int]:
        """Numbers in use, ascending, unfinished files' too."""
        names = [n.removesuffix(".json") for n in self._names("current") if n.endswith(".json")]
        return [int(n) for n in names if n.isdigit()]

    def snapshot(self, number: int | None = None) -> Snapshot:
        """What is current, or was with the pointer of that number; a file that its writer left
        unfinished counts as none."""
        numbers = [n for n in self._numbers() if number is None or n <= number]
        for at in reversed(numbers):
            stream = self._fs.open(self._path(self._pointer(at)))
            try:
                text = self._text(stream, "UTF-8")
            finally:
                stream.close()
            if text.endswith("\n"):
                tables = json.loads(text)
                return Snapshot(
                    at,
                    {n: t["version"] for n, t in tables.items()},
                    {n: t["rows"] for n, t in tables.items()},
                    numbers[-1],
                )
        return Snapshot(last=numbers[-1] if numbers else 0)

    def _being_written(self, number: int) -> bool:
        """Whether that pointer may still be finished: its file is young."""
        status = self._fs.getFileStatus(self._path(self._pointer(number)))
        return time.time() * 1000 - status.getModificationTime() < 1000 * UNFINISHED

    def _point(self, number: int, text: str) -> bool:
        """Create the pointer file of that number; false if there is one."""
        path = self._path(self._pointer(number))
        try:
            out = self._fs.create(path, False)
        except Exception as problem:
            if self._fs.exists(path):
                return False
            raise problem
        out.write(bytearray(text.encode()))
        out.close()
        return True

    def path(self, name: str, at: Snapshot | None = None) -> str | None:
        """The folder of a table's version, without an ending; none before its first."""
        version = (at or self.snapshot()).versions.get(name)
        return version and f"{self.folder}/versions/{version}/{name}"

    def read(self, name: str, schema: StructType, at: Snapshot | None = None) -> DataFrame:
        """A table's current rows, or those of a snapshot; none before its first publication."""
        path = self.path(name, at)
        if path is None:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{path}.parquet")

    def read_keyed(self, name: str, schema: StructType, key: str) -> DataFrame | None:
        """A table's current rows as they are kept by key; none before its first publication."""
        path = self.path(name)
        return path and read_bucketed(self.spark, f"{path}.keyed", schema, key)

    def _write(
        self, version: str, name: str, rows: DataFrame, keyed: tuple[str, Callable] | None
    ) -> int:
        """One table as Parquet and as CSV, both in the frame's order, which is made once: the
        frame is checkpointed in the shared folder, and both are written from there, part by
        part. The rows are counted as Parquet is written."""
        path = f"{self.folder}/versions/{version}/{name}"
        context = self.spark.sparkContext
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(shared_folder(self.spark))
        ordered = rows.checkpoint()
        counted, found = Staging.rows_seen(ordered)
        counted.write.parquet(f"{path}.parquet")
        n = found()
        write_csv(ordered, f"{path}.csv", rows.schema, empty=n == 0)
        if keyed:
            key, build = keyed
            placed = ordered.withColumn("position", F.monotonically_increasing_id())
            write_bucketed(build(placed), f"{path}.keyed", key)
        return n

    def publish(
        self,
        tables: dict[str, DataFrame],
        *,
        base: Snapshot | None = None,
        built_on: Iterable[str] = (),
        keyed: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] | None = None,
    ) -> str:
        """Write all tables as Parquet and CSV, then make them current together.

        `keyed` gives a key to some tables, and what is kept by it of their rows, which have
        their `position` in the table's order then.

        `built_on` names the tables of `base` that these were made from. If one of them has
        another version by then, nothing becomes current and StaleInputError is raised.
        """
        version = f"{time.time_ns()}-{uuid.uuid4().hex[:8]}"
        keyed = keyed or {}
        written = {
            name: self._write(version, name, rows, keyed.get(name)) for name, rows in tables.items()
        }
        while True:
            now = self.snapshot()
            stale = [n for n in built_on if base and now.versions.get(n) != base.versions.get(n)]
            if stale:
                self._fs.delete(self._path(f"{self.folder}/versions/{version}"), True)
                raise StaleInputError(f"published anew meanwhile: {', '.join(stale)}")
            current = {n: {"version": v, "rows": now.rows[n]} for n, v in now.versions.items()}
            current |= {n: {"version": version, "rows": k} for n, k in written.items()}
            if now.last > now.number and self._being_written(now.last):
                time.sleep(0.1)  # that writer's tables belong in what follows
            elif self._point(now.last + 1, json.dumps(current) + "\n"):
                return version

    def prune(self, keep: int = KEEP, grace: int = GRACE) -> list[str]:
        """Remove versions that none of the last `keep` pointers names, and older pointers.

        What was written in the last `grace` seconds stays: a publication that is still being
        written is named by no pointer yet. Gives the versions removed.
        """
        numbers = self._numbers()
        kept = numbers[-max(keep, 1) :]
        named = {v for n in kept for v in self.snapshot(n).versions.values()}
        now, removed = time.time() * 1000, []
        for version in self._names("versions"):
            path = self._path(f"{self.folder}/versions/{version}")
            age = (now - self._fs.getFileStatus(path).getModificationTime()) / 1000
            if version not in named and age >= grace:
                self._fs.delete(path, True)
                removed.append(version)
        for number in numbers[: -len(kept)]:
            self._fs.delete(self._path(self._pointer(number)), False)
        return removed
