"""Stored tables: lineage cuts inside a run and replaceable slices of result tables."""

from __future__ import annotations

import functools
import tempfile
import threading
import uuid
from collections.abc import Callable, Collection, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager, nullcontext

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="gainledger-")


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: the one the cluster names in spark.checkpoint.dir.

    Only where that is unset and the master is local, as in tests, a folder of our own is used.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder shared by the cluster")
        folder = _local_folder()
    return folder.rstrip("/")


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_cleaning = threading.Lock()
_writes = {"running": 0, "before": "false"}


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Writes inside remove their shuffle files when they end.

    Else these stay until the driver happens to collect its garbage, so a run has those of all its
    tables on disk. Only for writes: a result that is read twice still needs its files.
    """
    with _cleaning:
        if not _writes["running"]:
            _writes["before"] = spark.conf.get(_CLEANUP, "false")
            spark.conf.set(_CLEANUP, "true")
        _writes["running"] += 1
    try:
        yield
    finally:
        with _cleaning:
            _writes["running"] -= 1
            if not _writes["running"]:
                spark.conf.set(_CLEANUP, _writes["before"])


class Workspace:
    """Intermediate tables of one run, written to the shared folder and read back.

    A written table survives the loss of an executor, is computed once however many rules
    read it, and gives the planner its true size. With `tidy` a write also removes its shuffle files.
    """

    def __init__(self, spark: SparkSession, tidy: bool = False):
        self.spark = spark
        self.tidy = tidy
        self.root = f"{shared_folder(spark)}/gainledger/{uuid.uuid4().hex}"

    def store(self, df: DataFrame, name: str, folders: Collection[str] = ()) -> DataFrame:
        """`df` written out and read back; with a folder for each value of the columns `folders`."""
        path = f"{self.root}/{name}"
        with shuffles_removed(self.spark) if self.tidy else nullcontext():
            df.write.mode("overwrite").partitionBy(*folders).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def inner(self) -> Workspace:
        """A workspace below this one, for a step that removes what it needs no longer."""
        below = Workspace(self.spark, self.tidy)
        below.root = f"{self.root}/{uuid.uuid4().hex}"
        return below

    def remove(self, keep: Collection[str] = ()) -> None:
        """Deletes the tables of this run, but for those named in `keep`.

        What was read from the others must be written by then.
        """
        root = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        files = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not keep:
            files.delete(root, True)
        elif files.exists(root):
            for entry in files.listStatus(root):
                if entry.getPath().getName() not in keep:
                    files.delete(entry.getPath(), True)

    def store_all(self, makers: Mapping[str, Callable[[], DataFrame]]) -> dict[str, DataFrame]:
        """Store tables that do not depend on each other side by side.

        The cluster then works on one table while another waits for its last tasks or its commit.
        """
        with ThreadPoolExecutor(max_workers=len(makers)) as pool:
            running = {
                name: pool.submit(inheritable_thread_target(self.spark)(lambda n, m: self.store(m(), n)), name, make)
                for name, make in makers.items()
            }
            return {name: job.result() for name, job in running.items()}


def slice_path(root: str, **slice_of: str) -> str:
    return "/".join([root.rstrip("/"), *[f"{k}={v}" for k, v in slice_of.items()]])


def read_slice(spark: SparkSession, schema: T.StructType, root: str, **slice_of: str) -> DataFrame:
    """One slice by its own path, so that other slices are neither listed nor in the way."""
    inside = T.StructType([f for f in schema.fields if f.name not in slice_of])
    rows = spark.read.schema(inside).parquet(slice_path(root, **slice_of))
    named = rows.withColumns({k: F.lit(v).cast(schema[k].dataType) for k, v in slice_of.items()})
    return named.select(*schema.names)


def replace_slice(df: DataFrame, root: str, **slice_of: str) -> str:
    """Replace one partition directory of a result table; returns its path.

    Each slice is its own directory, so an empty result also clears the old rows (a dynamic
    partition overwrite would leave them), and other slices are not touched.
    """
    path = slice_path(root, **slice_of)
    with shuffles_removed(df.sparkSession):
        df.drop(*slice_of).write.mode("overwrite").parquet(path)
    return path


def extend_slice(df: DataFrame, root: str, **slice_of: str) -> None:
    """Add rows to a slice written before in the same run."""
    with shuffles_removed(df.sparkSession):
        df.drop(*slice_of).write.mode("append").parquet(slice_path(root, **slice_of))
