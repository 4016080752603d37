"""Tables written between the phases of a job, so that later phases start from files.

Every table has an owner that deletes it: the innermost :func:`scratch` block around the call, or else the Python process
when it ends. A result that reads such tables must be used before its owner closes.

In a :func:`phases` block the tables have names instead, in a folder that outlives a job that fails: the job that is started again finds
the tables that are complete and goes on from there.
"""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession

_owners: list[list[str]] = [[]]  # the first is the process
_running: list[_Phases] = []


@cache
def _local_folder() -> tempfile.TemporaryDirectory:
    return tempfile.TemporaryDirectory(prefix="twohop-")


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``; a temporary one in local mode only."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if spark.sparkContext.master.startswith("local"):
        return _local_folder().name
    raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")


def write_out(df: DataFrame, name: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df``, in folders for the values of ``by``, and read it back."""
    spark = df.sparkSession
    if _running:
        path, done = _running[-1].next(spark, name)
        if not done:
            df.write.partitionBy(*by).parquet(path, mode="overwrite")
    else:
        path = f"{shared_folder(spark)}/twohop-{name}-{uuid.uuid4().hex}"
        _owners[-1].append(path)
        df.write.partitionBy(*by).parquet(path)
    return spark.read.schema(df.schema).parquet(path) if by else spark.read.parquet(path)


def sizes_in_memory(spark: SparkSession) -> None:
    """Let Spark take a written table for as large as its rows are in memory: an edge of two ids is 3 to 4 bytes in Parquet and over 50 in
    a broadcast, so tables of millions of edges passed for small, and the driver built them. A session's own setting stays."""
    if float(spark.conf.get("spark.sql.sources.fileCompressionFactor")) == 1.0:
        spark.conf.set("spark.sql.sources.fileCompressionFactor", "16.0")


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


class _Phases:
    """The tables of a job, in the order in which it writes them."""

    def __init__(self, folder: str):
        self.folder, self.count = folder, 0

    def next(self, spark: SparkSession, name: str) -> tuple[str, bool]:
        """Where the next table is, and whether an earlier start of the job has completed it."""
        path = f"{self.folder}/{self.count:03d}-{name}"
        self.count += 1
        place, system = _file_system(spark, f"{path}/_SUCCESS")
        return path, system.exists(place)


@contextmanager
def phases(spark: SparkSession, folder: str, fingerprint: str) -> Iterator[None]:
    """Inside, tables are written to ``folder`` under the ``fingerprint`` of the job: whatever its results depend on. Tables that an
    earlier start of the same job has completed are not written again. Leaving without an error deletes them."""
    own = _Phases(f"{folder.rstrip('/')}/{fingerprint}")
    _running.append(own)
    try:
        yield
    finally:
        _running.remove(own)
    _delete(spark, [own.folder])


def _delete(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        place, system = _file_system(spark, path)
        system.delete(place, True)
    paths.clear()


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete on leaving what :func:`write_out` has written inside the block."""
    own: list[str] = []
    _owners.append(own)
    try:
        yield
    finally:
        _owners.remove(own)
        _delete(spark, own)


@atexit.register
def _close() -> None:
    spark = SparkSession.getActiveSession()
    if spark is not None and _owners[0]:
        with contextlib.suppress(Exception):  # the session may be ending too
            _delete(spark, _owners[0])
