"""Intermediate tables that outlive an executor, and what may be broadcast."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 64 << 20  # of a table in memory
ROW_BYTES = 48  # that a row takes besides its values in a broadcast table
FOLDER = "spark.checkpoint.dir"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def work_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``, or else the context's checkpoint folder."""
    folder = spark.conf.get(FOLDER, None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise ValueError(f"set {FOLDER} to a folder that every executor can reach")
    return folder.rstrip("/")


class Workspace:
    """The intermediate tables of one job, in a folder of their own below the shared one.

    ``with Workspace(spark):`` makes the job's tables go there and removes them at the end, so results
    must be written or collected inside. Tables made outside any workspace belong to the application.
    All go when the application ends, at the latest.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = f"{work_dir(spark)}/sparkmine/{uuid.uuid4().hex}"
        self.token = None
        path, files = _located(spark, self.folder)
        files.deleteOnExit(path)

    def path(self, name: str) -> str:
        """A fresh path."""
        return f"{self.folder}/{name}-{uuid.uuid4().hex}"

    def close(self) -> None:
        """Remove all tables."""
        remove(self.spark, self.folder)

    def __enter__(self) -> Workspace:
        self.token = _open.set(self)
        return self

    def __exit__(self, *_) -> None:
        _open.reset(self.token)
        self.close()


_open: ContextVar[Workspace | None] = ContextVar("workspace", default=None)
_of_application: dict[tuple[str, str], Workspace] = {}


def workspace(spark: SparkSession) -> Workspace:
    """The innermost open workspace, or the application's own."""
    current = _open.get()
    if current is not None:
        return current
    key = (spark.sparkContext.applicationId, work_dir(spark))
    if key not in _of_application:
        _of_application[key] = Workspace(spark)
    return _of_application[key]


def _located(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def remove(spark: SparkSession, name: str) -> None:
    """Remove a file or folder, wherever Spark can write."""
    path, files = _located(spark, name)
    files.delete(path, True)


def names_below(spark: SparkSession, name: str) -> list[str]:
    """Names of the files and folders in a folder; none if it is not there."""
    path, files = _located(spark, name)
    return [s.getPath().getName() for s in files.listStatus(path)] if files.exists(path) else []


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the current workspace."""
    return workspace(spark).path(name)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Within it, the shuffle files of a query go as soon as it ends, not when the driver collects garbage."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def durable(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` once into the current workspace and read it back.

    Cuts the lineage, lets several branches share one computation, survives lost executors, and
    gives the planner true sizes. The scan of the written table still prunes columns. What was shuffled for it is removed.
    """
    path = new_path(df.sparkSession, name)
    with shuffles_removed(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _folders(table: DataFrame) -> set[str]:
    return {file.rpartition("/")[0] for file in table.inputFiles()}


def release(*tables: DataFrame) -> None:
    """Remove the files of tables made by :func:`durable` that nothing reads any more."""
    for table in tables:
        for folder in _folders(table):
            remove(table.sparkSession, folder)


def stored_bytes(table: DataFrame) -> int:
    """Length of the files that a table is read from."""
    located = [_located(table.sparkSession, folder) for folder in _folders(table)]
    return sum(files.getContentSummary(path).getLength() for path, files in located)


def _width(column: Column, kind: T.DataType) -> Column:
    """Bytes that a value takes in memory, roughly and rather more."""
    if isinstance(kind, T.ArrayType):
        if isinstance(kind.elementType, T.StringType | T.BinaryType | T.ArrayType):
            inner = F.aggregate(column, F.lit(0).cast("bigint"), lambda s, x: s + _width(x, kind.elementType))
        else:
            inner = 8 * F.greatest(F.size(column), F.lit(0))
        return F.lit(32) + F.coalesce(inner.cast("bigint"), F.lit(0))
    if isinstance(kind, T.StringType | T.BinaryType):
        return F.lit(32) + F.coalesce(F.octet_length(column), F.lit(0))
    return F.lit(8)


def small(table: DataFrame, most: int | None = None) -> bool:
    """Whether a durable table takes at most ``most`` bytes (default ``BROADCAST_BYTES``) in memory.

    Its files are looked at first, so a large table is not read for it.
    """
    most = BROADCAST_BYTES if most is None else most
    if stored_bytes(table) > most:
        return False
    total: Column = F.lit(ROW_BYTES).cast("bigint")
    for field in table.schema:
        total = total + _width(F.col(field.name), field.dataType)
    return table.agg(F.coalesce(F.sum(total), F.lit(0))).first()[0] <= most


def broadcast_if_small(table: DataFrame) -> DataFrame:
    """Hint a broadcast only after checking the bytes of the rows; ``table`` should be a durable one."""
    return F.broadcast(table) if small(table) else table
