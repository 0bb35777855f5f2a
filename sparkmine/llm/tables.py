"""Intermediate tables of a job, in the folder that all executors share."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

BYTES_A_FILE = 4 << 20  # of the tables that a table is made of


class Scratch:
    """Tables written once and read by later steps of one job.

    They lie below ``spark.checkpoint.dir``. Only a purely local session without that setting gets a
    temporary folder. ``drop`` removes a table as soon as no later step reads it; the rest goes when
    the application ends.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        context = spark.sparkContext
        folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
        if not folder:
            if not context.master.startswith("local["):
                raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
            context.setCheckpointDir(tempfile.mkdtemp(prefix="sparkmine-"))
            folder = context.getCheckpointDir()
        self.base = f"{folder.rstrip('/')}/sparkmine-{uuid.uuid4().hex}"
        self.live: dict[str, str] = {}
        path, files = self._at(self.base)
        files.deleteOnExit(path)

    def _at(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(name)
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def path(self, name: str) -> str:
        """Where a table, or files of another kind, may be written."""
        self.live[name] = f"{self.base}/{name}"
        return self.live[name]

    def write(self, name: str, df: DataFrame, sources: tuple[str, ...] = ()) -> DataFrame:
        """Write ``df`` and read it back: lineage cut, true sizes, survives lost executors.

        With ``sources``, tables of this job that ``df`` is made of by light steps, it gets as many files as their bytes
        ask for, one for each core at least, however many partitions a shuffle has: a local file system starts
        processes for each file, which for a moment count with all memory of the executor that starts them. If one of
        them is not a table of this job, the partitions stay as they are.
        """
        if sources and all(s in self.live for s in sources):
            wanted = math.ceil(sum(map(self.bytes, sources)) / BYTES_A_FILE)
            df = df.coalesce(max(self.spark.sparkContext.defaultParallelism, wanted))
        df.write.mode("overwrite").parquet(self.path(name))
        return self.read(name, df.schema)

    def read(self, name: str, schema) -> DataFrame:
        return self.spark.read.schema(schema).parquet(self.live[name])

    def bytes(self, name: str) -> int:
        """Length of the table's files."""
        path, files = self._at(self.live[name])
        return files.getContentSummary(path).getLength()

    def drop(self, *names: str) -> None:
        for name in names:
            path, files = self._at(self.live.pop(name))
            files.delete(path, True)
