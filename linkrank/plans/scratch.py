"""Intermediate tables in the cluster's shared checkpoint folder.

Iterative operators cut their lineage by writing each round's small state table and reading
it back. Parquet in the shared folder outlives any executor, keeps only the columns needed
and has a file size the planner can base its join choice on.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

_local_folder: str | None = None


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir`` (or set on the context).

    Only a local-mode session may go without: it gets a temporary folder of this process.
    """
    global _local_folder
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="linkrank-")
        atexit.register(shutil.rmtree, _local_folder, ignore_errors=True)
    return _local_folder


class Scratch:
    """The tables of one operator call, in a folder of their own."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/linkrank-{uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def write(self, frame: DataFrame, name: str) -> DataFrame:
        frame.write.parquet(self.path(name))
        return self.read(name, frame.schema)

    def read(self, name: str, schema) -> DataFrame:
        return self.spark.read.schema(schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        """Delete tables no later plan reads."""
        hadoop = self.spark.sparkContext._jsc.hadoopConfiguration()
        for name in names:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name))
            path.getFileSystem(hadoop).delete(path, True)
