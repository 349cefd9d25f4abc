"""Written tables in the cluster's shared folder.

A staged table cuts lineage: it is not recomputed when executors are lost, and its size is
known to the planner from its files. Staging runs a Spark job.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_FOLDER_KEY = "spark.checkpoint.dir"
_open_scope: ContextVar[list[str] | None] = ContextVar("foldlog_staged", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach; a temporary one only for a local master."""
    folder = spark.conf.get(_FOLDER_KEY, None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {_FOLDER_KEY} to a folder shared by all executors")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="foldlog-"))
    return spark.sparkContext.getCheckpointDir()


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, dropped with the enclosing ``staged_tables``."""
    path = f"{shared_folder(spark)}/foldlog-{label}-{uuid.uuid4().hex}"
    scope = _open_scope.get()
    if scope is not None:
        scope.append(path)
    return path


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` below the shared folder and return a frame that reads it back."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def staged_tables(spark: SparkSession) -> Iterator[None]:
    """Drop, on exit, the tables staged inside the block.

    Frames built inside must be consumed inside. Without the block staged tables stay until the
    owner of the shared folder removes them.
    """
    paths: list[str] = []
    token = _open_scope.set(paths)
    try:
        yield
    finally:
        _open_scope.reset(token)
        for path in paths:
            drop_path(spark, path)


def stage_from(spark: SparkSession, make: Callable[[], DataFrame], label: str) -> DataFrame:
    """Write the frame that ``make`` returns and read it back; what ``make`` staged on the way is
    dropped as soon as that is done."""
    path = new_path(spark, label)
    with staged_tables(spark):
        made = make()
        made.write.parquet(path)
    return spark.read.schema(made.schema).parquet(path)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder wherever Spark can write; one that is missing is no error."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_conf = spark.sparkContext._jsc.hadoopConfiguration()
    target.getFileSystem(hadoop_conf).delete(target, True)
