"""Lineage cuts: a frame written once as a table in the shared checkpoint folder.

Used where several later steps read the same result.  Compared with
``DataFrame.checkpoint`` it computes the frame once (no second pass to
write), stores it columnar, and later reads prune columns and push filters.
The folder is the session's ``spark.checkpoint.dir`` (shared storage on a
cluster), so a lost executor never loses a cut.  Runs remove their stage
tables once published (``collect`` + ``remove``).
"""

from __future__ import annotations

import contextlib
import uuid

from pyspark.sql import DataFrame, SparkSession

from ..session import checkpoint_dir

_ACTIVE: list[list[str]] = []


def cut(df: DataFrame, name: str = "stage") -> DataFrame:
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/fieldload-stages/{name}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    for paths in _ACTIVE:
        paths.append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def collect():
    """Record the stage tables written inside the block."""
    paths: list[str] = []
    _ACTIVE.append(paths)
    try:
        yield paths
    finally:
        _ACTIVE.remove(paths)


def remove(spark: SparkSession, paths: list[str]) -> None:
    """Delete stage tables (recursive) through the Hadoop file system."""
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)
