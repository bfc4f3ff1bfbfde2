"""The folder that the cluster shares for intermediate tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Used only where the session names no checkpoint folder (tests on one machine).
LOCAL_SCRATCH = "file:///tmp/checkpoints"


#: Folders handed out by this process.
_MADE: list[str] = []


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name in the folder that the cluster shares."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
    root = root or LOCAL_SCRATCH
    _MADE.append(f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}")
    return _MADE[-1]


def clear(spark: SparkSession) -> int:
    """Deletes the folders handed out so far, and says how many; for the end of a job, when no result that reads them is needed any more."""
    paths, n = list(_MADE), 0
    _MADE.clear()
    for path in paths:
        fs, folder = fs_path(spark, path)
        n += bool(fs.delete(folder, True))
    return n


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Folders handed out within are deleted at the end: for steps whose result is in a folder that was handed out before."""
    n = len(_MADE)
    yield
    gone = _MADE[n:]
    del _MADE[n:]
    for path in gone:
        fs, folder = fs_path(spark, path)
        fs.delete(folder, True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read again: lineage ends here, and lost executors cost no recomputation."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fs_path(spark: SparkSession, uri: str):
    """Hadoop's file system and path of a URI, for renames and deletes by the driver."""
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path
