"""Tables written to the shared folder, for results that are read more than once.

The folder is the one the cluster names in ``spark.checkpoint.dir``. A written
table survives the loss of any executor, has exact size statistics (so the
planner can decide on a broadcast before it shuffles anything) and is pruned
by column when it is read back.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_folders: dict[str, str] = {}
_staged: list[str] = []


def staging_root(spark: SparkSession) -> str:
    """Shared folder for written tables.

    The one set by ``spark.checkpoint.dir`` or ``setCheckpointDir``; a temporary
    one only in local mode, where driver and executors are one process.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    root = context.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="filmlens-")
    return _local_folders[context.applicationId]


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Delete what is staged inside the block when it ends.

    Results that are read from staged tables must have been used up, or
    written elsewhere, by then.
    """
    kept = len(_staged)
    try:
        yield
    finally:
        while len(_staged) > kept:
            path = spark._jvm.org.apache.hadoop.fs.Path(_staged.pop())
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the staging folder."""
    path = f"{staging_root(spark)}/filmlens/{name}-{uuid.uuid4().hex}"
    _staged.append(path)
    return path


def materialize(df: DataFrame, name: str, spread: list[str] | None = None, folders: list[str] | None = None) -> DataFrame:
    """Write ``df`` once as Parquet in the staging folder and read it back.

    With ``spread``, rows are first dealt by a hash of those columns, so that the
    table's layout does not depend on the files behind it; meant for rows
    without raw text. ``folders`` are columns that become folders, so that a
    filter on them leaves out the other files.
    """
    spark = df.sparkSession
    path = staging_path(spark, name)
    (df.repartition(*spread) if spread else df).write.partitionBy(*(folders or [])).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
