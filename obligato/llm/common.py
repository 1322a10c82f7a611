"""Helpers shared by the training-data operators."""

from __future__ import annotations

import gc
import os
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

from ..session import shared_dir

#: Arrow batches handed to Python hold at most so many rows and bytes, so that a
#: worker's memory does not depend on how long the texts are.
BATCH_ROWS, BATCH_BYTES = 2000, 8 << 20
#: A shuffled join builds hash tables instead of sorting where every partition is known at run time to be smaller.
HASH_JOIN = "64m"

_BETWEEN = bytes(b for b in range(128) if not (chr(b).isdigit() or chr(b).isalpha()))
#: Every ASCII byte that is neither a digit nor a letter becomes a space.
_SPACED = bytes.maketrans(_BETWEEN, b" " * len(_BETWEEN))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bound_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches and hash tables of this session's tasks, and let local workers import this package.

    On a cluster the package comes with ``--py-files`` or is installed.
    """
    env = spark.sparkContext.environment
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [env.get("PYTHONPATH"), root]))
    spark.conf.set("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", HASH_JOIN)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that all executors share."""
    return shared_dir(spark, f"{name}-{uuid.uuid4().hex}")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or a longer one that no column of ``df`` has."""
    while name.lower() in {c.lower() for c in df.columns}:
        name += "_"
    return name


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner remove the shuffle files of steps whose results have been written."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    time.sleep(1)  # the cleaner works in the background


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write ``df`` as Parquet in the shared folder and read it back.

    Unlike executor-local copies the files outlive lost executors, and their
    sizes feed the planner's choice of joins.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete tables made by ``written`` that nothing reads any more."""
    for df in tables:
        spark, files = df.sparkSession, df.inputFiles()
        if files:
            path = spark._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def words_of(text: bytes | None) -> list[bytes]:
    """Lower-cased (A-Z) words: runs of digits, ASCII letters and non-ASCII characters."""
    return (text or b"").lower().translate(_SPACED).split()
