"""Spark session and shared-folder helpers."""

from __future__ import annotations

import gc
import re
import tempfile
import time
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings every job relies on: UTC timestamps, AQE (coalesce + skew join) and
# ANSI mode (bad casts raise, so every lenient conversion goes through try_*).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoint files go when the DataFrame that reads them is collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # HotSpot does not JIT methods above 8000 bytes; larger fused stages run
    # better split per operator than interpreted
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def get_session(master: str | None = None, app: str = "obligato",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Return the active session or build one with BASE_CONF.

    On a cluster the session already exists (spark-submit) and only missing
    settings are added; locally a ``local[N]`` session is created.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession, sub: str) -> str:
    """A folder under the cluster's shared checkpoint location.

    ``spark.checkpoint.dir`` names the shared folder on a cluster; it is read
    from the session. Only a ``local*`` master (tests, local runs) may leave it
    unset: there one folder per session is made, elsewhere this raises, because
    executors would write to disks that the others cannot read.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="obligato-ckpt-")
        spark.conf.set("spark.checkpoint.dir", base)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(base)
    return base.rstrip("/") + "/" + sub.strip("/")


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage of an intermediate that several branches reuse.

    Writes a reliable checkpoint under ``spark.checkpoint.dir`` (shared storage
    on a cluster, so it survives executor loss); branches then read it
    instead of recomputing the raw scan once per branch.
    """
    shared_dir(df.sparkSession, "ckpt")
    return df.checkpoint(eager=True)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner remove the shuffle files of steps whose results have been written."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    time.sleep(1)  # the cleaner works in the background


def store_parts(spark: SparkSession, parts: Iterable[DataFrame], name: str) -> DataFrame:
    """Cut lineage of a wide table that is made in parts, one after another: Parquet in the shared folder.

    A checkpoint keeps whole rows; columns, compressed, take about a fifth of that. The shuffle files of a part go before the next one begins,
    so the disk holds those of one part. Read back in a task per written file, so that tasks stay as small as the ones that wrote them.
    Unlike checkpoints the files stay until the session ends, or ``discard``.
    """
    path = shared_dir(spark, f"{name}-{uuid.uuid4().hex}")
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    store.mkdirs(folder)
    store.deleteOnExit(folder)
    for part in parts:
        part.write.mode("append").parquet(path, compression="zstd")
        schema = part.schema
        del part
        release(spark)
    by_file = spark.newSession()    # its file settings hold for this table alone: opening a file counts as much as a partition may hold
    for key in ("maxPartitionBytes", "openCostInBytes"):
        by_file.conf.set(f"spark.sql.files.{key}", "128m")
    no_rows = spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema])    # makes the result one of this session
    return no_rows.union(by_file.read.schema(schema).parquet(path))


def discard(table: DataFrame) -> None:
    """Delete the table made by ``store_parts`` that ``table`` reads, when nothing needs it any more."""
    spark, files = table.sparkSession, table.inputFiles()
    if files:
        folder = spark._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
