"""Registries kept between runs, as versions of a table.

Every run that changes a registry writes a whole new table and then names it in a commit file that must not exist yet
(``_commits/<number>``, made complete and renamed into place). Readers follow the highest commit. A run that fails before its commit leaves a folder
that nobody reads; a repeated run finds its own id in the last commit and does nothing; of two runs on the same version
one is refused.
"""

from __future__ import annotations

import json
import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from .links import upsert


class Version(NamedTuple):
    number: int
    folder: str
    run: str


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def last_version(spark: SparkSession, path: str) -> Version | None:
    """The committed version that readers see; None before the first."""
    fs, commits = _fs(spark, f"{path}/_commits")
    if not fs.exists(commits):
        return None
    names = [int(s.getPath().getName()) for s in fs.listStatus(commits) if s.getPath().getName().isdigit()]
    if not names:
        return None
    (text,) = spark.read.option("wholetext", True).text(f"{path}/_commits/{max(names):08d}").first()
    commit = json.loads(text)
    return Version(max(names), commit["folder"], commit["run"])


def _commit(spark: SparkSession, path: str, version: Version) -> None:
    """Name ``version`` as the next one; raises if that number has been taken meanwhile."""
    jvm = spark._jvm
    fs, temporary = _fs(spark, f"{path}/_commits/.{uuid.uuid4().hex}")
    out = fs.create(temporary, False)
    out.write(bytearray(json.dumps({"folder": version.folder, "run": version.run}).encode()))
    out.close()
    no_options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    _, final = _fs(spark, f"{path}/_commits/{version.number:08d}")
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(fs.makeQualified(temporary), fs.makeQualified(final), no_options)
    except Exception as e:
        fs.delete(temporary, False)
        raise RuntimeError(f"version {version.number} of {path} was written by another run") from e


def read_registry(spark: SparkSession, path: str) -> DataFrame | None:
    """The rows of the last version with their origin (original, added, replaced); None before the first."""
    last = last_version(spark, path)
    return spark.read.parquet(f"{path}/{last.folder}") if last else None


def store_upsert(new: DataFrame, path: str, run: str, key: str = "key", value: str = "url") -> Version:
    """Insert or replace ``new``'s rows (one per key) in the registry at ``path``; ``run`` names the run, so that repeating it changes nothing."""
    spark = new.sparkSession
    last = last_version(spark, path)
    if last and last.run == run:
        return last
    old = spark.read.parquet(f"{path}/{last.folder}") if last else spark.createDataFrame([], new.select(key, value).schema)
    version = Version(last.number + 1 if last else 1, f"v-{uuid.uuid4().hex}", run)
    upsert(old, new, key, value).write.parquet(f"{path}/{version.folder}")
    _commit(spark, path, version)
    return version
