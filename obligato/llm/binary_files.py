"""Binary files through Spark's own writers and readers, so that any store Spark reaches will do.

A file is one partition's rows, each a binary value, written by the committed text sink (a lost
executor's half-written file never shows) and read back whole by the binary file source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_files(rows: DataFrame, column: str, path: str, separator: str = "\n") -> None:
    """One file per partition under ``path``: the values of ``column`` in order, ``separator`` after each.

    The file format must tolerate the separator there, or be given one that it ignores.
    """
    rows.select(F.col(column).cast("string").alias("value")).write.option("lineSep", separator).text(path)


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """(content) of every non-empty file under ``path``, one row per file.

    The writer of the files bounds their size; a batch for Python holds about one.
    """
    return spark.read.format("binaryFile").load(path).where("length > 0").select("content")
