"""Incremental month ingestion with Structured Streaming.

New raw ledger files land in a folder partitioned by (fiscal_year, month).
A file-source stream picks them up; ``foreachBatch`` folds each micro-batch
into partial group aggregates (month sums, counts, code-check counts and first
positions per group and text) and writes them under ``epoch=<batch id>`` with
overwrite, so a retried batch replaces its own output (exactly-once). The
master is resolved from all epochs' partial groups by the same functions
as the batch build; ``compact`` folds finished epochs into one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.constants import FISCAL_MONTHS
from ..operators.ingest import CHECK_COLUMNS, FIRST_COLUMNS, group_keys, partial_groups, resolve_groups


def merge_partials(parts: DataFrame) -> DataFrame:
    """Partial groups of several batches folded into one row per (group keys, texts); keys come from the schema."""
    by = [*group_keys(parts), *[c for c in FIRST_COLUMNS if c in parts.columns]]
    sums = [F.sum(c).alias(c) for c in [*FISCAL_MONTHS, "source_rows", *CHECK_COLUMNS] if c in parts.columns]
    return parts.groupBy(*by).agg(*sums, F.min("_ord").alias("_ord"))


def write_month_partitions(raw: DataFrame, path: str) -> str:
    """Land raw ledger rows as (fiscal_year, month) partitions (the stream's source)."""
    raw.write.mode("overwrite").partitionBy("fiscal_year", "month").parquet(path)
    return path


def ingest_stream(spark: SparkSession, source: str, groups_dir: str, checkpoint: str,
                  files_per_trigger: int = 512) -> None:
    """Run the file-source stream until all available files are processed."""
    schema = spark.read.parquet(source).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(source)

    def per_batch(df: DataFrame, epoch_id: int) -> None:
        partial_groups(df).write.mode("overwrite").parquet(f"{groups_dir}/epoch={epoch_id}")

    q = (stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def streamed_groups(spark: SparkSession, groups_dir: str) -> DataFrame:
    """One row per group over all epochs."""
    return resolve_groups(spark.read.parquet(groups_dir).drop("epoch"))


def compact(spark: SparkSession, groups_dir: str, compacted_dir: str) -> str:
    """Write all epochs' partial groups as one epoch of a new folder, so that later merges read one row per group and text."""
    merge_partials(spark.read.parquet(groups_dir).drop("epoch")).write.mode("overwrite").parquet(f"{compacted_dir}/epoch=0")
    return compacted_dir
