"""Delimited text files as records: quoted fields may hold commas, doubled quotes and line breaks.

Spark reads a file with line breaks inside quotes in one task. Here files stay splittable: lines are read split by split, the
parity of the quotes before each line tells whether it begins a record (a prefix sum over splits), and only
lines of records that span several lines are brought together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.blocks import scan_blocks
from ..session import materialize

#: Lines of one record at most; a longer one is an unclosed quote and is reported, not put together.
MAX_LINES = 1000


def read_lines(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """(file, block, at, text) of every line under ``path``: ``block`` is the split's start, ``at`` grows with the line within it.

    Lines end at a line feed; a carriage return stays with its line."""
    reader = spark.read.option("lineSep", "\n").option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                                    F.monotonically_increasing_id().alias("at"), F.col("value").alias("text"))


def number_lines(lines: DataFrame) -> DataFrame:
    """Lines with their ``_number`` in the file (from 1), whether they begin a record and whether their own quotes are odd; written once."""
    quotes = F.length("text") - F.length(F.replace("text", F.lit('"'), F.lit("")))
    numbered = scan_blocks(lines, ["file"], "block", "at", sums={"_quotes": quotes, "_number": F.lit(1)})
    return materialize(numbered.select("file", "block", "at", "text", (F.col("_number") + 1).alias("_number"),
                                       (F.col("_quotes") % 2 == 0).alias("_begins"), (quotes % 2 == 1).alias("_odd")))


def split_records(lines: DataFrame, max_lines: int = MAX_LINES) -> DataFrame:
    """(file, line, n_lines, record): the record's text and first line number (from 1), its lines joined by line feeds.

    A record ends where its quotes are even, blank lines between records are none. A record of more than ``max_lines`` lines
    has a null text.
    """
    return join_records(number_lines(lines), max_lines)


def join_records(numbered: DataFrame, max_lines: int = MAX_LINES) -> DataFrame:
    """The records of ``split_records`` from numbered lines."""
    whole = numbered.where(F.col("_begins") & ~F.col("_odd"))
    whole = whole.select("file", F.col("_number").alias("line"), F.lit(1).cast("long").alias("n_lines"), F.col("text").alias("record"))
    parts = numbered.where(~F.col("_begins") | F.col("_odd")).select("file", "block", "at", "text", "_number", "_begins")
    # numbers grow, so the last beginning is the greatest: the least of the negatives
    parts = scan_blocks(parts, ["file"], "block", "at", mins={"_line": F.when(F.col("_begins"), -F.col("_number"))}).withColumn("line", -F.col("_line"))
    kept = F.when(F.col("_number") - F.col("line") < max_lines, F.struct("_number", "text"))
    several = parts.groupBy("file", "line").agg(F.count("*").alias("n_lines"), F.array_sort(F.collect_list(kept)).alias("_t")).select(
        "file", "line", "n_lines", F.when(F.col("n_lines") <= max_lines, F.array_join("_t.text", "\n")).alias("record"))
    return (whole.unionByName(several).withColumn("record", F.regexp_replace("record", r"\r$", ""))
            .where((F.col("record") != "") | F.col("record").isNull()))


def field_count(record: Column) -> Column:
    """Number of fields: commas outside quotes, and one."""
    bare = F.when(F.contains(record, F.lit('"')), F.regexp_replace(record, '"[^"]*"', "")).otherwise(record)
    return F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1


def fields(record: Column, count: int) -> Column:
    """The first ``count`` fields as texts, doubled quotes undone; blank and missing ones are null."""
    names = [f"c{i}" for i in range(count)]
    parsed = F.from_csv(record, ", ".join(f"{n} string" for n in names), {"quote": '"', "escape": '"', "nullValue": "", "emptyValue": ""})
    # the lambda binds the parsed record: fields taken from the expression itself would each parse the record again
    return F.get(F.transform(F.array(parsed), lambda r: F.array(*[F.nullif(r.getField(n), F.lit("")) for n in names])), F.lit(0))
