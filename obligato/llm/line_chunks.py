"""Removal of repeated multi-line chunks with content-defined boundaries. DataFrame functions only.

A rolling hash over the hashes of the last lines decides after which line a chunk ends, so an inserted line
shifts no boundary but those next to it. Chunks of several lines that occur more than once anywhere are
compared by their bytes, and all but the first are removed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, release, written

#: A chunk ends where the rolling hash is divisible by so much: its mean number of lines.
DIVISOR = 4
#: Factors of the hashes of the current line and the ones before it.
FACTORS = (1, 31, 961)
#: A chunk's name within its document: first line and number of lines in one number.
COUNT_BITS = 31


def _name(end: Column, start: Column) -> Column:
    return F.shiftleft(start.cast("long"), COUNT_BITS) + end - start + 1


def _evaluated(value: Column) -> Column:
    """``value``, computed once per row: the optimizer moves no expression through a generator, so that
    what follows finds a finished array instead of repeating the expression for each of its elements."""
    return F.explode(F.array(value))


def _line_hash(line: Column) -> Column:
    return F.conv(F.substring(F.md5(line), 1, 8), 16, 10).cast("long")


def with_chunks(docs: DataFrame, divisor: int = DIVISOR) -> DataFrame:
    """``docs`` with lines, and chunks: the names (first line << 31 | number of lines) of its chunks in order."""
    split = docs.withColumn("lines", _evaluated(F.split("text", "\n", -1)))
    hashed = split.withColumn("_hash", _evaluated(F.transform("lines", _line_hash)))
    rolling = F.col("_hash")
    for back, factor in enumerate(FACTORS):
        if back:
            before = F.concat(F.array_repeat(F.lit(0).cast("long"), back), "_hash")
            rolling = _added(rolling, F.slice(before, F.lit(1), F.size("_hash")), factor)
    last = F.size("lines") - 1
    ends = F.transform(rolling, lambda r, i: F.when((r % divisor == 0) | (i == last), i).otherwise(-1))
    ended = hashed.withColumn("_ends", _evaluated(F.filter(ends, lambda i: i >= 0)))
    starts = F.concat(F.array(F.lit(-1)), F.slice("_ends", F.lit(1), F.size("_ends") - 1))
    return (ended.withColumn("chunks", _evaluated(F.zip_with("_ends", starts, lambda end, before: _name(end, before + 1))))
            .drop("_hash", "_ends"))


def _added(sums: Column, values: Column, factor: int) -> Column:
    return F.zip_with(sums, values, lambda a, b: a + b * factor)


def _start(name: Column) -> Column:
    return F.shiftright(name, COUNT_BITS).cast("int")


def _count(name: Column) -> Column:
    return name.bitwiseAND(F.lit((1 << COUNT_BITS) - 1)).cast("int")


def _rows(docs: DataFrame, divisor: int) -> DataFrame:
    """(doc, tag, chunk, text) of every chunk of several lines."""
    chunks = (with_chunks(docs.where("doc IS NOT NULL AND text IS NOT NULL"), divisor)
              .select("doc", "tag", "lines", F.explode("chunks").alias("chunk")).where(_count(F.col("chunk")) > 1))
    return chunks.select("doc", "tag", "chunk", F.array_join(F.slice("lines", _start(F.col("chunk")) + 1, _count(F.col("chunk"))), "\n").alias("text"))


def _order() -> Column:
    """(doc, chunk) as one number that sorts alike and that a hash aggregate can hold."""
    return F.expr(f"CAST(doc AS DECIMAL(19, 0)) * {1 << 63}BD + chunk")


def remove_repeated_chunks(docs: DataFrame, divisor: int = DIVISOR, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_lines, n_removed, kept), one row per input row; ``kept`` is the text without the removed lines.

    A chunk of two or more lines is removed if the same bytes are a chunk of a row with a smaller id or an earlier
    one of the same row. A null text has no lines and stays null, an empty one has one empty line. Rows
    that share an id are one document and lose nothing to each other; a row whose id is null neither loses lines
    nor takes them. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("doc"), F.xxhash64(text_col).alias("tag"), F.col(text_col).alias("text"))
    rows = _rows(docs, divisor).withColumn("h", F.xxhash64("text"))
    # written, so that a frequent chunk's partition is split in the join; all joins shuffle at every size, since
    # each side grows with the documents
    several = written(rows.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"), "repeated-chunks")
    shared = written(rows.join(several.hint("merge"), "h"), "shared-chunks")
    discard(several)
    release(spark)
    first = written(shared.groupBy("h", "text").agg(F.min(_order()).alias("first")), "first-chunks")
    gone = (shared.join(first.hint("merge"), ["h", "text"]).where(_order() > F.col("first"))
            .groupBy(F.col("doc").alias("d"), F.col("tag").alias("t")).agg(F.collect_list("chunk").alias("gone")))
    gone = written(gone, "removed-chunks")
    discard(shared, first)
    release(spark)
    out = with_chunks(docs, divisor).join(gone.hint("merge"), (F.col("doc") == F.col("d")) & (F.col("tag") == F.col("t")), "left")
    kept = F.array_except("chunks", F.coalesce("gone", F.array().cast("array<bigint>")))
    lines = F.flatten(F.transform("_kept", lambda c: F.slice(F.col("lines"), _start(c) + 1, _count(c))))
    out = out.withColumn("_kept", kept).withColumn("_lines", lines)
    return out.select(F.col("doc").alias("doc_id"), F.coalesce(F.size("lines"), F.lit(0)).cast("long").alias("n_lines"),
                      (F.coalesce(F.size("lines"), F.lit(0)) - F.coalesce(F.size("_lines"), F.lit(0))).cast("long").alias("n_removed"),
                      F.array_join("_lines", "\n").alias("kept"))
