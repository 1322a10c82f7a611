"""A1: a folder of raw ledger files, some of them bad.

Files are delimited texts with a header each; columns may stand in any order and further ones may be present. A file that is
empty, lacks required columns, has a header only or too many broken records is set aside as a whole with the reason; single broken
records of the other files are set aside with their line. Everything else becomes rows of the given schema.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .records import field_count, fields, join_records, number_lines, read_lines


class LedgerScan(NamedTuple):
    """``rows``: the schema's columns and Source_File. ``files``: (Source_File, file, bytes, records, rows, rejected, reason),
    the reason null for accepted files. ``rejected``: (Source_File, line, reason, record) of accepted files."""

    rows: DataFrame
    files: DataFrame
    rejected: DataFrame


def file_name(path: Column) -> Column:
    """The last part of a path."""
    return F.substring_index(path, "/", -1)


def list_files(spark: SparkSession, path: str, suffix: str = "") -> list[tuple[str, int]]:
    """(file, bytes) of every file under ``path``; Spark's own sources leave out empty ones.

    Names and sizes pass the driver, as they do when Spark plans a scan."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    found, out = root.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(root, True), []
    while found.hasNext():
        f = found.next()
        name = f.getPath().getName()
        if not name.startswith(("_", ".")) and name.endswith(suffix):
            out.append((f.getPath().toString(), f.getLen()))
    return out


def _decoded(path: Column) -> Column:
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def _headers(numbered: DataFrame) -> DataFrame:
    """(file, header): names in each file's first line; a header has no line break or comma inside a name."""
    first = numbered.where(F.col("_number") == 1)
    names = F.split(F.regexp_replace("text", '^\ufeff|"|\r$', ""), ",")
    return first.select("file", F.transform(names, F.trim).alias("header"))


def scan_ledger(spark: SparkSession, path: str, schema: T.StructType, required: list[str] | None = None, max_broken: float = 0.1,
                name: Callable[[Column], Column] = file_name, suffix: str = "") -> LedgerScan:
    """A1: read all files under ``path``.

    ``required`` (default: all columns of ``schema``) must be in a file's header, other missing columns are null. A record is broken if its
    quotes do not close, its fields are not as many as the header's, or a value does not fit its column; a file with more
    than ``max_broken`` broken records is not accepted. ``name`` makes Source_File of the path. Files are split like any
    text, also where quoted fields hold line breaks; the parsed records are written once and read by all three results.
    """
    required = [f.name for f in schema] if required is None else required
    listed = spark.createDataFrame(list_files(spark, path, suffix), "file string, bytes long").withColumn("Source_File", name(F.col("file")))
    lines = read_lines(spark, path, f"*{suffix}").withColumn("file", _decoded(F.col("file")))
    numbered = number_lines(lines)
    headers = materialize(_headers(numbered))
    absent = F.array_join(F.array_except(F.array(*map(F.lit, required)), "header"), ", ")
    headers = headers.withColumn("_absent", absent)
    widest = headers.agg(F.max(F.size("header"))).first()[0] or 1
    # headers and accepted files are a row per file, which the driver has listed; records are not dealt by their few files
    records = join_records(numbered).where(F.col("line") > 1).join(F.broadcast(headers.where(F.col("_absent") == "")), "file")
    texts = records.withColumn("_fields", fields(F.col("record"), widest)).withColumns(
        {f"_t{i}": F.get("_fields", (F.array_position("header", F.lit(f.name)) - 1).cast("int")) for i, f in enumerate(schema)})
    typed = texts.withColumns({f"_v{i}": F.col(f"_t{i}") if isinstance(f.dataType, T.StringType) else F.expr(f"try_cast(trim(_t{i}) AS {f.dataType.simpleString()})")
                               for i, f in enumerate(schema)})
    count = field_count(F.col("record"))
    reason = F.when(F.col("record").isNull(), F.lit("quotes do not close")).when(
        count != F.size("header"), F.concat(F.lit("fields: "), count.cast("string"), F.lit(" of "), F.size("header").cast("string")))
    for i, f in enumerate(schema):
        reason = reason.when(F.col(f"_t{i}").isNotNull() & F.col(f"_v{i}").isNull(), F.lit(f"value of {f.name}"))
    parsed = typed.withColumn("reason", reason).select(
        "file", "line", "reason", F.when(F.col("reason").isNotNull(), F.col("record")).alias("record"),
        *[F.col(f"_v{i}").alias(f.name) for i, f in enumerate(schema)])
    parsed = materialize(parsed)
    counts = parsed.groupBy("file").agg(F.count("*").alias("records"), F.count("reason").alias("rejected"))
    n, broken = F.coalesce("records", F.lit(0)), F.coalesce("rejected", F.lit(0))
    why = (F.when(F.col("bytes") == 0, F.lit("empty file"))
           .when(F.col("_absent") != "", F.concat(F.lit("missing columns: "), F.col("_absent")))
           .when(n == 0, F.lit("no rows"))
           .when(broken > max_broken * n, F.concat(F.lit("broken records: "), broken.cast("string"), F.lit(" of "), n.cast("string"))))
    files = materialize(listed.join(headers, "file", "left").join(counts, "file", "left").select(
        "Source_File", "file", "bytes", n.alias("records"), F.when(why.isNull(), n - broken).otherwise(0).alias("rows"), broken.alias("rejected"), why.alias("reason")))
    accepted = parsed.join(F.broadcast(files.where("reason IS NULL").select("file", "Source_File")), "file")
    rows = accepted.where("reason IS NULL").select(*[f.name for f in schema], "Source_File")
    return LedgerScan(rows, files, accepted.where("reason IS NOT NULL").select("Source_File", "line", "reason", "record"))
