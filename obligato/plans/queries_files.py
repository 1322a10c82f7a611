"""Registered queries over written files, some of them bad (A1, A4)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.fixture import ledger_rows, table
from ..sources.ledger_files import scan_ledger
from ..sources.sinks import CSV, YEAR_CSV_COLUMNS, output_dir, scan_summary_records, write_year_summary
from . import oracle_sql as S
from .pipelines import build_master, year_summary_from
from .registry import register

RAW_SCHEMA = T.StructType()
for _name, _type in [("fiscal_year", "integer"), ("month", "string"), ("TAFS", "string"), ("LINENO", "string"), ("LINE_DESC", "string"),
                     ("amount", "decimal(18,2)"), ("ordinal", "long")]:
    RAW_SCHEMA = RAW_SCHEMA.add(_name, _type)

#: Lines of the written ledger whose amount is no number, and those whose description has quotes and line breaks.
_BAD, _LONG = "ordinal % 997 = 0", "ordinal % 5 = 0"


def _ledger_folder(spark, d: str) -> str:
    """Raw ledger files of all agencies and years (columns in two orders), and among them one of other columns, one of broken records, one empty."""
    path = output_dir(spark, "raw")
    rows = ledger_rows(spark, d).select("Source_File", *RAW_SCHEMA.names).withColumns({
        "amount": F.when(F.expr(_BAD), "n/a").otherwise(F.col("amount").cast("string")),
        "LINE_DESC": F.when(F.expr(_LONG), F.concat(F.lit('two "lines",\n\nof '), F.col("LINENO"))).otherwise(F.col("LINE_DESC"))})
    rows = rows.repartition("Source_File", F.pmod("ordinal", F.lit(4)))
    for year_is_even, names in ((True, RAW_SCHEMA.names), (False, RAW_SCHEMA.names[::-1])):
        (rows.where((F.col("fiscal_year") % 2 == 0) == year_is_even).select("Source_File", *names)
         .write.mode("append").partitionBy("Source_File").options(**CSV).csv(path))
    table(spark, d, "nation").coalesce(1).write.options(**CSV).csv(f"{path}/Source_File=COLUMNS")
    lines = F.array(F.lit(",".join(RAW_SCHEMA.names)), F.concat(F.col("r_name"), F.lit(",too,few")))
    regions = table(spark, d, "region").coalesce(1).select(F.explode(lines).alias("value"), "r_regionkey")
    regions.where("r_regionkey = 0 OR value LIKE '%too%'").select("value").write.option("lineSep", "\n").text(f"{path}/Source_File=RECORDS")
    empty = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/Source_File=EMPTY/part-0.csv")
    empty.getFileSystem(spark._jsc.hadoopConfiguration()).create(empty).close()
    return path


@register("scan_ledger_files", S.with_ctes("ledger") + f"""
SELECT Source_File, count(*) AS records, count(*) FILTER (WHERE NOT {_BAD}) AS rows, count(*) FILTER (WHERE {_BAD}) AS rejected,
       CAST(NULL AS VARCHAR) AS reason, CAST(sum(amount) FILTER (WHERE NOT {_BAD}) AS DOUBLE) AS amount,
       count(*) FILTER (WHERE NOT {_BAD} AND {_LONG} AND LINENO IS NOT NULL) AS long_texts, coalesce(min(ordinal) FILTER (WHERE {_BAD}), 0) AS first_rejected
FROM ledger GROUP BY 1
UNION ALL SELECT 'COLUMNS', 0, 0, 0, 'missing columns: ' || {S.q(', '.join(RAW_SCHEMA.names))}, NULL, 0, 0
UNION ALL SELECT 'RECORDS', count(*), 0, count(*), 'broken records: ' || count(*) || ' of ' || count(*), NULL, 0, 0 FROM region
UNION ALL SELECT 'EMPTY', 0, 0, 0, 'empty file', NULL, 0, 0""")
def q_scan_ledger_files(spark, d):
    """A1 over written files: records, rows, rejected records and reasons, and sums of what was read."""
    scan = scan_ledger(spark, _ledger_folder(spark, d), RAW_SCHEMA, name=lambda path: F.regexp_extract(path, "Source_File=([^/]*)", 1))
    long = F.col("LINE_DESC") == F.concat(F.lit('two "lines",\n\nof '), F.col("LINENO"))
    rows = scan.rows.groupBy("Source_File").agg(F.sum("amount").cast("double").alias("amount"), F.count_if(long).alias("long_texts"))
    even = F.substring_index("Source_File", "_", -1).cast("int") % 2 == 0
    ordinal = F.when(even, F.substring_index("record", ",", -1)).otherwise(F.substring_index("record", ",", 1)).cast("long")
    rejected = scan.rejected.groupBy("Source_File").agg(F.min(ordinal).alias("first_rejected"))
    return (scan.files.groupBy("Source_File").agg(F.sum("records").alias("records"), F.sum("rows").alias("rows"), F.sum("rejected").alias("rejected"),
                                                  F.max("reason").alias("reason"))
            .join(rows, "Source_File", "left").join(rejected, "Source_File", "left")
            .select("Source_File", "records", "rows", "rejected", "reason", "amount", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("long_texts", "first_rejected")]))


@register("summary_quarantine", S.with_ctes("yearly", extra=[
    ("bad", """SELECT Fiscal_Year, TAFS, row_number() OVER (PARTITION BY Fiscal_Year ORDER BY TAFS) AS r
               FROM (SELECT DISTINCT Fiscal_Year, TAFS FROM yearly WHERE Agency = 'ASIA')"""),
    ("placed", "SELECT *, 1 + r + coalesce(sum(r % 2) OVER (PARTITION BY Fiscal_Year ORDER BY r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS line FROM bad")]) + """
SELECT Fiscal_Year, 'row' AS kind, 0 AS line, 10 AS n_fields, Agency AS text, count(*) AS n FROM yearly GROUP BY ALL
UNION ALL SELECT Fiscal_Year, 'dropped', CAST(line AS BIGINT), CASE WHEN r % 2 = 1 THEN 2 ELSE 11 END,
  CASE WHEN r % 2 = 1 THEN '"two' || chr(10) || 'lines",' || TAFS ELSE TAFS || ',,,,,,,,,,' END, 1 FROM placed""")
def q_summary_quarantine(spark, d):
    """A4: kept rows per agency and every dropped record with its line, among the year summaries' files one of wrong records a year."""
    path, yearly = output_dir(spark, "yearly"), year_summary_from(build_master(spark, d))
    write_year_summary(yearly, path)
    bad = yearly.where("Agency = 'ASIA'").select("Fiscal_Year", "TAFS").distinct().withColumn(
        "r", F.row_number().over(Window.partitionBy("Fiscal_Year").orderBy("TAFS")))
    value = F.when(F.col("r") % 2 == 1, F.concat(F.lit('"two\nlines",'), F.col("TAFS"))).otherwise(F.concat(F.col("TAFS"), F.lit("," * 10)))
    header = bad.select("Fiscal_Year").distinct().select("Fiscal_Year", F.lit(0).alias("r"), F.lit(",".join(YEAR_CSV_COLUMNS)).alias("value"))
    lines = bad.select("Fiscal_Year", "r", value.alias("value")).unionByName(header).repartition("Fiscal_Year").sortWithinPartitions("Fiscal_Year", "r")
    raw = output_dir(spark, "wrong")
    lines.select("Fiscal_Year", "value").write.partitionBy("Fiscal_Year").option("lineSep", "\n").text(raw)
    kept, _ = scan_summary_records(spark, path)
    _, dropped = scan_summary_records(spark, raw)
    year = F.regexp_extract("file", "Fiscal_Year=([0-9]+)", 1).cast("int").alias("Fiscal_Year")
    return (kept.groupBy("Fiscal_Year", F.col("Agency").alias("text")).agg(F.count("*").alias("n"))
            .select("Fiscal_Year", F.lit("row").alias("kind"), F.lit(0).cast("long").alias("line"), F.lit(10).cast("long").alias("n_fields"), "text", "n")
            .unionByName(dropped.select(year, F.lit("dropped").alias("kind"), F.col("line").cast("long").alias("line"),
                                        F.col("n_fields").cast("long").alias("n_fields"), F.col("record").alias("text"), F.lit(1).cast("long").alias("n"))))
