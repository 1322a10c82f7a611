"""Sinks (A20-A23, A27) and the summary CSV scan (A4).

Writes are partitioned by fiscal year (and month) with dynamic partition
overwrite, so re-running a year replaces only that year's files — the
reference's "re-running a year replaces its outputs". Paths are under the
session's shared checkpoint folder when not given explicitly.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.money import fmt_fixed, parse_money, parse_pct
from ..operators.pairing import DISPLAY_COLUMNS
from ..session import materialize, shared_dir
from .records import field_count, fields, read_lines, split_records

YEAR_CSV_COLUMNS = ["Agency", "Bureau", "Account", "Account_Number", "Period_of_Performance", "Expiration_Year",
                    "TAFS", *DISPLAY_COLUMNS]
MONTH_CSV_COLUMNS = ["Month", "Fiscal_Year", *YEAR_CSV_COLUMNS]


def output_dir(spark: SparkSession, name: str) -> str:
    return shared_dir(spark, f"outputs/{name}-{uuid.uuid4().hex[:8]}")


def write_master(master: DataFrame, path: str) -> str:
    """Master table partitioned by fiscal year (dynamic overwrite)."""
    (master.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("fiscal_year").parquet(path))
    return path


# RFC 4180: a quote within a field is doubled; blanks stay as they are.
CSV = {"header": True, "quote": '"', "escape": '"', "emptyValue": "", "nullValue": "",
       "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def write_year_summary(summary: DataFrame, path: str) -> str:
    """The ten display columns as CSV with header, one folder per year."""
    (summary.select("Fiscal_Year", *YEAR_CSV_COLUMNS).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").options(**CSV).partitionBy("Fiscal_Year").csv(path))
    return path


def write_monthly_summary(monthly: DataFrame, path: str) -> str:
    """Twelve display columns, one folder per year and month; a year's folder read as a
    whole is its '_all' union."""
    (monthly.select(*MONTH_CSV_COLUMNS, F.col("Fiscal_Year").alias("fy"), F.col("Month").alias("m")).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").options(**CSV).partitionBy("fy", "m").csv(path))
    return path


def scan_summary_csv(spark: SparkSession, path: str, columns: list[str] = YEAR_CSV_COLUMNS,
                     partitions: str = "Fiscal_Year int") -> DataFrame:
    """A4: published summaries read as text. A row whose number of fields differs from the header's is dropped;
    every other row is kept as it is: quoted fields with commas and doubled quotes, blank fields as ''."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns] + T.StructType.fromDDL(partitions).fields)
    # the field count is only judged when all columns are parsed
    df = spark.read.schema(schema).options(**CSV).option("mode", "DROPMALFORMED").option("columnPruning", False).csv(path)
    return df.fillna("", subset=columns)


def parse_summary(df: DataFrame) -> DataFrame:
    """Typed money (millions) and percentage of scanned display text, as the explorer reads it."""
    unob, ba, pct = DISPLAY_COLUMNS
    return df.withColumns({"Unobligated_Balance_M": parse_money(F.col(unob)), "Budget_Authority_M": parse_money(F.col(ba)),
                           "Percentage_Unobligated": parse_pct(F.col(pct))})


def load_year_month(yearly: DataFrame, monthly: DataFrame, month: str | None = None, fallback: str = "skip") -> DataFrame:
    """A5: rows that a view of all years loads. Without a month these are the year summaries (near-zero rows
    included); with one, that month's summaries. Years without the month are skipped, or with
    ``fallback='latest'`` shown with their year summary."""
    cols = [c for c in yearly.columns if c in monthly.columns]
    if month is None:
        return yearly.select(*cols)
    chosen = monthly.where(F.col("Month") == month).select(*cols)
    if fallback == "skip":
        return chosen
    if fallback != "latest":
        raise ValueError(f"fallback is 'skip' or 'latest', not {fallback!r}")
    years = chosen.select("Fiscal_Year").distinct()
    return chosen.unionByName(yearly.select(*cols).join(years, "Fiscal_Year", "left_anti"))


def summary_json(summary: DataFrame) -> DataFrame:
    """One JSON record per summary row: typed + display values, fiscal year
    and the empty time-series placeholders."""
    rec = F.struct(*[F.col(c) for c in summary.columns],
                   F.lit("[]").alias("BA_TimeSeries"), F.lit("[]").alias("Unob_TimeSeries"))
    return summary.select("Fiscal_Year", F.to_json(rec).alias("record"))


def parse_summary_json(records: DataFrame) -> DataFrame:
    """The summary rows of A23 records."""
    schema = ", ".join(f"`{c}` {t}" for c, t in SUMMARY_TYPES)
    return records.select(F.from_json("record", schema).alias("r")).select("r.*")


SUMMARY_TYPES = [("Month", "string"), ("Fiscal_Year", "int"), *[(c, "string") for c in YEAR_CSV_COLUMNS],
                 *[(c, "double") for c in ("Unobligated_Balance_M", "Budget_Authority_M", "Percentage_Unobligated")],
                 ("BA_TimeSeries", "string"), ("Unob_TimeSeries", "string")]


def _quoted(c: str):
    return F.concat(F.lit('"'), F.replace(F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit('"'), F.lit('""')), F.lit('"'))


def export_multi_year(agg: DataFrame) -> DataFrame:
    """A27, view of all years: month, year, agency, bureau, account, period, then budget, unobligated and
    percentage with one decimal; texts quoted, numbers not."""
    keys = ["Fiscal_Year", "Month", "Agency", "Bureau", "Account", "Period_of_Performance"]
    fields = [_quoted("Month"), F.col("Fiscal_Year").cast("string"), *[_quoted(c) for c in keys[2:]],
              fmt_fixed("budget_authority", 1), fmt_fixed("unobligated", 1), fmt_fixed("pct_unobligated", 1)]
    return agg.select(*keys, F.concat_ws(",", *fields).alias("csv_line"))


EXPORT_KEYS = {"agency": ["Agency", "Bureau", "Account", "Period_of_Performance", "Expiration_Year"],
               "bureau": ["Agency", "Bureau", "Account", "Period_of_Performance", "Expiration_Year"],
               "account": ["Agency", "Bureau", "Account", "Account_Number", "Period_of_Performance", "Expiration_Year"]}


def export_year(view: DataFrame, level: str) -> DataFrame:
    """A27, view of one year: the level's texts quoted, then unobligated and budget as plain numbers and the
    percentage with one decimal."""
    number = lambda c: F.regexp_replace(fmt_fixed(c, 1), r"\.0$", "")
    fields = [*[_quoted(c) for c in EXPORT_KEYS[level]], number("unobligated"), number("budget_authority"), fmt_fixed("pct_unobligated", 1)]
    return view.select("Fiscal_Year", *EXPORT_KEYS[level], F.concat_ws(",", *fields).alias("csv_line"))


def scan_summary_records(spark: SparkSession, path: str, columns: list[str] = YEAR_CSV_COLUMNS) -> tuple[DataFrame, DataFrame]:
    """A4 with nothing lost: the rows of published summaries as ``scan_summary_csv`` gives them, and the dropped records
    as (file, line, n_fields, n_expected, record): those whose fields are not as many as their file's header's.

    Quoted line breaks stay within a record; ``n_fields`` is null where quotes do not close.
    """
    records = split_records(read_lines(spark, path))
    header = records.where("line = 1").select("file", field_count(F.col("record")).alias("n_expected"))
    counted = materialize(records.where("line > 1").join(header, "file").withColumn("n_fields", field_count(F.col("record"))))
    year = F.regexp_extract("file", "Fiscal_Year=([0-9]+)", 1).cast("int").alias("Fiscal_Year")
    whole = counted.where("n_fields = n_expected").withColumn("_f", fields(F.col("record"), len(columns)))
    rows = whole.select(*[F.coalesce(F.get("_f", F.lit(i)), F.lit("")).alias(c) for i, c in enumerate(columns)], year)
    dropped = counted.where("n_fields IS NULL OR n_fields <> n_expected").select("file", "line", "n_fields", "n_expected", "record")
    return rows, dropped
