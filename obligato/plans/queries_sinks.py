"""Registered queries: sinks read back, record JSON, exports, metadata upsert and
the one-month-file variant (A4, A20-A24, A26, A27, B4, E2, E3, P12)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.calendar import month_full
from ..operators import months as MO
from ..operators import profile as PR
from ..operators import rollup as R
from ..sources import links as L
from ..sources import sinks as K
from . import oracle_sql as S
from .pipelines import build_master, build_one_month_files, monthly_summary_from, year_summary_from
from .queries_explore import MY, _multi_sql
from .registry import register

_M = ", ".join(f"CAST({m} AS DOUBLE) AS {m}" for m in S.FISCAL_MONTHS)


@register("write_master", S.with_ctes("master") + f"""
SELECT fiscal_year, Source_File, Agency, BUREAU, OMB_ACCT, LINENO, TAFS, {_M} FROM master""")
def q_write_master(spark, d):
    """Master written partitioned by year (dynamic overwrite) and read back."""
    path = K.write_master(build_master(spark, d), K.output_dir(spark, "master"))
    m = spark.read.parquet(path)
    return m.select("fiscal_year", "Source_File", "Agency", "BUREAU", "OMB_ACCT", "LINENO", "TAFS",
                    *[F.col(x).cast("double").alias(x) for x in S.FISCAL_MONTHS])


_NUM = {"Unobligated_Balance_M": "Unobligated Balance (Line 2490)", "Budget_Authority_M": "Budget Authority (Line 2500)",
        "Percentage_Unobligated": "Percentage Unobligated"}
_TYPED = ", ".join(f"""TRY_CAST(regexp_replace("{t}", '[$,M%]', '', 'g') AS DOUBLE) AS {n}""" for n, t in _NUM.items())


def _cols(names) -> str:
    return ", ".join(f'"{c}"' for c in names)


@register("write_year_summary", S.with_ctes("yearly") + f"SELECT {_cols(K.YEAR_CSV_COLUMNS)}, Fiscal_Year, {_TYPED} FROM yearly")
def q_write_year_summary(spark, d):
    """A21 + A4: year summaries written as CSV per year, scanned back and their display text parsed."""
    path = K.write_year_summary(year_summary_from(build_master(spark, d)), K.output_dir(spark, "year"))
    return K.parse_summary(K.scan_summary_csv(spark, path))


@register("write_monthly_summary", S.with_ctes("monthly") + f"""
SELECT {_cols(c for c in K.MONTH_CSV_COLUMNS if c != 'Fiscal_Year')}, CAST(Fiscal_Year AS VARCHAR) AS Fiscal_Year,
       Fiscal_Year AS fy, Month AS m FROM monthly""")
def q_write_monthly_summary(spark, d):
    """A22 + A4: monthly summaries written per (year, month) and scanned back in full (the '_all' union of every year)."""
    path = K.write_monthly_summary(monthly_summary_from(build_master(spark, d)), K.output_dir(spark, "monthly"))
    return K.scan_summary_csv(spark, path, K.MONTH_CSV_COLUMNS, "fy int, m string")


@register("summary_json", S.with_ctes("yearly") + f"SELECT {_cols(c for c, _ in K.SUMMARY_TYPES[:-2])}, '[]' AS BA_TimeSeries, '[]' AS Unob_TimeSeries FROM yearly")
def q_summary_json(spark, d):
    """One JSON record per year-summary row, parsed back."""
    return K.parse_summary_json(K.summary_json(year_summary_from(build_master(spark, d))))


_BASE_FY = 2020
_R2 = lambda x: S.round1(x, 2)


@register("year_profile_json", S.with_ctes("master", "month_flags") + f"""
, yrs AS (SELECT fiscal_year, count(*) AS total_rows, count(DISTINCT Agency) AS total_agencies, count(DISTINCT TAFS) AS cur FROM master GROUP BY 1),
mon AS (SELECT fiscal_year, array_to_string(list(month ORDER BY month_ord) FILTER (WHERE total <> 0), ',') AS available_months,
        array_to_string(list(month ORDER BY month_ord) FILTER (WHERE NOT coalesce(total <> 0, false)), ',') AS missing_months,
        coalesce(any_value(total) FILTER (WHERE month = 'Jun'), 0) AS q3_total, bool_or(month IN ('Dec', 'Mar', 'Jun', 'Sep') AND total <> 0) AS validation_passed
        FROM month_flags GROUP BY 1),
ag AS (SELECT fiscal_year, Agency, count(DISTINCT TAFS) AS n FROM master WHERE TAFS IS NOT NULL GROUP BY 1, 2),
cov AS (SELECT y.fiscal_year, b.Agency, {_R2('coalesce(c.n, 0) * 100.0::DOUBLE / b.n')} AS pct
        FROM yrs y CROSS JOIN (SELECT * FROM ag WHERE fiscal_year = {_BASE_FY}) b LEFT JOIN ag c ON c.fiscal_year = y.fiscal_year AND c.Agency = b.Agency),
cv AS (SELECT fiscal_year, array_to_string(list(Agency ORDER BY Agency) FILTER (WHERE pct < 80), ',') AS below, count(*) AS agencies,
       max(pct) FILTER (WHERE Agency = 'ASIA') AS asia_pct, bool_or(pct < 80) AS any_below FROM cov GROUP BY 1)
SELECT * EXCLUDE (any_below), any_below OR overall_coverage_percent < 80 AS has_coverage_issues FROM (
SELECT y.fiscal_year, y.fiscal_year >= 2022 AS is_current_year, coalesce(available_months, '') AS available_months, coalesce(missing_months, '') AS missing_months,
  'Oct,Nov,Dec' AS q1_months, q3_total, total_agencies, total_rows, validation_passed, y.cur AS current_total_accounts,
  {_R2('y.cur * 100.0::DOUBLE / (SELECT cur FROM yrs WHERE fiscal_year = ' + str(_BASE_FY) + ')')} AS overall_coverage_percent,
  cv.any_below, coalesce(below, '') AS agencies_below_threshold, cv.agencies AS covered_agencies, asia_pct
FROM yrs y JOIN mon USING (fiscal_year) LEFT JOIN cv USING (fiscal_year))""")
def q_year_profile_json(spark, d):
    """Nested year documents written as JSON text and parsed back."""
    doc = PR.year_profile_document(build_master(spark, d), 2022, _BASE_FY)
    text = doc.select(F.to_json(F.struct(*doc.columns)).alias("profile_json"))
    r = text.select(F.from_json("profile_json", doc.schema).alias("r")).select("r.*")
    t = F.col("tafs_coverage")
    return r.select(
        "fiscal_year", "is_current_year", F.array_join("available_months", ",").alias("available_months"),
        F.array_join("missing_months", ",").alias("missing_months"), F.array_join(F.col("quarter_mapping")["Q1"], ",").alias("q1_months"),
        F.col("quarter_data")["Q3"]["total"].alias("q3_total"), "total_agencies", "total_rows", "validation_passed",
        t["current_total_accounts"].alias("current_total_accounts"), t["overall_coverage_percent"].alias("overall_coverage_percent"),
        t["has_coverage_issues"].alias("has_coverage_issues"), F.array_join(t["agencies_below_threshold"], ",").alias("agencies_below_threshold"),
        F.size(t["agency_coverage"]).cast("long").alias("covered_agencies"), t["agency_coverage"]["ASIA"]["coverage_percent"].alias("asia_pct"))


def _register_export(level: str) -> None:
    inner = _multi_sql(level)[len(MY):]
    quoted = " || ',' || ".join(f"""'"' || replace({c}, '"', '""') || '"'""" for c in ["Agency", "Bureau", "Account", "Period_of_Performance"])

    @register("export_level" if level == "agency" else f"export_level_{level}", MY + f"""
SELECT Fiscal_Year, Month, Agency, Bureau, Account, Period_of_Performance,
  '"' || Month || '",' || CAST(Fiscal_Year AS VARCHAR) || ',' || {quoted} || ',' || {S.fmt_fixed('budget_authority', 1)}
  || ',' || {S.fmt_fixed('unobligated', 1)} || ',' || {S.fmt_fixed('pct_unobligated', 1)} AS csv_line
FROM ({inner})""")
    def export(spark, d):
        return K.export_multi_year(R.rollup_multi_year(year_summary_from(build_master(spark, d)), level))

    export.__doc__ = f"A27: CSV lines of the view of all years at {level} level."


for _level in ("agency", "bureau", "account"):
    _register_export(_level)


def _full_sql() -> str:
    from ..functions.constants import MONTH_FULL
    return "(CASE " + " ".join(f"WHEN display_month = {S.q(k)} THEN {S.q(v)}" for k, v in MONTH_FULL.items()) + \
        " ELSE display_month END)"


@register("upsert_period_metadata", S.with_ctes("latest") + f"""
SELECT key, display_month, origin, {_full_sql()} AS month FROM (
  SELECT key, arg_max(display_month, tag) AS display_month,
         CASE WHEN max(tag) = 0 THEN 'original' WHEN min(tag) = 1 THEN 'added' ELSE 'replaced' END AS origin
  FROM (SELECT CAST(fiscal_year AS VARCHAR) AS key, month AS display_month, 0 AS tag FROM latest WHERE fiscal_year <= 2019
        UNION ALL
        SELECT CAST(fiscal_year AS VARCHAR), month, 1 FROM latest WHERE fiscal_year >= 2018) GROUP BY key)
ORDER BY TRY_CAST(key AS INTEGER)""")
def q_upsert_period_metadata(spark, d):
    """Insert-or-replace of year -> (month, display month) metadata."""
    lm = MO.latest_month(build_master(spark, d)).select(F.col("fiscal_year").cast("string").alias("key"),
                                                         F.col("month").alias("display_month"), "fiscal_year")
    out = L.upsert(lm.where("fiscal_year <= 2019"), lm.where("fiscal_year >= 2018"), "key", "display_month")
    return out.withColumn("month", month_full(F.col("display_month")))


@register("build_one_month_files", S.with_ctes("ledger") + f"""
, f AS (SELECT *, AGENCY_TITLE || '_2017_' || month AS sf, CAST(amount * 1000 AS DECIMAL(18,2)) AS amt
        FROM ledger WHERE fiscal_year = 2017 AND month IN ('Nov', 'Jul', 'Aug')),
fa AS (SELECT sf, {S.canonical_agency('first_agency')} AS Agency FROM (
        SELECT sf, arg_min(AGENCY_TITLE, ordinal) FILTER (WHERE AGENCY_TITLE IS NOT NULL) AS first_agency FROM f GROUP BY sf)),
pf AS (SELECT sf, month, BUREAU, OMB_ACCT, LINENO, CAST(sum(amt) AS DOUBLE) AS v FROM f
       WHERE TRY_CAST(LINENO AS DOUBLE) BETWEEN 1000 AND 9999 GROUP BY sf, month, BUREAU, OMB_ACCT, LINENO),
j AS (SELECT pf.*, fa.Agency FROM pf JOIN fa USING (sf))
SELECT BUREAU, OMB_ACCT, LINENO, Agency,
  coalesce(arg_min(v, sf) FILTER (WHERE month = 'Nov'), 0.0) AS Nov,
  coalesce(arg_min(v, sf) FILTER (WHERE month = 'Jul'), 0.0) AS Jul,
  coalesce(arg_min(v, sf) FILTER (WHERE month = 'Aug'), 0.0) AS Aug,
  '2017_Combined' AS Source_File
FROM j GROUP BY BUREAU, OMB_ACCT, LINENO, Agency""")
def q_build_one_month_files(spark, d):
    """P12 (B4, E2, E3): one-month files pivoted to Nov/Jul/Aug columns per key and agency."""
    return build_one_month_files(spark, d)
