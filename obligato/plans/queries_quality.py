"""Registered queries: profiles, coverage, quality suites and the publication gate
(A3, E5b, E5c, E7, E8, E9, E10, E11, E21-E27, H2-H4, D3, D4, D7-D10, F5, J1-J11, A28).

Fixture parameters: the five region names are the expected agencies, FY2022
is the current (partial) year, FY2021 the coverage baseline and FY2015 the
overlap base year. Thresholds that count agencies are scaled to a
five-agency ledger; row thresholds keep their published values.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.constants import EXPECTED_SUMMARY_ROWS, FISCAL_MONTHS, INVALID_TOKEN_PATTERN, OIA
from ..operators import ingest as I
from ..operators import months as MO
from ..operators import profile as PR
from ..operators import quality as Q
from ..sources.fixture import ledger_rows
from ..sources.sinks import output_dir, write_master
from . import oracle_sql as S
from .pipelines import build_master, ledger_groups, monthly_summary_from, year_summary_from
from .registry import register

EXPECTED = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
EXCEPTIONS = [(2016, "MIDDLE EAST")]
CURRENT_FY, BASELINE_FY, BASE_YEAR = 2022, 2021, 2015
REQUIRED = ["Agency", "Bureau", "Account", "Account_Number", "Period_of_Performance", "Expiration_Year", "TAFS",
            "Unobligated Balance (Line 2490)", "Budget Authority (Line 2500)", "Percentage Unobligated"]
LN = "TRY_CAST(LINENO AS DOUBLE)"


def master(spark, d):
    return build_master(spark, d)


def yearly(spark, d):
    return year_summary_from(build_master(spark, d))


def monthly(spark, d):
    return monthly_summary_from(build_master(spark, d))


def _in(vals) -> str:
    return "(" + ", ".join(S.q(v) for v in vals) + ")"


# ------------------------------------------------------------------ profiles

@register("scan_master", S.with_ctes("master") + """
SELECT fiscal_year, count(*) AS rows, count(DISTINCT Agency) AS agencies FROM master GROUP BY fiscal_year""")
def q_scan_master(spark, d):
    """A3: master rows and agencies per year."""
    return master(spark, d).groupBy("fiscal_year").agg(F.count(F.lit(1)).alias("rows"),
                                                       F.count_distinct("Agency").alias("agencies"))


@register("scan_master_years", S.with_ctes("master") + """
SELECT fiscal_year, Agency, LINENO, count(*) AS rows, CAST(sum(Sep) AS DOUBLE) AS september FROM master
WHERE fiscal_year IN (2018, 2019) GROUP BY ALL""")
def q_scan_master_years(spark, d):
    """A3: a stored master read with a filter on its year partitions."""
    stored = spark.read.parquet(write_master(master(spark, d), output_dir(spark, "master")))
    return (stored.where(F.col("fiscal_year").isin(2018, 2019)).groupBy("fiscal_year", "Agency", "LINENO")
            .agg(F.count(F.lit(1)).alias("rows"), F.sum("Sep").cast("double").alias("september")))


@register("months_with_data", S.with_ctes("month_flags") + "SELECT * FROM month_flags")
def q_months_with_data(spark, d):
    """Per year and month — has data (any non-zero), non-zero count, total."""
    return MO.months_with_data(master(spark, d), "any")


@register("months_by_total", S.with_ctes("month_flags") + """
SELECT fiscal_year, month, month_ord, coalesce(abs(total) > 1000, false) AS has_data, nonzero_count, total
FROM month_flags""")
def q_months_by_total(spark, d):
    """A month has data when |sum| > 1000."""
    return MO.months_with_data(master(spark, d), "total")


@register("latest_month", S.with_ctes("latest") + "SELECT fiscal_year, month, month_ord FROM latest")
def q_latest_month(spark, d):
    """Last fiscal month with data per year."""
    return MO.latest_month(master(spark, d))


@register("quarter_totals", S.with_ctes("master_long") + f"""
SELECT fiscal_year, 'Q' || CAST(CAST(ceil({S.month_ord('month')} / 3.0) AS INTEGER) AS VARCHAR) AS quarter, month,
       coalesce(total, 0.0) AS total, abs(coalesce(total, 0.0)) > 0 AS has_data FROM (
  SELECT fiscal_year, month, CAST(sum(value) AS DOUBLE) AS total FROM master_long
  WHERE month IN ('Dec', 'Mar', 'Jun', 'Sep') GROUP BY fiscal_year, month)""")
def q_quarter_totals(spark, d):
    """Totals at the quarter-end months."""
    return MO.quarter_totals(master(spark, d))


_FT_S = S.strip("TAFS")
_FT_AFTER = S.strip(f"substr({_FT_S}, instr({_FT_S}, '/') + 1)")
_FT_TOK = f"split_part({_FT_AFTER}, ' ', 1)"
_FT_N = f"(length({_FT_S}) - length(replace({_FT_S}, '/', '')))"
FUND_TYPE_SQL = (f"(CASE WHEN contains({_FT_S}, '/X') THEN 'no_year' "
                 f"WHEN {_FT_N} = 1 AND regexp_full_match({_FT_TOK}, '[0-9]{{2}}') THEN 'current_year' "
                 f"WHEN {_FT_N} = 1 AND length({_FT_TOK}) > 2 THEN 'multi_year' ELSE 'other' END)")


@register("year_profile", S.with_ctes("master", "master_long") + f"""
, m AS (SELECT fiscal_year, count(*) AS months_with_data, arg_max(month, ord) AS latest_month FROM (
      SELECT fiscal_year, month, {S.month_ord('month')} AS ord,
             count(*) FILTER (WHERE value IS NOT NULL AND value <> 0) AS nz FROM master_long GROUP BY 1, 2)
    WHERE nz > 0 GROUP BY fiscal_year),
b AS (SELECT fiscal_year, count(*) AS total_rows, count(DISTINCT AGENCY_TITLE) AS unique_agencies,
      count(DISTINCT BUREAU) AS unique_bureaus, count(DISTINCT TAFS) AS unique_tafs,
      count(*) FILTER (WHERE {LN} = 2490) AS line_2490, count(*) FILTER (WHERE {LN} = 2500) AS line_2500,
      count(DISTINCT {LN}) AS unique_lines FROM master GROUP BY fiscal_year),
f AS (SELECT fiscal_year, count(*) FILTER (WHERE ft = 'current_year') AS current_year_funds,
      count(*) FILTER (WHERE ft = 'multi_year') AS multi_year_funds, count(*) FILTER (WHERE ft = 'no_year') AS no_year_funds
      FROM (SELECT fiscal_year, {FUND_TYPE_SQL} AS ft FROM (SELECT DISTINCT fiscal_year, TAFS FROM master WHERE TAFS IS NOT NULL))
      GROUP BY fiscal_year)
SELECT * FROM b LEFT JOIN m USING (fiscal_year) LEFT JOIN f USING (fiscal_year)""")
def q_year_profile(spark, d):
    """Year profile (rows, distinct agencies/bureaus/symbols, months, lines, fund types)."""
    return PR.year_profile(master(spark, d))


@register("fund_type", S.with_ctes("master") + f"""
SELECT fiscal_year, ft AS fund_type, count(*) AS accounts FROM (
  SELECT fiscal_year, {FUND_TYPE_SQL} AS ft FROM (SELECT DISTINCT fiscal_year, TAFS FROM master WHERE TAFS IS NOT NULL))
GROUP BY 1, 2""")
def q_fund_type(spark, d):
    """Fund-type class counts over distinct symbols per year."""
    from ..functions.text import fund_type
    t = master(spark, d).where(F.col("TAFS").isNotNull()).select("fiscal_year", "TAFS").distinct()
    return t.groupBy("fiscal_year", fund_type(F.col("TAFS")).alias("fund_type")).agg(F.count(F.lit(1)).alias("accounts"))


@register("line_counts", S.with_ctes("master") + f"""
SELECT * FROM (SELECT fiscal_year, line_no, records,
    CAST(row_number() OVER (PARTITION BY fiscal_year ORDER BY line_no) AS INTEGER) AS rank FROM (
  SELECT fiscal_year, {LN} AS line_no, count(*) AS records FROM master WHERE {LN} IS NOT NULL GROUP BY 1, 2))
WHERE rank <= 5""")
def q_line_counts(spark, d):
    """Rows per line number, first five lines per year."""
    return PR.line_counts(master(spark, d))


_ROLLUP_ACC = """SELECT fiscal_year, Agency, count(DISTINCT TAFS) AS accounts, grouping_id(fiscal_year, Agency) AS gid
FROM master WHERE TAFS IS NOT NULL GROUP BY ROLLUP (fiscal_year, Agency)"""


@register("distinct_accounts", S.with_ctes("master") + f"SELECT * FROM ({_ROLLUP_ACC}) WHERE fiscal_year IS NOT NULL")
def q_distinct_accounts(spark, d):
    """Distinct symbols per agency and per year (rollup)."""
    return PR.distinct_accounts(master(spark, d))


@register("coverage_vs_baseline", S.with_ctes("master") + f"""
, c AS (SELECT * FROM ({_ROLLUP_ACC}) WHERE fiscal_year IS NOT NULL),
base AS (SELECT Agency, gid, accounts AS baseline_accounts FROM c WHERE fiscal_year = {BASELINE_FY}),
grid AS (SELECT y.fiscal_year, base.* FROM (SELECT DISTINCT fiscal_year FROM c) y, base),
j AS (SELECT g.fiscal_year, g.Agency, g.gid, g.baseline_accounts, coalesce(c.accounts, 0) AS current_accounts
      FROM grid g LEFT JOIN c ON g.fiscal_year = c.fiscal_year AND g.gid = c.gid AND g.Agency IS NOT DISTINCT FROM c.Agency)
SELECT fiscal_year, Agency, baseline_accounts, current_accounts,
  {S.round1('current_accounts * 100.0 / baseline_accounts', 2)} AS coverage_pct,
  {S.round1('current_accounts * 100.0 / baseline_accounts', 2)} < 80.0 AS below_threshold,
  CASE WHEN gid = 1 THEN 'overall' ELSE 'agency' END AS scope FROM j""")
def q_coverage_vs_baseline(spark, d):
    """Account coverage per agency against FY2021, flag below 80 %."""
    return PR.coverage_vs_baseline(master(spark, d), BASELINE_FY, 80.0)


@register("account_overlap", S.with_ctes("master") + f"""
, t AS (SELECT DISTINCT fiscal_year, TAFS FROM master WHERE TAFS IS NOT NULL),
base AS (SELECT TAFS FROM t WHERE fiscal_year = {BASE_YEAR}),
s AS (SELECT fiscal_year, count(*) AS current_accounts FROM t GROUP BY 1),
o AS (SELECT fiscal_year, count(*) AS overlap FROM t WHERE TAFS IN (SELECT TAFS FROM base) GROUP BY 1)
SELECT s.fiscal_year, s.current_accounts, coalesce(o.overlap, 0) AS overlap,
  (SELECT count(*) FROM base) AS base_accounts,
  (SELECT count(*) FROM base) - coalesce(o.overlap, 0) AS only_base,
  s.current_accounts - coalesce(o.overlap, 0) AS only_current,
  {S.round1('coalesce(o.overlap, 0) * 100.0 / (SELECT count(*) FROM base)', 2)} AS overlap_pct
FROM s LEFT JOIN o USING (fiscal_year)""")
def q_account_overlap(spark, d):
    """H3: symbol overlap of every year with FY2015."""
    return PR.account_overlap(master(spark, d), BASE_YEAR)


@register("snapshot_lines", S.with_ctes("master") + """
SELECT fiscal_year, count(*) AS rows, count(DISTINCT Agency) AS agencies, count(DISTINCT LINENO) AS distinct_lines,
  count(*) FILTER (WHERE TRY_CAST(LINENO AS DOUBLE) = 2490) AS rows_2490, count(*) FILTER (WHERE TRY_CAST(LINENO AS DOUBLE) = 2500) AS rows_2500
FROM master GROUP BY 1""")
def q_snapshot_lines(spark, d):
    """Report lines of the snapshot: distinct ones and rows of the two paired lines, per year."""
    return PR.snapshot_lines(master(spark, d))


@register("baseline_profile", S.with_ctes("yearly") + f"""
SELECT Fiscal_Year, Agency, count(*) AS rows, {S.exact_sum('Budget_Authority_M')} AS budget_authority,
  {S.exact_sum('Unobligated_Balance_M')} AS unobligated, count(DISTINCT Agency) AS agencies,
  grouping_id(Fiscal_Year, Agency) AS gid
FROM yearly GROUP BY ROLLUP (Fiscal_Year, Agency) HAVING Fiscal_Year IS NOT NULL""")
def q_baseline_profile(spark, d):
    """Snapshot profile per year and agency with per-year totals (rollup)."""
    return PR.baseline_profile(yearly(spark, d))


@register("file_agency_counts", S.with_ctes("master") + """
SELECT fiscal_year, Agency, count(*) AS rows, count(DISTINCT Source_File) AS files FROM master GROUP BY 1, 2""")
def q_file_agency_counts(spark, d):
    """Master rows and files per agency."""
    return PR.file_agency_counts(master(spark, d))


@register("drop_report", S.with_ctes("master", "yearly") + f"""
SELECT coalesce(a.fiscal_year, b.fiscal_year) AS fiscal_year, coalesce(a.n, 0) AS line_2490_rows,
       coalesce(b.n, 0) AS summary_rows, coalesce(a.n, 0) - coalesce(b.n, 0) AS dropped
FROM (SELECT fiscal_year, count(*) AS n FROM master WHERE {LN} = 2490 GROUP BY 1) a
FULL JOIN (SELECT Fiscal_Year AS fiscal_year, count(*) AS n FROM yearly GROUP BY 1) b USING (fiscal_year)""")
def q_drop_report(spark, d):
    """Line-2490 master rows vs year-summary rows."""
    m = master(spark, d)
    return PR.drop_report(m, year_summary_from(m))


@register("agency_month_coverage", S.with_ctes("ledger") + f"""
SELECT fiscal_year, AGENCY_TITLE, array_to_string(list_filter({S.months_list()}, lambda x: NOT list_contains(seen, x)), ',')
         AS missing_months,
       CAST(len(list_filter({S.months_list()}, lambda x: NOT list_contains(seen, x))) AS INTEGER) AS missing_count
FROM (SELECT fiscal_year, AGENCY_TITLE, list(DISTINCT month) AS seen FROM ledger GROUP BY 1, 2)""")
def q_agency_month_coverage(spark, d):
    """Expected fiscal months not seen per agency and year."""
    return PR.agency_month_coverage(ledger_rows(spark, d))


@register("file_check_rates", S.with_ctes("rates") + """
SELECT Source_File, rows, fy1_tested, fy1_matched, fy2_tested, fy2_matched, alloc_tested, alloc_matched,
  CASE WHEN fy1_tested > 0 THEN fy1_matched * 100.0 / fy1_tested ELSE 100.0 END AS fy1_match_pct,
  CASE WHEN fy2_tested > 0 THEN fy2_matched * 100.0 / fy2_tested ELSE 100.0 END AS fy2_match_pct,
  CASE WHEN alloc_tested > 0 THEN alloc_matched * 100.0 / alloc_tested ELSE 100.0 END AS alloc_match_pct,
  fy1_matched < fy1_tested OR fy2_matched < fy2_tested OR alloc_matched < alloc_tested AS rejected
FROM rates""")
def q_file_check_rates(spark, d):
    """Per-file match rates of derived vs given codes; rejected flag."""
    return I.file_check_rates(I.standard_lines(ledger_groups(spark, d))).select(
        "Source_File", "rows", "fy1_tested", "fy1_matched", "fy2_tested", "fy2_matched", "alloc_tested",
        "alloc_matched", "fy1_match_pct", "fy2_match_pct", "alloc_match_pct", "rejected")


_MISMATCH = " UNION ALL ".join(f"""
SELECT Source_File, TAFS, ordinal, '{g}' AS code, {S.normalize(g)} AS given, {S.normalize(dv)} AS derived FROM std
WHERE {S.normalize(g)} <> '' AND {S.normalize(g)} <> {S.normalize(dv)}""" for g, dv in I.CODE_PAIRS)


@register("mismatch_samples", S.with_ctes("std") + f"""
SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY Source_File, code ORDER BY ordinal, TAFS) AS INTEGER) AS sample
               FROM ({_MISMATCH})) WHERE sample <= 3""")
def q_mismatch_samples(spark, d):
    """The first three mismatching rows per file and code, in file order."""
    return I.mismatch_samples(I.derive_codes(I.standard_lines(ledger_rows(spark, d))))


# ------------------------------------------------------------------ quality suites

def _completeness_sql(src: str, year_col: str) -> str:
    return f"""
, yrs AS (SELECT DISTINCT {year_col} AS fiscal_year FROM {src}),
ex AS (SELECT fiscal_year, unnest({S.months_list(EXPECTED)}) AS member FROM yrs),
present AS (SELECT DISTINCT {year_col} AS fiscal_year, Agency AS member FROM {src}),
miss0 AS (SELECT * FROM ex WHERE (fiscal_year, member) NOT IN (SELECT (fiscal_year, member) FROM present)),
exc AS (SELECT * FROM (VALUES {", ".join(f"({y}, {S.q(a)})" for y, a in EXCEPTIONS)}) t(fiscal_year, member)),
miss1 AS (SELECT m.* FROM miss0 m ANTI JOIN exc e ON m.fiscal_year = e.fiscal_year AND m.member = e.member),
unexp AS (SELECT * FROM present WHERE member NOT IN {_in(EXPECTED)}),
miss AS (SELECT * FROM miss1 WHERE NOT (member = {S.q(OIA)} AND fiscal_year IN (SELECT fiscal_year FROM unexp))),
mc AS (SELECT fiscal_year, count(*) AS missing_count, array_to_string(list_sort(list(member)), '|') AS missing
       FROM miss GROUP BY 1),
rw AS (SELECT {year_col} AS fiscal_year, count(*) AS rows FROM {src} GROUP BY 1)"""


@register("dq_completeness", S.with_ctes("yearly") + _completeness_sql("yearly", "Fiscal_Year") + f"""
SELECT r.fiscal_year, r.rows, coalesce(mc.missing_count, 0) AS missing_count, coalesce(mc.missing, '') AS missing,
  coalesce(mc.missing_count, 0) = 0 AND r.rows >= 1000 AS passed,
  r.fiscal_year < {CURRENT_FY} AND r.rows < CASE WHEN r.fiscal_year BETWEEN 2013 AND 2017 THEN 3000 ELSE 8000 END AS warning
FROM rw r LEFT JOIN mc USING (fiscal_year)""")
def q_dq_completeness(spark, d):
    """Agency completeness (FY2016 Middle East excused) and row volume per year."""
    return Q.dq_completeness(yearly(spark, d), EXPECTED, EXCEPTIONS, CURRENT_FY)


@register("missing_members", S.with_ctes("yearly") + f"""
SELECT y.fiscal_year, e.member FROM (SELECT DISTINCT Fiscal_Year AS fiscal_year FROM yearly) y,
  (SELECT unnest({S.months_list(EXPECTED + [OIA])}) AS member) e
WHERE (y.fiscal_year, e.member) NOT IN (SELECT (Fiscal_Year, Agency) FROM yearly)""")
def q_missing_members(spark, d):
    """Expected agencies absent per year (the independent-agency bucket included)."""
    return Q.missing_members(yearly(spark, d), EXPECTED + [OIA])


@register("unexpected_members", S.with_ctes("yearly") + """
SELECT DISTINCT Fiscal_Year AS fiscal_year, Agency AS member FROM yearly WHERE Agency NOT IN ('AFRICA', 'ASIA')""")
def q_unexpected_members(spark, d):
    """H4: agencies present but not expected (expected: AFRICA, ASIA)."""
    return Q.unexpected_members(yearly(spark, d), ["AFRICA", "ASIA"])


@register("dq_structure", S.with_ctes("yearly") + """
SELECT Fiscal_Year AS fiscal_year, count(*) AS rows, count(DISTINCT Agency) AS agencies, count(DISTINCT Month) AS months,
  true AS columns_ok, '' AS missing_columns, count(*) >= 100 AND count(DISTINCT Agency) >= 5 AS passed FROM yearly GROUP BY 1""")
def q_dq_structure(spark, d):
    """Required columns, >= 100 rows and all five agencies per year."""
    return Q.dq_structure(yearly(spark, d), REQUIRED, 100, 5)


@register("dq_structure_monthly", S.with_ctes("monthly") + """
SELECT Fiscal_Year AS fiscal_year, count(*) AS rows, count(DISTINCT Agency) AS agencies, count(DISTINCT Month) AS months,
  false AS columns_ok, 'Fund_Type' AS missing_columns, false AS passed FROM monthly GROUP BY 1""")
def q_dq_structure_monthly(spark, d):
    """The twelve published monthly columns, and one that they do not have."""
    from ..sources.sinks import MONTH_CSV_COLUMNS
    return Q.dq_structure(monthly(spark, d), [*MONTH_CSV_COLUMNS, "Fund_Type"], 100, 5)


_STR_COLS = ["Month", "Agency", "Bureau", "Account", "Account_Number", "Period_of_Performance", "Expiration_Year",
             "TAFS", "Unobligated Balance (Line 2490)", "Budget Authority (Line 2500)", "Percentage Unobligated"]


@register("dq_invalid_tokens", S.with_ctes("monthly") + " UNION ALL ".join(
    f"""SELECT Fiscal_Year AS fiscal_year, {S.q(c)} AS column_name,
        count(*) FILTER (WHERE regexp_matches("{c}", '{INVALID_TOKEN_PATTERN}')) AS invalid_count,
        count(*) FILTER (WHERE regexp_matches("{c}", '{INVALID_TOKEN_PATTERN}')) = 0 AND count(*) > 0 AS passed
        FROM monthly GROUP BY 1""" for c in _STR_COLS))
def q_dq_invalid_tokens(spark, d):
    """Invalid display tokens per year and string column, over all monthly rows."""
    return Q.dq_invalid_tokens(monthly(spark, d)).withColumnRenamed("column", "column_name")


@register("dq_parseable", S.with_ctes("yearly") + """
SELECT fiscal_year, bad_unobligated, bad_budget, bad_pct, bad_unobligated + bad_budget + bad_pct = 0 AS passed FROM (
SELECT Fiscal_Year AS fiscal_year,
  count(*) FILTER (WHERE "Unobligated Balance (Line 2490)" IS NOT NULL AND
                   TRY_CAST(regexp_replace("Unobligated Balance (Line 2490)", '[$,M]', '', 'g') AS DOUBLE) IS NULL) AS bad_unobligated,
  count(*) FILTER (WHERE "Budget Authority (Line 2500)" IS NOT NULL AND
                   TRY_CAST(regexp_replace("Budget Authority (Line 2500)", '[$,M]', '', 'g') AS DOUBLE) IS NULL) AS bad_budget,
  count(*) FILTER (WHERE "Percentage Unobligated" IS NOT NULL AND
                   TRY_CAST(replace("Percentage Unobligated", '%', '') AS DOUBLE) IS NULL) AS bad_pct
FROM yearly GROUP BY 1)""")
def q_dq_parseable(spark, d):
    """Unparseable money and percentage text per year."""
    return Q.dq_parseable(yearly(spark, d))


@register("dq_required_fields", S.with_ctes("yearly") + " UNION ALL ".join(
    f"""SELECT Fiscal_Year AS fiscal_year, '{c}' AS field, count(*) FILTER (WHERE coalesce({c}, '') = '') AS empty_count,
        count(*) FILTER (WHERE coalesce({c}, '') = '') = 0 AS passed FROM yearly GROUP BY 1"""
    for c in ["Agency", "Bureau", "Account", "Account_Number"]))
def q_dq_required_fields(spark, d):
    """NULL or empty required fields per year."""
    return Q.dq_required_fields(yearly(spark, d))


@register("dq_consistency", S.with_ctes("yearly") + """
SELECT *, rows >= 1000 AND agencies >= 5 AND bad_money_text = 0 AS passed FROM (
SELECT Fiscal_Year AS fiscal_year, count(*) AS rows, count(DISTINCT Agency) AS agencies,
  count(*) FILTER (WHERE "Budget Authority (Line 2500)" IS NOT NULL AND NOT starts_with("Budget Authority (Line 2500)", '$'))
    AS bad_money_text FROM yearly GROUP BY 1)""")
def q_dq_consistency(spark, d):
    """>= 1000 rows, all five agencies, money text starts with '$'."""
    return Q.dq_consistency(yearly(spark, d), 1000, 5)


@register("dq_reasonable", S.with_ctes("yearly") + """
SELECT *, total_budget_billions BETWEEN 1.0 AND 50000.0 AS passed FROM (
SELECT Fiscal_Year AS fiscal_year,
  CAST(sum(CAST(TRY_CAST(regexp_replace("Budget Authority (Line 2500)", '[$,M]', '', 'g') AS DOUBLE) AS DECIMAL(38,1))) AS DOUBLE)
    / 1000.0::DOUBLE AS total_budget_billions,
  count(*) FILTER (WHERE TRY_CAST(replace("Percentage Unobligated", '%', '') AS DOUBLE) < -1000
                      OR TRY_CAST(replace("Percentage Unobligated", '%', '') AS DOUBLE) > 1000) AS extreme_pct
FROM yearly GROUP BY 1)""")
def q_dq_reasonable(spark, d):
    """Total budget within [1, 50000] billions (fixture scale); |pct| > 1000 counted."""
    return Q.dq_reasonable(yearly(spark, d), 1.0, 50000.0)


@register("lost_members", S.with_ctes("yearly") + """
, f AS (SELECT min(Fiscal_Year) AS y FROM yearly),
base AS (SELECT DISTINCT Agency AS member FROM yearly WHERE Fiscal_Year = (SELECT y FROM f)),
yrs AS (SELECT DISTINCT Fiscal_Year AS fiscal_year FROM yearly WHERE Fiscal_Year <> (SELECT y FROM f)),
lost AS (SELECT y.fiscal_year, count(*) AS lost FROM yrs y, base b
         WHERE (y.fiscal_year, b.member) NOT IN (SELECT (Fiscal_Year, Agency) FROM yearly) GROUP BY 1)
SELECT y.fiscal_year, coalesce(l.lost, 0) AS lost, coalesce(l.lost, 0) <= 3 AS passed
FROM yrs y LEFT JOIN lost l USING (fiscal_year)""")
def q_lost_members(spark, d):
    """Agencies of the first year missing later (> 3 fails)."""
    return Q.lost_members(yearly(spark, d))


@register("yoy_change", S.with_ctes("yearly") + """
SELECT *, coalesce(abs(change_pct) > 50.0, false) AS flagged FROM (
  SELECT *, CASE WHEN prev_budget > 0 THEN (total_budget - prev_budget) / prev_budget * 100.0 END AS change_pct FROM (
    SELECT *, lag(total_budget) OVER (ORDER BY fiscal_year) AS prev_budget FROM (
      SELECT Fiscal_Year AS fiscal_year, CAST(sum(CAST(Budget_Authority_M AS DECIMAL(38,1))) AS DOUBLE) AS total_budget
      FROM yearly GROUP BY 1)))""")
def q_yoy_change(spark, d):
    """Year-over-year total budget change, flagged above 50 %."""
    return Q.yoy_change(yearly(spark, d))


@register("snapshot_diff", S.with_ctes("yearly") + f"""
, ex AS (SELECT * FROM (VALUES {", ".join(f"({y}, {n})" for y, n in sorted(EXPECTED_SUMMARY_ROWS.items()))})
         t(fiscal_year, expected_rows))
SELECT CAST(e.fiscal_year AS INTEGER) AS fiscal_year, CAST(e.expected_rows AS BIGINT) AS expected_rows,
  coalesce(c.current_rows, 0) AS current_rows, coalesce(c.current_rows, 0) - e.expected_rows AS diff,
  CASE WHEN c.current_rows IS NULL THEN 'ERROR' WHEN c.current_rows = e.expected_rows THEN 'SAME' ELSE 'CHANGED' END AS status
FROM ex e LEFT JOIN (SELECT Fiscal_Year AS fiscal_year, count(*) AS current_rows FROM yearly GROUP BY 1) c USING (fiscal_year)""")
def q_snapshot_diff(spark, d):
    """Year-summary rows against the published expected counts."""
    return Q.snapshot_diff(yearly(spark, d), EXPECTED_SUMMARY_ROWS)


_APPROVED_SQL = (S.with_ctes("yearly", "monthly") + _completeness_sql("yearly", "Fiscal_Year") + """,
j1 AS (SELECT r.fiscal_year FROM rw r LEFT JOIN mc USING (fiscal_year) WHERE coalesce(mc.missing_count, 0) = 0 AND r.rows >= 1000),
j2 AS (SELECT Fiscal_Year AS fiscal_year FROM yearly GROUP BY 1 HAVING count(*) >= 100 AND count(DISTINCT Agency) >= 5),
approved AS (SELECT fiscal_year FROM j1 INTERSECT SELECT fiscal_year FROM j2)
""")


def _approved(master):
    y = year_summary_from(master)
    return y, Q.approved_years(Q.dq_completeness(y, EXPECTED, EXCEPTIONS, CURRENT_FY), Q.dq_structure(y, REQUIRED, 100, 5))


@register("approved_years", _APPROVED_SQL + "SELECT fiscal_year FROM approved")
def q_approved_years(spark, d):
    """H2: years passing both the completeness and the structure suite."""
    return _approved(build_master(spark, d))[1]


@register("publish_approved", _APPROVED_SQL + "SELECT * FROM monthly WHERE Fiscal_Year IN (SELECT fiscal_year FROM approved)")
def q_publish_approved(spark, d):
    """Monthly summary rows of approved years only."""
    m = build_master(spark, d)
    _, a = _approved(m)
    return Q.publish_approved(monthly_summary_from(m), a)


@register("unapproved_rows", _APPROVED_SQL + "SELECT * FROM yearly WHERE Fiscal_Year NOT IN (SELECT fiscal_year FROM approved)")
def q_unapproved_rows(spark, d):
    """Year-summary rows of years that are not approved."""
    y, a = _approved(build_master(spark, d))
    return Q.unapproved(y, a)


def _publish(spark, d):
    m = build_master(spark, d)
    _, approved = _approved(m)
    return approved, Q.publish(monthly_summary_from(m), approved, output_dir(spark, "published"))


_PUBLISHED_SQL = """SELECT Fiscal_Year AS fiscal_year, Month AS month, count(*) AS rows FROM monthly
WHERE Fiscal_Year IN (SELECT fiscal_year FROM approved) GROUP BY 1, 2"""


@register("validate_publish", _APPROVED_SQL + _PUBLISHED_SQL)
def q_validate_publish(spark, d):
    """Quality gate, then the approved years' monthly outputs written and catalogued from the folder."""
    return _publish(spark, d)[1]


@register("outputs_present", _APPROVED_SQL + f"""
SELECT a.fiscal_year, coalesce(o.outputs, 0) AS outputs, coalesce(o.has_month, false) AS has_month FROM approved a
LEFT JOIN (SELECT fiscal_year, count(*) AS outputs, bool_or(month = 'Sep') AS has_month FROM ({_PUBLISHED_SQL}) GROUP BY 1) o USING (fiscal_year)""")
def q_outputs_present(spark, d):
    """Published month outputs of every approved year, and whether September is there."""
    return Q.outputs_present(*_publish(spark, d))
