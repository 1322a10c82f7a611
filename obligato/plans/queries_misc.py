"""Registered queries: remaining scans, joins and profiles
(A1, A2, B2, C1, D2, D5, E10, E11, G3, G8, H1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import to_number
from ..operators import ingest as I
from ..operators import months as MO
from ..operators.pairing import pair_counts, pair_totals, split_oia
from ..operators.rollup import sort_expiration
from ..sources.fixture import ledger_rows, unit_notes
from . import oracle_sql as S
from ..functions.constants import FISCAL_MONTHS, LEGACY_MONTHS, OIA, QUARTER_END, RAW_MONTH_COLUMNS
from .pipelines import build_master, ledger_groups, monthly_summary_from, summary_legacy, year_summary_from
from .registry import register

LN = "TRY_CAST(LINENO AS DOUBLE)"


@register("scan_ledger", S.with_ctes("ledger") + f"""
SELECT Source_File, fiscal_year, count(*) AS rows,
       count(*) FILTER (WHERE {LN} BETWEEN 1000 AND 9999) AS standard_rows,
       CAST(sum(amount) AS DOUBLE) AS amount FROM ledger GROUP BY 1, 2""")
def q_scan_ledger(spark, d):
    """A1 + C1: raw ledger rows per file, rows on standard lines, total amount."""
    n = to_number(F.col("LINENO"))
    return ledger_rows(spark, d).groupBy("Source_File", "fiscal_year").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(n.isNotNull() & (n >= 1000) & (n <= 9999)).alias("standard_rows"),
        F.sum("amount").cast("double").alias("amount"))


SKIP = ["EUROPE_2018", "ASIA_2020"]


@register("skip_files", S.with_ctes("ledger") + f"""
SELECT fiscal_year, count(*) AS rows, count(DISTINCT Source_File) AS files FROM ledger
WHERE Source_File NOT IN ({', '.join(S.q(x) for x in SKIP)}) GROUP BY 1""")
def q_skip_files(spark, d):
    """A2: rows and files per year after dropping files on a skip list."""
    skip = spark.createDataFrame([(x,) for x in SKIP], "Source_File string")
    return I.skip_files(ledger_rows(spark, d), skip).groupBy("fiscal_year").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("Source_File").alias("files"))


@register("detect_units", S.with_ctes("units") + "SELECT Source_File, unit_multiplier FROM units")
def q_detect_units(spark, d):
    """B2: unit multiplier per file from its first five caption rows."""
    files = ledger_rows(spark, d).select("Source_File", "AGENCY_TITLE").distinct()
    return I.detect_units(unit_notes(files))


def _raw_months_sql() -> str:
    cols, early = [], "ordinal % 8 < 4"
    for m in FISCAL_MONTHS:
        monthly = f"sum(amount) FILTER (WHERE month = {S.q(m)} AND {early})"
        value = f"coalesce({monthly}, sum(amount) FILTER (WHERE month = {S.q(m)}))" if m in QUARTER_END.values() else monthly
        cols.append(f"CAST({value} AS DOUBLE) AS {m}")
    return f"SELECT Source_File, LINENO, {', '.join(cols)} FROM ledger GROUP BY 1, 2"


@register("rename_months", S.with_ctes("ledger") + _raw_months_sql())
def q_rename_months(spark, d):
    """B1: wide raw columns (a month's amounts of the first lines only, quarter ends of all lines) under month names, the monthly column first."""
    raw = ledger_rows(spark, d)
    quarters = dict(zip(["AMT1", "AMT2", "AMT3", "AMT4"], QUARTER_END.values(), strict=True))
    monthly = {c: m for c, m in RAW_MONTH_COLUMNS.items() if c not in quarters}
    early = F.col("ordinal") % 8 < 4
    wide = raw.groupBy("Source_File", "LINENO").agg(
        *[F.sum(F.when((F.col("month") == m) & early, F.col("amount"))).cast("double").alias(c) for c, m in monthly.items()],
        *[F.sum(F.when(F.col("month") == m, F.col("amount"))).cast("double").alias(c) for c, m in quarters.items()])
    return I.rename_months(wide).select("Source_File", "LINENO", *FISCAL_MONTHS)


@register("pair_lines_oia", S.with_ctes("master_long", "latest") + """
, u AS (SELECT m.fiscal_year, m.month, m.TAFS, m.value FROM master_long m JOIN latest l
        ON m.fiscal_year = l.fiscal_year AND m.month = l.month WHERE TRY_CAST(m.LINENO AS DOUBLE) = 2490),
b AS (SELECT m.fiscal_year, m.month, m.TAFS, m.value FROM master_long m JOIN latest l
        ON m.fiscal_year = l.fiscal_year AND m.month = l.month WHERE TRY_CAST(m.LINENO AS DOUBLE) = 2500)
SELECT u.fiscal_year, count(*) AS pairs, CAST(sum(u.value) AS DOUBLE) AS unobligated, CAST(sum(b.value) AS DOUBLE) AS budget
FROM u JOIN b ON u.fiscal_year = b.fiscal_year AND u.month = b.month AND u.TAFS IS NOT DISTINCT FROM b.TAFS
GROUP BY 1""")
def q_pair_lines_oia(spark, d):
    """Pairing on the symbol alone (all agencies), latest month, totals per year."""
    m = build_master(spark, d)
    return pair_totals(m, MO.latest_month(m), keys=("TAFS",))


@register("attach_period_metadata", S.with_ctes("avail", "latest") + """
SELECT y.Fiscal_Year, coalesce(l.month, 'Sep') AS display_month FROM (SELECT DISTINCT fiscal_year AS Fiscal_Year FROM avail) y
LEFT JOIN (SELECT * FROM latest WHERE fiscal_year <= 2020) l ON y.Fiscal_Year = l.fiscal_year""")
def q_attach_period_metadata(spark, d):
    """Year -> display month from metadata (years up to 2020 present), default 'Sep'."""
    m = build_master(spark, d)
    meta = MO.latest_month(m).where("fiscal_year <= 2020").select(F.col("fiscal_year").alias("Fiscal_Year"), "month")
    years = MO.available_months(m).select(F.col("fiscal_year").alias("Fiscal_Year")).distinct()
    return (years.join(F.broadcast(meta), "Fiscal_Year", "left")      # one row per year
            .select("Fiscal_Year", F.coalesce("month", F.lit("Sep")).alias("display_month")))


@register("blank_profile", S.with_ctes("std") + """
SELECT fiscal_year, count(*) AS rows,
  count(*) FILTER (WHERE DERIVED_FY1 = '') AS DERIVED_FY1_blank, count(DISTINCT DERIVED_FY1) AS DERIVED_FY1_distinct,
  count(*) FILTER (WHERE DERIVED_FY2 = '') AS DERIVED_FY2_blank, count(DISTINCT DERIVED_FY2) AS DERIVED_FY2_distinct,
  count(*) FILTER (WHERE DERIVED_ALLOC = '') AS DERIVED_ALLOC_blank, count(DISTINCT DERIVED_ALLOC) AS DERIVED_ALLOC_distinct,
  count(*) FILTER (WHERE DERIVED_FY1 = '' AND DERIVED_FY2 = '' AND DERIVED_ALLOC = '') AS all_blank,
  count(*) FILTER (WHERE BUREAU IS NULL) AS BUREAU_null, count(*) FILTER (WHERE OMB_ACCT IS NULL) AS OMB_ACCT_null,
  count(*) FILTER (WHERE LINENO IS NULL) AS LINENO_null
FROM std GROUP BY 1""")
def q_blank_profile(spark, d):
    """Blank / distinct profile of the derived codes and NULL keys on standard lines."""
    return I.blank_profile(I.standard_lines(ledger_groups(spark, d, [])))


@register("compression_ratio", S.with_ctes("std") + """
SELECT a.fiscal_year, a.input_rows, b.groups, a.input_rows / b.groups AS ratio, a.input_rows / b.groups > 50 AS over_aggregated
FROM (SELECT fiscal_year, count(*) AS input_rows FROM std GROUP BY 1) a
JOIN (SELECT fiscal_year, count(*) AS groups FROM (
        SELECT DISTINCT fiscal_year, Source_File, BUREAU, OMB_ACCT, LINENO, DERIVED_FY1, DERIVED_FY2, DERIVED_ALLOC, TRACCT, TRAG
        FROM std WHERE BUREAU IS NOT NULL AND OMB_ACCT IS NOT NULL AND LINENO IS NOT NULL) GROUP BY 1) b
USING (fiscal_year)""")
def q_compression_ratio(spark, d):
    """Input rows per aggregated group and over-aggregation flag (standard lines, before the file check)."""
    return I.compression_ratio(I.standard_lines(ledger_groups(spark, d, [])))


@register("sort_expiration", S.with_ctes("yearly") + "SELECT * FROM yearly ORDER BY Expiration_Year ASC NULLS LAST")
def q_sort_expiration(spark, d):
    """Expiration year ascending as text."""
    return sort_expiration(year_summary_from(build_master(spark, d)))


@register("sample_head", S.with_ctes("std") + """
SELECT DISTINCT DERIVED_ALLOC FROM std ORDER BY DERIVED_ALLOC LIMIT 10""")
def q_sample_head(spark, d):
    """First ten distinct derived allocation codes (display sample)."""
    c = I.derive_codes(I.standard_lines(ledger_rows(spark, d)))
    return c.select("DERIVED_ALLOC").distinct().orderBy("DERIVED_ALLOC").limit(10)


@register("union_ledgers", S.with_ctes("yearly", "monthly") + """
SELECT src, Fiscal_Year, count(*) AS rows, count(Month) AS with_month FROM (
  SELECT 'year' AS src, * EXCLUDE (Month) FROM yearly UNION ALL BY NAME SELECT 'month' AS src, * FROM monthly)
GROUP BY 1, 2""")
def q_union_ledgers(spark, d):
    """H1: union by column name with absent columns as NULL (year summary without its month column)."""
    m = build_master(spark, d)
    y = year_summary_from(m).drop("Month").withColumn("src", F.lit("year"))
    mo = monthly_summary_from(m).withColumn("src", F.lit("month"))
    u = I.union_ledgers(y, mo)
    return u.groupBy("src", "Fiscal_Year").agg(F.count(F.lit(1)).alias("rows"), F.count("Month").alias("with_month"))


# ------------------------------------------------------------------ P4 with Other Independent Agencies rows

_SYMBOL = "TRY_CAST(LINENO AS DOUBLE)"
_LEGACY = S.with_ctes("master", extra=[
    ("legacy_master", f"""SELECT * REPLACE (CASE WHEN AGENCY_TITLE = 'MIDDLE EAST' THEN {S.q(OIA)} ELSE Agency END AS Agency,
        CASE WHEN DERIVED_FY2 = 'X' THEN split_part(OMB_ACCOUNT, ' ', 1) ELSE OMB_ACCOUNT END AS OMB_ACCOUNT) FROM master"""),
    ("legacy_long", f"SELECT fiscal_year, Agency, BUREAU, OMB_ACCOUNT, TAFS, LINENO, {S.unnest_months()} FROM legacy_master"),
    ("legacy_months", f"""SELECT fiscal_year, arg_max(month, list_position({S.months_list(LEGACY_MONTHS)}, month)) AS month FROM (
        SELECT fiscal_year, month FROM legacy_long GROUP BY 1, 2 HAVING bool_or(value IS NOT NULL) AND bool_or(coalesce(value <> 0, true)))
        GROUP BY 1"""),
    ("legacy_at", "SELECT l.* FROM legacy_long l JOIN legacy_months m ON l.fiscal_year = m.fiscal_year AND l.month = m.month"),
    ("legacy_pairs", f"""
SELECT u.fiscal_year, u.month, u.Agency, u.TAFS,
       CASE WHEN u.Agency = {S.q(OIA)} THEN coalesce(nullif(regexp_extract(trim(u.OMB_ACCOUNT), '^\\S+\\s+(.*)$', 1), ''), {S.account_name('u.TAFS')})
            ELSE u.BUREAU END AS BUREAU, u.value AS value_2490, b.value AS value_2500
FROM legacy_at u JOIN legacy_at b ON u.fiscal_year = b.fiscal_year AND u.TAFS IS NOT DISTINCT FROM b.TAFS
  AND (u.Agency = {S.q(OIA)} AND b.Agency = {S.q(OIA)} OR u.Agency <> {S.q(OIA)} AND u.Agency = b.Agency)
WHERE TRY_CAST(u.LINENO AS DOUBLE) = 2490 AND TRY_CAST(b.LINENO AS DOUBLE) = 2500"""),
    ("legacy_summary", S._summary_body("legacy_pairs", False, ""))])


@register("summary_legacy", _LEGACY + "SELECT * FROM legacy_summary ORDER BY Agency, Budget_Authority_M DESC")
def q_summary_legacy(spark, d):
    """Legacy summary; one region stands for Other Independent Agencies, some of its code columns lack the name."""
    m = build_master(spark, d).withColumns({
        "Agency": F.when(F.col("AGENCY_TITLE") == "MIDDLE EAST", F.lit(OIA)).otherwise(F.col("Agency")),
        "OMB_ACCOUNT": F.when(F.col("DERIVED_FY2") == "X", F.substring_index("OMB_ACCOUNT", " ", 1)).otherwise(F.col("OMB_ACCOUNT"))})
    return summary_legacy(m)


@register("pair_counts", S.with_ctes("u_long", "b_long", "latest") + """
SELECT fiscal_year, month, Agency, TAFS, coalesce(n_u, 0) AS rows_2490, coalesce(n_b, 0) AS rows_2500,
       CAST(s_u AS DOUBLE) AS sum_2490, CAST(s_b AS DOUBLE) AS sum_2500
FROM (SELECT u.fiscal_year, u.month, Agency, TAFS, count(*) AS n_u, sum(value) AS s_u FROM u_long u JOIN latest l
        ON u.fiscal_year = l.fiscal_year AND u.month = l.month GROUP BY ALL)
FULL JOIN (SELECT b.fiscal_year, b.month, Agency, TAFS, count(*) AS n_b, sum(value) AS s_b FROM b_long b JOIN latest l
        ON b.fiscal_year = l.fiscal_year AND b.month = l.month GROUP BY ALL) USING (fiscal_year, month, Agency, TAFS)""")
def q_pair_counts(spark, d):
    """Rows of both lines per pairing key at the latest month (their product is the key's number of pairs)."""
    m = build_master(spark, d)
    out = pair_counts(split_oia(m), MO.latest_month(m))
    return out.withColumns({c: F.col(c).cast("double") for c in ("sum_2490", "sum_2500")})
