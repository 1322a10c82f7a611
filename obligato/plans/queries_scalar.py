"""Registered queries: scalar Column functions over fixture columns
(B5, B7-B12, B14, B17c, B18-B22, B25, B26)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import calendar as C
from ..functions import money as MN
from ..functions import text as TX
from ..sources.fixture import ledger_rows, table
from . import oracle_sql as S
from .pipelines import build_master, year_summary_from
from .registry import register

URL_BASE = "https://accounts.example.org/account/"


def yearly(spark, d):
    return year_summary_from(build_master(spark, d))


_FY1, _FY2 = S.fy_bounds("TAFS")


@register("derive_codes", S.with_ctes("ledger") + f"""
SELECT TAFS, FY1, FY2, ALLOC, {_FY1} AS DERIVED_FY1, {_FY2} AS DERIVED_FY2, {S.alloc('TAFS')} AS DERIVED_ALLOC,
  {S.normalize('FY1')} AS n_fy1, {S.normalize('FY2')} AS n_fy2, {S.normalize('ALLOC')} AS n_alloc
FROM (SELECT DISTINCT TAFS, FY1, FY2, ALLOC FROM ledger)""")
def q_derive_codes(spark, d):
    """Derived period bounds and allocation code, normalised given codes."""
    x = ledger_rows(spark, d).select("TAFS", "FY1", "FY2", "ALLOC").distinct()
    x = TX.with_derived_codes(x)
    return TX.with_normalized(x, {"n_fy1": "FY1", "n_fy2": "FY2", "n_alloc": "ALLOC"})


_ACC, _PER, _EXP = S.components("TAFS", "Agency")


@register("tafs_components", S.with_ctes("master") + f"""
SELECT Agency, TAFS, {_ACC} AS Account_Number, {_PER} AS Period_of_Performance, {_EXP} AS Expiration_Year,
       {S.account_name('TAFS')} AS Account
FROM (SELECT DISTINCT Agency, TAFS FROM master)""")
def q_tafs_components(spark, d):
    """Account number, period, expiration and account name of every symbol."""
    x = build_master(spark, d).select("Agency", "TAFS").distinct()
    return TX.with_components(x).withColumn("Account", TX.account_name(F.col("TAFS")))


@register("tafs_components_oia", S.with_ctes("master") + f"""
SELECT TAFS, {S.components('TAFS', "'Other Independent Agencies'")[0]} AS Account_Number,
  {S.components('TAFS', "'Other Independent Agencies'")[1]} AS Period_of_Performance,
  {S.components('TAFS', "'Other Independent Agencies'")[2]} AS Expiration_Year
FROM (SELECT DISTINCT TAFS FROM master)""")
def q_tafs_components_oia(spark, d):
    """The whitespace-token grammar applied to every symbol."""
    x = build_master(spark, d).select("TAFS").distinct().withColumn("Agency", F.lit("Other Independent Agencies"))
    return TX.with_components(x).drop("Agency")


@register("canonical_agency", S.with_ctes("ledger") + f"""
SELECT AGENCY_TITLE, {S.canonical_agency('AGENCY_TITLE')} AS Agency,
       {S.canonical_agency("'Dept of ' || AGENCY_TITLE || ' -- Department of Defense--Military Programs'")} AS Agency_variant
FROM (SELECT DISTINCT AGENCY_TITLE FROM ledger)""")
def q_canonical_agency(spark, d):
    """Raw agency text -> target agency (plus a decorated variant that hits a special rule)."""
    x = ledger_rows(spark, d).select("AGENCY_TITLE").distinct()
    variant = F.concat(F.lit("Dept of "), F.col("AGENCY_TITLE"), F.lit(" -- Department of Defense--Military Programs"))
    return x.select("AGENCY_TITLE", TX.canonical_agency(F.col("AGENCY_TITLE")).alias("Agency"),
                    TX.canonical_agency(variant).alias("Agency_variant"))


@register("clean_text", f"SELECT doc_id, {S.clean_text('text')} AS cleaned FROM documents")
def q_clean_text(spark, d):
    """Whole document texts with CR/LF and whitespace runs collapsed."""
    return table(spark, d, "documents").select("doc_id", TX.clean_text(F.col("text")).alias("cleaned"))


@register("oia_bureau", S.with_ctes("master") + """
SELECT DISTINCT TAFS, coalesce(nullif(regexp_extract(TAFS, '^\\S+\\s+(.*)$', 1), ''), BUREAU) AS bureau FROM master""")
def q_oia_bureau(spark, d):
    """Bureau text after the first whitespace run of the symbol, else the bureau."""
    return build_master(spark, d).select("TAFS", TX.oia_bureau(F.col("TAFS"), F.col("BUREAU")).alias("bureau")).distinct()


@register("parse_display", S.with_ctes("yearly") + """
SELECT TAFS, Fiscal_Year, Bureau,
  TRY_CAST(regexp_replace("Budget Authority (Line 2500)", '[$,M]', '', 'g') AS DOUBLE) AS ba,
  TRY_CAST(regexp_replace("Unobligated Balance (Line 2490)", '[$,M]', '', 'g') AS DOUBLE) AS unob,
  TRY_CAST(replace("Percentage Unobligated", '%', '') AS DOUBLE) AS pct,
  '$' || replace(format('{:,.1f}', Budget_Authority_M), ',', '') || 'M' AS ba_quarter_text,
  Budget_Authority_M - Unobligated_Balance_M AS obligated,
  concat_ws(' | ', Agency, Bureau, Account) AS entity
FROM yearly""")
def q_parse_display(spark, d):
    """Display text back to numbers, ungrouped money text, obligated, entity label."""
    y = yearly(spark, d)
    return y.select("TAFS", "Fiscal_Year", "Bureau",
                    MN.parse_money(F.col("Budget Authority (Line 2500)")).alias("ba"),
                    MN.parse_money(F.col("Unobligated Balance (Line 2490)")).alias("unob"),
                    MN.parse_pct(F.col("Percentage Unobligated")).alias("pct"),
                    MN.fmt_money(F.col("Budget_Authority_M"), grouping=False).alias("ba_quarter_text"),
                    MN.obligated(F.col("Budget_Authority_M"), F.col("Unobligated_Balance_M")).alias("obligated"),
                    TX.entity_label("Agency", "Bureau", "Account").alias("entity"))


_CAL = "['Jan','Feb','Mar','Apr','May','Jun','Jul','Aug','Sep','Oct','Nov','Dec']"
_FULL = "(CASE " + " ".join(f"WHEN {S.q(k)} THEN {S.q(v)}" for k, v in C.MONTH_FULL.items()).replace(
    "WHEN ", "WHEN mon = ") + " END)"


@register("fiscal_calendar", f"""
SELECT y, m, CAST(y + CASE WHEN m >= 10 THEN 1 ELSE 0 END AS INTEGER) AS fiscal_year, {_CAL}[m] AS month,
  {S.month_ord(f'{_CAL}[m]')} AS month_ord, CAST(ceil({S.month_ord(f'{_CAL}[m]')} / 3.0) AS INTEGER) AS quarter,
  {_FULL.replace("mon =", _CAL + "[m] =")} AS month_full, count(*) AS rows
FROM (SELECT CAST(year(l_shipdate) AS INTEGER) AS y, CAST(month(l_shipdate) AS INTEGER) AS m FROM lineitem)
GROUP BY y, m""")
def q_fiscal_calendar(spark, d):
    """Fiscal year, month, month order, quarter and full month name of every ship month."""
    li = table(spark, d, "lineitem")
    g = li.groupBy(F.year("l_shipdate").alias("y"), F.month("l_shipdate").alias("m")).agg(
        F.count(F.lit(1)).alias("rows"))
    mon = C.month_abbr(F.make_date(F.col("y"), F.col("m"), F.lit(1)))
    return g.select("y", "m", (F.col("y") + F.when(F.col("m") >= 10, 1).otherwise(0)).alias("fiscal_year"),
                    mon.alias("month"), C.fiscal_month_ord(mon).alias("month_ord"),
                    C.fiscal_quarter(mon).alias("quarter"), C.month_full(mon).alias("month_full"), "rows")


@register("external_account_url", S.with_ctes("yearly") + f"""
SELECT DISTINCT Account_Number, CASE WHEN len(string_split(Account_Number, '-')) = 2 THEN
  '{URL_BASE}' || CASE WHEN length(string_split(Account_Number, '-')[1]) = 2 THEN lpad(string_split(Account_Number, '-')[1], 3, '0')
                      ELSE string_split(Account_Number, '-')[1] END || '-' || string_split(Account_Number, '-')[2] END AS url
FROM yearly""")
def q_external_account_url(spark, d):
    """Link for two-part account numbers (first part padded to 3 digits)."""
    y = yearly(spark, d)
    return y.select("Account_Number", TX.external_account_url(F.col("Account_Number"), URL_BASE).alias("url")).distinct()
