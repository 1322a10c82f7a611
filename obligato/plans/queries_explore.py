"""Registered queries: year / multi-year exploration (P5, P6; C6-C14, E12-E17, F1, F6, G*, H5, H6, B24, B27)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import facets as FA
from ..operators import rollup as R
from ..operators.months import available_months, list_periods, most_recent_month
from ..operators.pairing import sort_summary
from ..sources.sinks import export_year, load_year_month
from . import oracle_sql as S
from .pipelines import build_master, monthly_summary_from, year_summary_from
from .registry import register

Y = S.with_ctes("yearly")
M = S.with_ctes("monthly")
MY = S.with_ctes("monthly", "yearly")


def yearly(spark, d):
    return year_summary_from(build_master(spark, d))


def monthly(spark, d, months=None):
    return monthly_summary_from(build_master(spark, d), months)


def loaded(spark, d, month=None, fallback="skip"):
    """A5 rows for a view; the tables that the choice doesn't read are not built."""
    if month is None:
        return yearly(spark, d)
    m = build_master(spark, d)
    if fallback == "skip":
        return monthly_summary_from(m, [month])
    return load_year_month(year_summary_from(m), monthly_summary_from(m, [month]), month, fallback)


def _esum(c: str) -> str:
    return S.exact_sum(c)


def _dflt(c: str, text: str) -> str:
    return f"coalesce(nullif({c}, ''), {S.q(text)})"


def _with_pct(inner: str, u: str = "unobligated", b: str = "budget_authority") -> str:
    return f"SELECT *, {S.pct_rollup(u, b)} AS pct_unobligated FROM ({inner})"


# ------------------------------------------------------------------ E12-E14

@register("rollup_agency", Y + _with_pct(f"""
SELECT Fiscal_Year, {_dflt('Agency', 'Other')} AS Agency,
       {_dflt('Period_of_Performance', 'Unknown')} AS Period_of_Performance,
       {_dflt('Expiration_Year', 'Unknown')} AS Expiration_Year,
       {_esum('Budget_Authority_M')} AS budget_authority, {_esum('Unobligated_Balance_M')} AS unobligated,
       count(*) AS account_count, count(DISTINCT nullif(Bureau, '')) AS bureau_count
FROM yearly GROUP BY 1, 2, 3, 4"""))
def q_rollup_agency(spark, d):
    """Agency x period x expiration rollup of every year's summary."""
    return R.rollup(yearly(spark, d), "agency")


@register("rollup_bureau", Y + _with_pct(f"""
SELECT Fiscal_Year, {_dflt('Agency', 'Other')} AS Agency, {_dflt('Bureau', 'Other')} AS Bureau,
       {_dflt('Period_of_Performance', 'Unknown')} AS Period_of_Performance,
       {_dflt('Expiration_Year', 'Unknown')} AS Expiration_Year,
       {_esum('Budget_Authority_M')} AS budget_authority, {_esum('Unobligated_Balance_M')} AS unobligated,
       count(*) AS account_count
FROM yearly GROUP BY 1, 2, 3, 4, 5"""))
def q_rollup_bureau(spark, d):
    """Agency x bureau x period x expiration rollup."""
    return R.rollup(yearly(spark, d), "bureau")


@register("rollup_bureau_chart", Y + _with_pct(f"""
SELECT Fiscal_Year, {_dflt('Agency', 'Other')} AS Agency, {_dflt('Bureau', 'Other')} AS Bureau,
       {_esum('Budget_Authority_M')} AS budget_authority, {_esum('Unobligated_Balance_M')} AS unobligated,
       count(*) AS account_count
FROM yearly GROUP BY 1, 2, 3"""))
def q_rollup_bureau_chart(spark, d):
    """E13 chart form: agency x bureau only."""
    return R.rollup(yearly(spark, d), "bureau", by_period=False)


_FIRST = "{'b': -Budget_Authority_M, 't': TAFS, 'n': Account_Number}"


@register("rollup_account", Y + _with_pct(f"""
SELECT Fiscal_Year, Agency, Bureau, Account,
       {_esum('Budget_Authority_M')} AS budget_authority, {_esum('Unobligated_Balance_M')} AS unobligated,
       count(*) AS account_count,
       arg_min(Account_Number, {_FIRST}) AS Account_Number, arg_min(TAFS, {_FIRST}) AS TAFS
FROM yearly GROUP BY 1, 2, 3, 4"""))
def q_rollup_account(spark, d):
    """Agency x bureau x account, first account number and symbol in published order."""
    return R.rollup(yearly(spark, d), "account")


# ------------------------------------------------------------------ E15 / P6

def _mr_filter(src: str) -> str:
    return (f"SELECT s.* FROM {src} s JOIN (SELECT Fiscal_Year, max({S.month_ord('Month')}) AS o FROM {src} "
            f"GROUP BY Fiscal_Year) mr ON s.Fiscal_Year = mr.Fiscal_Year AND {S.month_ord('s.Month')} = mr.o")


def _load_sql(month: str | None, fallback: str = "skip") -> str:
    if month is None:
        return "SELECT * FROM yearly"
    chosen = f"SELECT * FROM monthly WHERE Month = {S.q(month)}"
    if fallback == "skip":
        return chosen
    return (f"{chosen} UNION ALL BY NAME SELECT * FROM yearly WHERE Fiscal_Year NOT IN "
            f"(SELECT Fiscal_Year FROM monthly WHERE Month = {S.q(month)})")


@register("load_year_month", MY + f"SELECT * FROM ({_load_sql('Sep', 'latest')})")
def q_load_year_month(spark, d):
    """A5: September of every year; a year without it shows its year summary."""
    return loaded(spark, d, "Sep", "latest")


@register("load_year_month_skip", MY + f"SELECT * FROM ({_load_sql('Sep')})")
def q_load_year_month_skip(spark, d):
    """A5: September of every year; a year without it is left out."""
    return loaded(spark, d, "Sep")


def _multi_sql(level: str, month=None, expiration=None, agencies=None, pct_range=None) -> str:
    where = ["TRUE"]
    if expiration is None:
        where.append("Expiration_Year = CAST(Fiscal_Year AS VARCHAR)")
    elif expiration != "ALL_YEARS":
        where.append("Expiration_Year IN (" + ", ".join(S.q(e) for e in expiration) + ")")
    if agencies:
        where.append("Agency IN (" + ", ".join(S.q(a) for a in agencies) + ")")
    if pct_range:
        lo, hi = R.parse_range(pct_range)
        where.append(f"Percentage_Unobligated >= {lo!r} AND Percentage_Unobligated <= {hi!r}")
    keys = ["Fiscal_Year", "Month", *R.LEVEL_KEYS[level]]
    extra = ""
    if level == "account":
        extra = f", arg_min(Period_of_Performance, {_FIRST}) AS _period"
    inner = (f"SELECT {', '.join(keys)}, {_esum('Budget_Authority_M')} AS budget_authority, "
             f"{_esum('Unobligated_Balance_M')} AS unobligated, count(*) AS account_count, "
             f"count(DISTINCT nullif(Bureau, '')) AS bureau_count{extra} "
             f"FROM ({_load_sql(month)}) WHERE {' AND '.join(where)} GROUP BY {', '.join(keys)}")
    if level == "agency":
        disp = ("CAST(bureau_count AS VARCHAR) || ' bureaus' AS Bureau, "
                "CAST(account_count AS VARCHAR) || ' accounts' AS Account, 'All' AS Period_of_Performance")
        cols = "*"
    elif level == "bureau":
        disp = "CAST(account_count AS VARCHAR) || ' accounts' AS Account, 'All' AS Period_of_Performance"
        cols = "*"
    else:
        disp = f"{_dflt('_period', 'All')} AS Period_of_Performance"
        cols = "* EXCLUDE (_period)"
    return MY + f"SELECT {cols}, {disp}, {S.pct_rollup('unobligated', 'budget_authority')} AS pct_unobligated FROM ({inner})"


@register("rollup_multi_year", _multi_sql("agency"))
def q_rollup_multi_year(spark, d):
    """Agency level, each year's summary, money expiring in year."""
    return R.rollup_multi_year(loaded(spark, d), "agency")


@register("rollup_multi_year_bureau", _multi_sql("bureau", month="Mar", pct_range="25-100"))
def q_rollup_multi_year_bureau(spark, d):
    """Bureau level, March of every year, rows with 25 <= pct <= 100."""
    return R.rollup_multi_year(loaded(spark, d, "Mar"), "bureau", pct_range="25-100")


@register("rollup_multi_year_account", _multi_sql("account", expiration="ALL_YEARS", agencies=["ASIA", "EUROPE"]))
def q_rollup_multi_year_account(spark, d):
    """Account level, all expiration years, two agencies."""
    return R.rollup_multi_year(loaded(spark, d), "account", expiration="ALL_YEARS",
                               agencies=["ASIA", "EUROPE"])


@register("most_recent_month", M + f"SELECT * FROM ({_mr_filter('monthly')})")
def q_most_recent_month(spark, d):
    """rows of each fiscal year's latest month."""
    return most_recent_month(monthly(spark, d))


@register("overall_totals", Y + _with_pct(f"""
SELECT Fiscal_Year, {_esum('Budget_Authority_M')} AS total_budget, {_esum('Unobligated_Balance_M')} AS total_unobligated,
       count(*) AS rows FROM yearly GROUP BY Fiscal_Year""", "total_unobligated", "total_budget"))
def q_overall_totals(spark, d):
    """Per-year totals over the year summary."""
    return R.overall_totals(yearly(spark, d), group=["Fiscal_Year"])


# ------------------------------------------------------------------ filters

@register("filter_dims", Y + """SELECT * FROM yearly WHERE Agency IN ('ASIA', 'AFRICA')
  AND Period_of_Performance IN ('No Year', 'FY2019', 'FY2018-FY2019')""")
def q_filter_dims(spark, d):
    """Membership filters on agency and period."""
    return R.filter_dims(yearly(spark, d), agencies=["ASIA", "AFRICA"],
                         periods=["No Year", "FY2019", "FY2018-FY2019"])


@register("filter_pct_range", Y + "SELECT * FROM yearly WHERE Percentage_Unobligated >= 50.0 AND Percentage_Unobligated <= 100.0")
def q_filter_pct_range(spark, d):
    """C7: 'Over 50 %' = 50 <= pct <= 100."""
    return R.filter_pct_range(yearly(spark, d), "50-100")


@register("filter_expiring", M + "SELECT * FROM monthly WHERE Expiration_Year = CAST(Fiscal_Year AS VARCHAR)")
def q_filter_expiring(spark, d):
    """Money expiring in its own fiscal year."""
    return R.filter_expiring(monthly(spark, d))


@register("filter_month", M + "SELECT * FROM monthly WHERE Month = 'Jun'")
def q_filter_month(spark, d):
    """One month across years."""
    return monthly(spark, d, ["Jun"])


@register("positive_budget", Y + "SELECT * FROM yearly WHERE Budget_Authority_M > 0")
def q_positive_budget(spark, d):
    """Chart rows with budget authority > 0."""
    return R.positive_budget(yearly(spark, d))


_SEARCH_COLS = ["Agency", "Bureau", "Account", "Account_Number", "Period_of_Performance"]


@register("search_rows", Y + "SELECT * FROM yearly WHERE contains(lower(concat_ws(' ', "
          + ", ".join(_SEARCH_COLS) + ")), 'brand#1') AND contains(lower(concat_ws(' ', "
          + ", ".join(_SEARCH_COLS) + ")), 'fy2019')")
def q_search_rows(spark, d):
    """Every search word must occur (case-insensitive) in the shown columns."""
    return R.search_rows(yearly(spark, d), ["Brand#1", "FY2019"], _SEARCH_COLS)


@register("rollup_levels", Y + _with_pct(f"""
SELECT Fiscal_Year, Month, CASE grouping_id(Agency, Bureau, Account) WHEN 3 THEN 'agency' WHEN 1 THEN 'bureau' ELSE 'account' END AS level,
  Agency, Bureau, Account, {_esum('Budget_Authority_M')} AS budget_authority, {_esum('Unobligated_Balance_M')} AS unobligated,
  count(*) AS account_count, count(DISTINCT nullif(Bureau, '')) AS bureau_count
FROM yearly GROUP BY GROUPING SETS ((Fiscal_Year, Month, Agency), (Fiscal_Year, Month, Agency, Bureau), (Fiscal_Year, Month, Agency, Bureau, Account))"""))
def q_rollup_levels(spark, d):
    """Agency, bureau and account level of all years in one aggregate over grouping sets."""
    return R.rollup_levels(yearly(spark, d), "ALL_YEARS")


# ------------------------------------------------------------------ facets

def _facets_sql(sel: dict) -> str:
    parts, cond = [], ["TRUE"]
    for name, col in FA.CASCADE:
        parts.append(f"SELECT Fiscal_Year, {S.q(name)} AS facet, {col} AS value, count(*) AS rows FROM yearly "
                     f"WHERE {' AND '.join(cond)} AND {col} IS NOT NULL AND {col} <> '' GROUP BY Fiscal_Year, {col}")
        if sel.get(name):
            cond.append(f"{col} = {S.q(sel[name])}")
    return " UNION ALL ".join(parts)


_SEL = {"agency": "ASIA", "bureau": "NATION_2"}


@register("facets", Y + _facets_sql(_SEL))
def q_facets(spark, d):
    """H5: cascading facet values with counts, per fiscal year."""
    return FA.facets(yearly(spark, d), _SEL, group=["Fiscal_Year"])


@register("search_facet", Y + f"SELECT * FROM ({_facets_sql(_SEL)}) WHERE contains(lower(value), 'nation_1')")
def q_search_facet(spark, d):
    """C14: case-insensitive facet search."""
    return R.search_facet(FA.facets(yearly(spark, d), _SEL, group=["Fiscal_Year"]), "NATION_1")


_STALE = {"agency": "ASIA", "bureau": "NATION_3", "period": "FY2019"}


@register("clear_stale_filters", S.with_ctes("yearly", extra=[
    ("sel", "SELECT * FROM (VALUES ('agency', 'ASIA'), ('bureau', 'NATION_3'), ('period', 'FY2019')) t(facet, selected)"),
    ("fv", "SELECT DISTINCT facet, value FROM (" + _facets_sql(_STALE).replace("FROM yearly", "FROM (SELECT * FROM yearly WHERE Fiscal_Year = 2019)") + ")"),
]) + """SELECT s.facet, s.selected, CASE WHEN fv.value IS NOT NULL THEN s.selected END AS kept
FROM sel s LEFT JOIN fv ON s.facet = fv.facet AND s.selected = fv.value""")
def q_clear_stale_filters(spark, d):
    """H6: selections absent from their facet list are cleared (FY2019 facets)."""
    fv = FA.facets(yearly(spark, d).where("Fiscal_Year = 2019"), _STALE)
    return FA.clear_stale_filters(spark, _STALE, fv)


_KEPT = {"agency": "ASIA", "bureau": "NATION_2", "period": None, "expiration": "2016"}


def _kept_sql(sel: dict, expiration: str) -> str:
    wanted = ", ".join(f"({S.q(n)}, {S.q(sel[n]) if sel.get(n) else 'NULL'})" for n, _ in FA.CASCADE)
    return S.with_ctes("yearly", extra=[("fv", _facets_sql(sel)), ("sel", f"SELECT * FROM (VALUES {wanted}) t(facet, selected)"),
                                        ("y", "SELECT DISTINCT Fiscal_Year FROM fv")]) + f"""
SELECT y.Fiscal_Year, s.facet, s.selected, CASE WHEN s.facet = 'expiration' THEN {expiration}
  WHEN EXISTS (SELECT 1 FROM fv WHERE fv.Fiscal_Year = y.Fiscal_Year AND fv.facet = s.facet AND fv.value = s.selected) THEN s.selected END AS kept
FROM y CROSS JOIN sel s"""


def _offered_sql(value: str) -> str:
    return f"EXISTS (SELECT 1 FROM fv WHERE fv.Fiscal_Year = y.Fiscal_Year AND fv.facet = 'expiration' AND fv.value = {value})"


_YEAR = "CAST(y.Fiscal_Year AS VARCHAR)"


@register("switch_year_filters", _kept_sql(_KEPT, f"""CASE WHEN {_offered_sql(_YEAR)} THEN {_YEAR}
  WHEN {_offered_sql("s.selected")} THEN s.selected END"""))
def q_switch_year_filters(spark, d):
    """H6: what stays selected when the view goes to each fiscal year; the expiration becomes that year where it is offered."""
    fv = FA.facets(yearly(spark, d), _KEPT, group=["Fiscal_Year"])
    return FA.kept_selections(fv, _KEPT, F.col("Fiscal_Year").cast("string"), ["Fiscal_Year"], switched=True)


_NO_EXPIRATION = {"agency": "ASIA", "period": "FY2016"}


@register("default_year_filters", _kept_sql(_NO_EXPIRATION, f"CASE WHEN {_offered_sql(_YEAR)} THEN {_YEAR} WHEN {_offered_sql(S.q('2016'))} THEN '2016' END"))
def q_default_year_filters(spark, d):
    """H6: without a selected expiration the fiscal year is taken where it is offered, else the fallback year, else none."""
    fv = FA.facets(yearly(spark, d), _NO_EXPIRATION, group=["Fiscal_Year"])
    return FA.kept_selections(fv, _NO_EXPIRATION, F.col("Fiscal_Year").cast("string"), ["Fiscal_Year"], fallback="2016")


# ------------------------------------------------------------------ chart, sorts, paging

@register("bubble_scale", Y + f"""
SELECT * EXCLUDE (mx), 5.0 + 35.0 * sqrt(budget_authority / mx) AS radius, pct_unobligated / 100.0 AS x FROM (
  SELECT *, max(budget_authority) OVER (PARTITION BY Fiscal_Year) AS mx FROM ({_with_pct(f'''
    SELECT Fiscal_Year, {_dflt('Agency', 'Other')} AS Agency,
      {_esum('Budget_Authority_M')} AS budget_authority, {_esum('Unobligated_Balance_M')} AS unobligated,
      count(*) AS account_count, count(DISTINCT nullif(Bureau, '')) AS bureau_count
    FROM yearly GROUP BY 1, 2''')}) WHERE budget_authority > 0)""")
def q_bubble_scale(spark, d):
    """bubble radius 5-40 by sqrt of budget share of the year's largest agency."""
    agg = R.rollup(yearly(spark, d), "agency", by_period=False)
    return R.bubble_scale(agg, 5.0, 40.0, group=["Fiscal_Year"])


_PAGE_ORDER = "Budget_Authority_M DESC, Fiscal_Year, TAFS, Bureau, Unobligated_Balance_M"


@register("page", Y + f"SELECT * FROM yearly ORDER BY {_PAGE_ORDER} LIMIT 25 OFFSET 25")
def q_page(spark, d):
    """Second page of 25 rows ordered by budget authority."""
    order = [F.col("Budget_Authority_M").desc(), F.col("Fiscal_Year"), F.col("TAFS"), F.col("Bureau"),
             F.col("Unobligated_Balance_M")]
    return R.page(yearly(spark, d), order, 25, 25)


@register("top_k", Y + f"""SELECT * FROM ({_with_pct(f'''
    SELECT Fiscal_Year, {_dflt('Agency', 'Other')} AS Agency,
      {_esum('Budget_Authority_M')} AS budget_authority, {_esum('Unobligated_Balance_M')} AS unobligated,
      count(*) AS account_count, count(DISTINCT nullif(Bureau, '')) AS bureau_count
    FROM yearly GROUP BY 1, 2''')}) ORDER BY budget_authority DESC, Fiscal_Year, Agency LIMIT 10""")
def q_top_k(spark, d):
    """Ten largest agency-years by budget authority."""
    agg = R.rollup(yearly(spark, d), "agency", by_period=False)
    return R.top_k(agg, [F.col("budget_authority").desc(), F.col("Fiscal_Year"), F.col("Agency")], 10)


@register("sort_summary", Y + "SELECT * FROM yearly ORDER BY Agency ASC NULLS LAST, Budget_Authority_M DESC NULLS LAST")
def q_sort_summary(spark, d):
    """G1: published order (agency, budget desc)."""
    return sort_summary(yearly(spark, d))


@register("expiry_flag", Y + """SELECT *, CASE WHEN Expiration_Year = '2021' THEN 'expiring'
  WHEN Expiration_Year = 'No Year' THEN 'no_year' ELSE 'other' END AS row_flag FROM yearly""")
def q_expiry_flag(spark, d):
    """Row flags for display year 2021."""
    return R.expiry_flags(yearly(spark, d), 2021)


@register("list_periods", S.with_ctes("avail") + """
SELECT fiscal_year AS Fiscal_Year, month AS Month, month_ord,
       month_ord = max(month_ord) OVER (PARTITION BY fiscal_year) AS is_latest
FROM avail ORDER BY Fiscal_Year, month_ord""")
def q_list_periods(spark, d):
    """Catalogue of (year, month) in fiscal order with the latest month flagged."""
    return list_periods(available_months(build_master(spark, d)))


@register("agency_table", Y + f"""
, per AS (SELECT Fiscal_Year, Agency, {_esum('Budget_Authority_M')} AS budget_authority,
                 {_esum('Unobligated_Balance_M')} AS unobligated, count(*) AS accounts FROM yearly GROUP BY 1, 2),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY Fiscal_Year ORDER BY budget_authority DESC, Agency) AS INTEGER)
                 AS rank FROM per),
folded AS (SELECT Fiscal_Year, CASE WHEN rank <= 3 THEN Agency ELSE 'All Other' END AS Agency,
                  {_esum('budget_authority')} AS budget_authority, {_esum('unobligated')} AS unobligated,
                  CAST(sum(accounts) AS BIGINT) AS accounts, min(rank) AS rank FROM ranked GROUP BY 1, 2)
SELECT *, {S.round1('CASE WHEN budget_authority <> 0 THEN unobligated / budget_authority * 100.0 END')} AS pct_unobligated
FROM folded""")
def q_agency_table(spark, d):
    """Per-year agency table, top three by budget and an 'All Other' row."""
    return R.agency_table(yearly(spark, d), 3)


# ------------------------------------------------------------------ P5 composed views

def _explore_sql(level: str, where: str) -> str:
    if level == "account":
        return f"""
SELECT Fiscal_Year, Agency, Bureau, Account, Account_Number, TAFS, Period_of_Performance, Expiration_Year,
       Budget_Authority_M AS budget_authority, Unobligated_Balance_M AS unobligated, Percentage_Unobligated AS pct_unobligated
FROM yearly WHERE {where}"""
    bureau = {"agency": ", count(DISTINCT nullif(Bureau, '')) AS bureau_count", "bureau": ""}[level]
    key = {"agency": "", "bureau": f", {_dflt('Bureau', 'Other')} AS Bureau"}[level]
    shown = ", CAST(bureau_count AS VARCHAR) || ' bureaus' AS Bureau" if level == "agency" else ""
    return f"""SELECT *, CAST(account_count AS VARCHAR) || ' accounts' AS Account{shown} FROM ({_with_pct(f"""
SELECT Fiscal_Year, {_dflt('Agency', 'Other')} AS Agency{key}, {_dflt('Period_of_Performance', 'Unknown')} AS Period_of_Performance,
       {_dflt('Expiration_Year', 'Unknown')} AS Expiration_Year, {_esum('Budget_Authority_M')} AS budget_authority,
       {_esum('Unobligated_Balance_M')} AS unobligated, count(*) AS account_count{bureau}
FROM yearly WHERE {where} GROUP BY ALL""")})"""


_VIEWS = {"agency": ("Expiration_Year = CAST(Fiscal_Year AS VARCHAR)", {}),
          "bureau": ("Agency IN ('ASIA', 'AMERICA')", {"expiration": "ALL_YEARS", "agencies": ["ASIA", "AMERICA"]}),
          "account": ("Agency = 'ASIA' AND Expiration_Year = CAST(Fiscal_Year AS VARCHAR)", {"agencies": ["ASIA"]})}
_ENTITY = {"agency": ("count(DISTINCT nullif(Agency, ''))", "agency", "agencies"),
           "bureau": ("count(DISTINCT nullif(Bureau, ''))", "bureau", "bureaus"), "account": ("count(*)", "accounts", "accounts")}


def _register_view(level: str) -> None:
    where, options = _VIEWS[level]
    inner = _explore_sql(level, where)
    entity, one, many = _ENTITY[level]

    @register(f"explore_year_{level}", Y + inner)
    def view(spark, d):
        return R.explore_year(yearly(spark, d), level, **options)

    view.__doc__ = f"P5/G2: composed view of every year at {level} level, largest budget first."

    @register(f"view_totals_{level}", Y + f"""
SELECT Fiscal_Year, total_budget, total_unobligated, entities, {S.pct_rollup('total_unobligated', 'total_budget')} AS pct_unobligated,
       CASE WHEN entities = 1 THEN '{one}' ELSE '{many}' END AS entity_type
FROM (SELECT Fiscal_Year, {_esum('budget_authority')} AS total_budget, {_esum('unobligated')} AS total_unobligated,
             {entity} AS entities FROM ({inner}) GROUP BY 1)""")
    def totals(spark, d):
        return R.view_totals(R.explore_year(yearly(spark, d), level, **options), level)

    totals.__doc__ = f"E16: totals and entity count of the {level} view."

    texts = {"agency": ["Agency", "Bureau", "Account"], "bureau": ["Agency", "Bureau", "Account"],
             "account": ["Agency", "Bureau", "Account", "Account_Number"]}[level] + ["Period_of_Performance", "Expiration_Year"]
    quoted = " || ',' || ".join(f"""'"' || replace({c}, '"', '""') || '"'""" for c in texts)
    number = lambda c: f"regexp_replace({S.fmt_fixed(c, 1)}, '\\.0$', '')"

    @register(f"export_year_{level}", Y + f"""
SELECT Fiscal_Year, {', '.join(texts)}, {quoted} || ',' || {number('unobligated')} || ',' || {number('budget_authority')}
       || ',' || {S.fmt_fixed('pct_unobligated', 1)} AS csv_line FROM ({inner})""")
    def export(spark, d):
        return export_year(R.explore_year(yearly(spark, d), level, **options), level)

    export.__doc__ = f"A27: CSV lines of the {level} view of each year."


for _level in _VIEWS:
    _register_view(_level)
