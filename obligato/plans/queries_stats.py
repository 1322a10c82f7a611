"""Registered queries: history-aware outlier statistics.

Fixture years: FY2021 is the report year, FY2015-FY2020 the history window.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.constants import FDR_ALPHA
from ..functions.stats import two_sided_p_sql
from ..operators import outliers as O
from . import oracle_sql as S
from .pipelines import build_master, monthly_summary_from
from .registry import register

CUR, H1, H2 = 2021, 2015, 2020
ALPHA = FDR_ALPHA
D = "CAST({} AS DOUBLE)"


def monthly(spark, d):
    # the statistics read only the month of record: pair that month alone
    return monthly_summary_from(build_master(spark, d), ["Sep"])


def _sep(extra: str = "") -> str:
    return f"SELECT * FROM monthly WHERE Month = 'Sep' AND Expiration_Year = CAST(Fiscal_Year AS VARCHAR) {extra}"


def _np_round(x: str, n: int) -> str:
    f = float(10 ** n)
    return f"(round_even(({x}) * {f!r}::DOUBLE, 0) / {f!r}::DOUBLE)"


def level_ctes(level: str, cols: list[str], min_budget: float) -> list[tuple[str, str]]:
    k = ", ".join(cols)
    nn = " AND ".join(f"{c} IS NOT NULL" for c in cols)
    acc = ", count(Account) AS accounts" if "Account" not in cols else ""
    on = " AND ".join(f"o.{c} = h.{c}" for c in cols)
    ent = "concat_ws(' | ', " + ", ".join(f"CAST({c} AS VARCHAR)" for c in cols) + ")"
    return [
        (f"s_{level}", f"""SELECT * FROM (SELECT *, {S.pct_rollup('unobligated', 'budget')} AS pct FROM (
            SELECT {k}, {S.exact_sum('Unobligated_Balance_M')} AS unobligated, {S.exact_sum('Budget_Authority_M')} AS budget{acc}
            FROM ({_sep(f'AND Fiscal_Year = {CUR}')}) WHERE {nn} GROUP BY {k})) WHERE budget >= {min_budget!r}"""),
        (f"z_{level}", f"""SELECT *, {two_sided_p_sql('z')} AS p_value FROM (
            SELECT s.*, '{level}' AS level, {ent} AS entity,
                   CASE WHEN st.sd > 0 THEN (s.pct - st.mean) / st.sd END AS z
            FROM s_{level} s, (SELECT avg(pct) AS mean, stddev_samp(pct) AS sd FROM s_{level}) st)"""),
        (f"r_{level}", f"""SELECT DISTINCT p_value,
            count(*) OVER (ORDER BY p_value RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS rank_max,
            count(*) OVER () AS n FROM z_{level} WHERE p_value IS NOT NULL"""),
        (f"c_{level}", f"""SELECT p_value, rank_max, n, least(1.0, min(p_value * n / rank_max) OVER (
            ORDER BY p_value DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS p_corrected FROM r_{level}"""),
        (f"t_{level}", f"SELECT max(p_value) AS thr FROM r_{level} WHERE p_value <= rank_max / n * {ALPHA!r}"),
        (f"o_{level}", f"""SELECT z.*, c.p_corrected, coalesce(z.p_value <= (SELECT thr FROM t_{level}), false) AS is_outlier
            FROM z_{level} z LEFT JOIN c_{level} c ON z.p_value = c.p_value"""),
        (f"h_{level}", f"""SELECT {k}, avg(pct) AS hist_avg, max(pct) AS hist_high, count(*) AS hist_years,
                   count(*) < {H2 - H1 + 1} AS missing_years FROM (
            SELECT {k}, Fiscal_Year, CASE WHEN b > 0 THEN u / b * 100.0 END AS pct FROM (
              SELECT {k}, Fiscal_Year, {S.exact_sum('Unobligated_Balance_M')} AS u, {S.exact_sum('Budget_Authority_M')} AS b
              FROM ({_sep(f'AND Fiscal_Year BETWEEN {H1} AND {H2}')}) WHERE {nn} GROUP BY {k}, Fiscal_Year))
            WHERE pct >= 0 GROUP BY {k}"""),
        (f"j_{level}", f"""SELECT o.*, h.hist_avg, h.hist_high, h.hist_years, h.missing_years
            FROM o_{level} o LEFT JOIN h_{level} h ON {on}"""),
    ]


def _display(src: str, kind: str) -> str:
    def hist(c):
        return (f"CASE WHEN {c} IS NULL THEN 'N/A' WHEN missing_years THEN {S.fmt_fixed(c, 1)} || '*' "
                f"ELSE {S.fmt_fixed(c, 1)} END")
    return (f"SELECT level, '{kind}' AS kind, entity, {_np_round('pct', 1)} AS pct_unobligated, "
            f"{hist('hist_avg')} AS hist_avg_display, {hist('hist_high')} AS previous_high_display, "
            f"{_np_round('budget / 1000.0::DOUBLE', 1)} AS budget_billions, {_np_round('z', 2)} AS z_score FROM ({src})")


def _report_sql() -> str:
    extra, parts = [], []
    for level, (cols, mb) in O.LEVELS.items():
        extra += level_ctes(level, cols, mb)
        parts.append(_display(f"SELECT * FROM j_{level} WHERE z > 0 AND is_outlier", "outlier"))
        parts.append(_display(
            f"SELECT * FROM (SELECT * FROM j_{level} WHERE z > 0 AND NOT is_outlier ORDER BY pct DESC, entity LIMIT 15) "
            f"WHERE hist_avg IS NULL OR pct > hist_avg ORDER BY pct DESC, entity LIMIT 10", "notable"))
    return S.with_ctes("monthly", extra=extra) + " UNION ALL ".join(f"({p})" for p in parts)


@register("outlier_report", _report_sql())
def q_outlier_report(spark, d):
    """Outliers and notable entities at agency, bureau and account level (FY2021 vs 2015-2020)."""
    return O.outlier_report(monthly(spark, d), CUR, H1, H2, ALPHA)


@register("yearly_pct", S.with_ctes("monthly") + f"""
SELECT *, {S.pct_rollup('total_unobligated', 'total_budget')} AS percent_unobligated FROM (
  SELECT Fiscal_Year, {S.exact_sum('Unobligated_Balance_M')} AS total_unobligated,
         {S.exact_sum('Budget_Authority_M')} AS total_budget FROM ({_sep()}) GROUP BY Fiscal_Year)""")
def q_yearly_pct(spark, d):
    """September pct unobligated of money expiring in year, per year."""
    return O.yearly_pct(monthly(spark, d))


@register("yearly_pct_history", S.with_ctes("monthly") + f"""
SELECT {_np_round('avg(percent_unobligated)', 9)} AS avg_pct, max(percent_unobligated) AS previous_high,
       count(*) AS years FROM (
  SELECT *, {S.pct_rollup('total_unobligated', 'total_budget')} AS percent_unobligated FROM (
    SELECT Fiscal_Year, {S.exact_sum('Unobligated_Balance_M')} AS total_unobligated,
           {S.exact_sum('Budget_Authority_M')} AS total_budget FROM ({_sep()}) GROUP BY Fiscal_Year))
WHERE Fiscal_Year <= {H2}""")
def q_yearly_pct_history(spark, d):
    """History mean (9 dp) and previous high of the yearly pct."""
    h = O.yearly_pct_history(O.yearly_pct(monthly(spark, d)), H2)
    return h.select(O.np_round(F.col("avg_pct"), 9).alias("avg_pct"), "previous_high", "years")


_B_COLS, _B_MIN = O.LEVELS["bureau"]
_A_COLS, _A_MIN = O.LEVELS["account"]


@register("entity_summary", S.with_ctes("monthly", extra=level_ctes("bureau", _B_COLS, _B_MIN)[:1])
          + "SELECT * FROM s_bureau")
def q_entity_summary(spark, d):
    """Bureau-level sums, account counts and pct for FY2021 (budget >= 50 M)."""
    return O.entity_summary(O.sep_expiring(monthly(spark, d)).where(F.col("Fiscal_Year") == CUR),
                            _B_COLS, _B_MIN)


def _acct(spark, d):
    s = (O.entity_summary(O.sep_expiring(monthly(spark, d)).where(F.col("Fiscal_Year") == CUR), _A_COLS, _A_MIN)
         .withColumn("level", F.lit("account")))
    return O.z_scores(s)


@register("z_scores", S.with_ctes("monthly", extra=level_ctes("account", _A_COLS, _A_MIN)[:2]) + f"""
SELECT Agency, Bureau, Account, pct, {_np_round('z', 6)} AS z, {_np_round('p_value', 9)} AS p_value FROM z_account""")
def q_z_scores(spark, d):
    """account-level z scores and two-sided normal p-values (6 and 9 dp)."""
    z = _acct(spark, d)
    return z.select("Agency", "Bureau", "Account", "pct", O.np_round(F.col("z"), 6).alias("z"),
                    O.np_round(F.col("p_value"), 9).alias("p_value"))


@register("bh_fdr", S.with_ctes("monthly", extra=level_ctes("account", _A_COLS, _A_MIN)[:6]) + f"""
SELECT Agency, Bureau, Account, {_np_round('p_value', 9)} AS p_value, is_outlier,
       {_np_round('p_corrected', 9)} AS p_corrected FROM o_account""")
def q_bh_fdr(spark, d):
    """Benjamini-Hochberg decisions and corrected p-values at account level."""
    b = O.bh_fdr(_acct(spark, d), ALPHA)
    return b.select("Agency", "Bureau", "Account", O.np_round(F.col("p_value"), 9).alias("p_value"),
                    "is_outlier", O.np_round(F.col("p_corrected"), 9).alias("p_corrected"))


@register("history_stats", S.with_ctes("monthly", extra=[level_ctes("bureau", _B_COLS, _B_MIN)[6]]) + f"""
SELECT Agency, Bureau, {_np_round('hist_avg', 9)} AS hist_avg, hist_high, hist_years, missing_years FROM h_bureau""")
def q_history_stats(spark, d):
    """Per bureau history (2015-2020) mean, high, year count and missing flag."""
    h = O.history_stats(monthly(spark, d), _B_COLS, H1, H2)
    return h.select("Agency", "Bureau", O.np_round(F.col("hist_avg"), 9).alias("hist_avg"), "hist_high",
                    "hist_years", "missing_years")
