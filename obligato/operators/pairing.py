"""Line pairing and summary projection.

The published summaries pair every master row of line 2490 (unobligated
balance) with every master row of line 2500 (budget authority) of the same
agency and account symbol — a many-to-many equi-join that keeps duplicates
and matches NULL symbols to each other. Both sides are unpivoted to
(year, month, agency, symbol, value) first so the join key includes the
month: a hot symbol is spread over up to twelve keys, and AQE's skew join
splits what remains.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.constants import FISCAL_MONTHS, LINE_BUDGET_AUTHORITY, LINE_UNOBLIGATED, NEAR_ZERO_M, OIA
from ..functions.money import fmt_money, fmt_pct, pct_account, round1, to_millions
from ..functions.text import account_name, oia_bureau, to_number, with_components

SUMMARY_COLUMNS = ["Month", "Fiscal_Year", "Agency", "Bureau", "Account", "Account_Number",
                   "Period_of_Performance", "Expiration_Year", "TAFS",
                   "Unobligated_Balance_M", "Budget_Authority_M", "Percentage_Unobligated"]
DISPLAY_COLUMNS = ["Unobligated Balance (Line 2490)", "Budget Authority (Line 2500)",
                   "Percentage Unobligated"]


def select_line(master: DataFrame, line: int, col: str = "LINENO") -> DataFrame:
    """Rows of one report line after numeric coercion."""
    return master.where(to_number(F.col(col)) == float(line))


def split_oia(master: DataFrame, keep_oia: bool = False) -> DataFrame:
    """C4: standard agencies (default) or only Other Independent Agencies."""
    cond = F.col("Agency") == OIA
    return master.where(cond) if keep_oia else master.where(~cond | F.col("Agency").isNull())


def line_values(master: DataFrame, line: int, months: DataFrame, extra=("BUREAU",)) -> DataFrame:
    """Unpivot one line's master rows to (fiscal_year, month, Agency, TAFS, value)
    for the requested (fiscal_year, month) pairs. ``months`` has at most
    years x 12 rows, a proven bound, so it is broadcast."""
    ids = ["fiscal_year", "Agency", "TAFS", *extra]
    present = [m for m in FISCAL_MONTHS if m in master.columns]
    lg = select_line(master, line).select(*ids, *present).unpivot(ids, present, "month", "value")
    return lg.join(F.broadcast(months.select("fiscal_year", "month")), ["fiscal_year", "month"])


def oia_bureaus(master: DataFrame, code_name: str = "OMB_ACCOUNT") -> DataFrame:
    """Bureau of Other Independent Agencies rows: the name behind the code in ``code_name``, else the
    account's name."""
    return master.withColumn("BUREAU", oia_bureau(F.trim(F.col(code_name)), account_name(F.col("TAFS"))))


def pair_lines(master: DataFrame, months: DataFrame, keys=("Agency", "TAFS"),
               null_keys: str = "match") -> DataFrame:
    """2490 rows x 2500 rows on (year, month, keys); many-to-many kept.

    null_keys='match' reproduces the published behaviour (NULL symbols pair
    with each other, via null-safe equality); 'drop' removes NULL keys first.
    """
    u = line_values(master, LINE_UNOBLIGATED, months).withColumnRenamed("value", "value_2490")
    b = (line_values(master, LINE_BUDGET_AUTHORITY, months, extra=())
         .withColumnRenamed("value", "value_2500"))
    if null_keys == "drop":
        u, b = u.dropna(subset=list(keys)), b.dropna(subset=list(keys))
    b = b.select(F.col("fiscal_year").alias("_b_fiscal_year"), F.col("month").alias("_b_month"),
                 *[F.col(k).alias(f"_b_{k}") for k in keys], "value_2500")
    cond = (u.fiscal_year == b._b_fiscal_year) & (u.month == b._b_month)
    for k in keys:
        cond = cond & u[k].eqNullSafe(b[f"_b_{k}"])
    return u.join(b, cond).drop("_b_fiscal_year", "_b_month", *[f"_b_{k}" for k in keys])


def pair_counts(master: DataFrame, months: DataFrame, keys=("Agency", "TAFS")) -> DataFrame:
    """Rows and sums of both lines per (year, month, keys): what the pairing of a key would make, without pairs.

    A key's pairs number rows_2490 x rows_2500, NULL keys pair with each other; large products show hot keys.
    """
    by = ["fiscal_year", "month", *keys]
    u = line_values(master, LINE_UNOBLIGATED, months, extra=()).withColumn("is_u", F.lit(1))
    b = line_values(master, LINE_BUDGET_AUTHORITY, months, extra=()).withColumn("is_u", F.lit(0))
    both, of_u = u.unionByName(b), F.col("is_u") == 1
    return both.groupBy(*by).agg(F.count_if(of_u).alias("rows_2490"), F.count_if(~of_u).alias("rows_2500"),
                                 F.sum(F.when(of_u, F.col("value"))).alias("sum_2490"), F.sum(F.when(~of_u, F.col("value"))).alias("sum_2500"))


def pair_totals(master: DataFrame, months: DataFrame, keys=("Agency", "TAFS")) -> DataFrame:
    """D2 totals per year: pairs and their sums, each side aggregated per key first (pairs = n_u n_b, sums s_u n_b and s_b n_u)."""
    c = pair_counts(master, months, keys).where((F.col("rows_2490") > 0) & (F.col("rows_2500") > 0))
    return c.groupBy("fiscal_year").agg(
        F.sum(F.col("rows_2490") * F.col("rows_2500")).alias("pairs"),
        F.sum(F.col("sum_2490").cast("decimal(28,2)") * F.col("rows_2500").cast("decimal(10,0)")).cast("double").alias("unobligated"),
        F.sum(F.col("sum_2500").cast("decimal(28,2)") * F.col("rows_2490").cast("decimal(10,0)")).cast("double").alias("budget"))


def summarize_pairs(pairs: DataFrame) -> DataFrame:
    """B11-B16a + B17a: typed summary columns from paired values."""
    unob = to_millions(F.col("value_2490"))
    ba = to_millions(F.col("value_2500"))
    base = pairs.select(
        F.col("month").alias("Month"),
        F.col("fiscal_year").alias("Fiscal_Year"),
        F.col("Agency"),
        F.coalesce(F.col("BUREAU"), F.lit("")).alias("Bureau"),
        account_name(F.col("TAFS")).alias("Account"),
        F.col("TAFS"),
        unob.alias("_unob"), ba.alias("_ba"),
    )
    out = with_components(base)
    return out.select(
        "Month", "Fiscal_Year", "Agency", "Bureau", "Account", "Account_Number",
        "Period_of_Performance", "Expiration_Year", "TAFS",
        round1(F.col("_unob")).alias("Unobligated_Balance_M"),
        round1(F.col("_ba")).alias("Budget_Authority_M"),
        round1(pct_account(F.col("_unob"), F.col("_ba"))).alias("Percentage_Unobligated"),
        "_unob", "_ba",
    )


def drop_near_zero(df: DataFrame, eps: float = NEAR_ZERO_M) -> DataFrame:
    """Drop rows whose unobligated and budget values are both below eps (millions)."""
    both = (F.abs(F.col("_unob")) < eps) & (F.abs(F.col("_ba")) < eps)
    return df.where(~F.coalesce(both, F.lit(False)))


def with_display(df: DataFrame, null_text: str = "") -> DataFrame:
    """B17b: '$x,xxx.xM' and 'x.x%' display columns."""
    return df.withColumns({
        DISPLAY_COLUMNS[0]: fmt_money(F.col("Unobligated_Balance_M"), null_text),
        DISPLAY_COLUMNS[1]: fmt_money(F.col("Budget_Authority_M"), null_text),
        DISPLAY_COLUMNS[2]: fmt_pct(F.col("Percentage_Unobligated"), null_text),
    })


def sort_summary(df: DataFrame) -> DataFrame:
    """G1: Agency ascending, budget authority descending, NULLs last."""
    return df.orderBy(F.col("Agency").asc_nulls_last(), F.col("Budget_Authority_M").desc_nulls_last())
