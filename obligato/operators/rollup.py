"""Rollups, filters, sorts and paging over summary rows.

Every rollup is one ``groupBy().agg()`` with map-side partial aggregation:
a hot agency shrinks to one partial row per task before the shuffle, so no
single task ever sees an agency's raw rows. Money is summed as decimals
(values carry one decimal), which makes totals exact and independent of
partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.money import exact_sum, pct_rollup
from ..functions.text import or_default
from .months import most_recent_month

BA, UNOB, PCT = "Budget_Authority_M", "Unobligated_Balance_M", "Percentage_Unobligated"


def _first_in_order(c: str) -> Column:
    """Value of the first row in published order (budget desc, then symbol)."""
    return F.min_by(F.col(c), F.struct(-F.col(BA), F.col("TAFS"), F.col("Account_Number")))


# ------------------------------------------------------------------ filters

def filter_dims(df: DataFrame, agencies=None, bureaus=None, periods=None, expirations=None) -> DataFrame:
    """Conjunction of membership filters; None / empty = no filter."""
    for col, vals in (("Agency", agencies), ("Bureau", bureaus),
                      ("Period_of_Performance", periods), ("Expiration_Year", expirations)):
        if vals:
            df = df.where(F.col(col).isin(list(vals)))
    return df


def parse_range(spec: str) -> tuple[float, float]:
    lo, hi = spec.split("-")
    return float(lo), float(hi)


def filter_pct_range(df: DataFrame, spec: str | None, col: str = PCT) -> DataFrame:
    """C7: 'min-max', inclusive at both ends."""
    if not spec:
        return df
    lo, hi = parse_range(spec)
    return df.where((F.col(col) >= lo) & (F.col(col) <= hi))


def filter_expiring(df: DataFrame, mode=None, year_col: str = "Fiscal_Year") -> DataFrame:
    """Default keeps money expiring in its own fiscal year; 'ALL_YEARS' keeps
    all; a list keeps those expiration years."""
    if mode is None:
        return df.where(F.col("Expiration_Year") == F.col(year_col).cast("string"))
    if mode == "ALL_YEARS" or (isinstance(mode, (list, tuple)) and mode and mode[0] == "ALL_YEARS"):
        return df
    return df.where(F.col("Expiration_Year").isin(list(mode)))


def filter_month(df: DataFrame, month: str | None, col: str = "Month") -> DataFrame:
    """A given month, or each year's most recent month when None."""
    return most_recent_month(df) if month is None else df.where(F.col(col) == month)


def positive_budget(df: DataFrame, col: str = BA) -> DataFrame:
    """Budget authority > 0."""
    return df.where(F.col(col) > 0)


def search_rows(df: DataFrame, words: list[str], cols: list[str]) -> DataFrame:
    """Case-insensitive; every word must occur in the joined shown columns."""
    text = F.lower(F.concat_ws(" ", *[F.col(c).cast("string") for c in cols]))
    for w in words:
        df = df.where(text.contains(w.lower()))
    return df


def search_facet(df: DataFrame, term: str, col: str = "value") -> DataFrame:
    """C14: case-insensitive contains on facet values."""
    return df.where(F.lower(F.col(col)).contains(term.lower()))


# ------------------------------------------------------------------ rollups

def rollup(df: DataFrame, level: str = "agency", by_period: bool = True,
           year_col: str | None = "Fiscal_Year") -> DataFrame:
    """E12 (agency), E13 (bureau), E14 (account) rollups of summary rows.

    by_period=True groups by period and expiration too (table form); False is
    the chart form. Blank keys read 'Other' / 'Unknown' as displayed.
    """
    keys: list[Column] = [] if year_col is None else [F.col(year_col)]
    if level == "account":
        keys += [F.col("Agency"), F.col("Bureau"), F.col("Account")]
    else:
        keys.append(or_default("Agency", "Other").alias("Agency"))
        if level == "bureau":
            keys.append(or_default("Bureau", "Other").alias("Bureau"))
        if by_period:
            keys += [or_default("Period_of_Performance", "Unknown").alias("Period_of_Performance"),
                     or_default("Expiration_Year", "Unknown").alias("Expiration_Year")]
    aggs = [exact_sum(BA).alias("budget_authority"), exact_sum(UNOB).alias("unobligated"),
            F.count(F.lit(1)).alias("account_count")]
    if level == "agency":
        aggs.append(F.count_distinct(F.nullif(F.col("Bureau"), F.lit(""))).alias("bureau_count"))
    if level == "account":
        aggs += [_first_in_order("Account_Number").alias("Account_Number"),
                 _first_in_order("TAFS").alias("TAFS")]
    out = df.groupBy(*keys).agg(*aggs)
    return out.withColumn("pct_unobligated", pct_rollup(F.col("unobligated"), F.col("budget_authority")))


LEVEL_KEYS = {"agency": ["Agency"], "bureau": ["Agency", "Bureau"], "account": ["Agency", "Bureau", "Account"]}


def rollup_multi_year(rows: DataFrame, level: str = "agency", expiration=None, agencies=None, bureaus=None,
                      periods=None, pct_range: str | None = None) -> DataFrame:
    """Loaded rows of all years (``sources.sinks.load_year_month``) -> expiration filter
    -> dimension and percentage filters -> one groupBy per level with display
    fields (B27)."""
    df = filter_expiring(rows, expiration)
    df = filter_dims(df, agencies, bureaus, periods)
    df = filter_pct_range(df, pct_range)
    keys = ["Fiscal_Year", "Month", *LEVEL_KEYS[level]]
    aggs = [exact_sum(BA).alias("budget_authority"), exact_sum(UNOB).alias("unobligated"),
            F.count(F.lit(1)).alias("account_count"),
            F.count_distinct(F.nullif(F.col("Bureau"), F.lit(""))).alias("bureau_count")]
    if level == "account":
        aggs.append(_first_in_order("Period_of_Performance").alias("_period"))
    out = df.groupBy(*keys).agg(*aggs)
    return level_display(out, level).withColumn(
        "pct_unobligated", pct_rollup(F.col("unobligated"), F.col("budget_authority")))


def rollup_levels(rows: DataFrame, expiration=None, agencies=None, bureaus=None, periods=None, pct_range: str | None = None) -> DataFrame:
    """E12-E15 at all three levels at once: the filtered rows go through one aggregate over grouping sets.

    Keys below a row's ``level`` are null. The bureau count of an agency comes from its bureau groups, which are
    few, instead of a distinct count over the rows.
    """
    df = filter_pct_range(filter_dims(filter_expiring(rows, expiration), agencies, bureaus, periods), pct_range)
    time, every = [F.col("Fiscal_Year"), F.col("Month")], LEVEL_KEYS["account"]
    sets = [[*time, *map(F.col, keys)] for keys in LEVEL_KEYS.values()]
    out = df.groupingSets(sets, *time, *every).agg(
        exact_sum(BA).alias("budget_authority"), exact_sum(UNOB).alias("unobligated"), F.count(F.lit(1)).alias("account_count"), F.grouping_id().alias("_set"))
    level = F.when(F.col("_set") == 3, "agency").when(F.col("_set") == 1, "bureau").otherwise("account")
    agency = Window.partitionBy(*time, "Agency")
    named = (F.col("_set") == 1) & (F.col("Bureau") != "")
    of_agency, own = F.sum(F.when(named, 1).otherwise(0)).over(agency), F.when(F.coalesce(F.col("Bureau") != "", F.lit(False)), 1).otherwise(0)
    return (out.withColumn("level", level).withColumn("bureau_count", F.when(F.col("_set") == 3, of_agency).otherwise(own).cast("long"))
            .withColumn("pct_unobligated", pct_rollup(F.col("unobligated"), F.col("budget_authority")))
            .select("Fiscal_Year", "Month", "level", *every, "budget_authority", "unobligated", "account_count", "bureau_count", "pct_unobligated"))


def explore_year(yearly: DataFrame, level: str = "account", expiration=None, agencies=None, bureaus=None, periods=None,
                 pct_range: str | None = None) -> DataFrame:
    """P5: one composed view per fiscal year: filters -> rollup at the level -> display texts, largest budget
    first within a year (G2). Account level shows the rows themselves."""
    df = filter_pct_range(filter_dims(filter_expiring(yearly, expiration), agencies, bureaus, periods), pct_range)
    if level == "account":
        out = df.select("Fiscal_Year", *LEVEL_KEYS[level], "Account_Number", "TAFS", "Period_of_Performance", "Expiration_Year",
                        F.col(BA).alias("budget_authority"), F.col(UNOB).alias("unobligated"),
                        F.col("Percentage_Unobligated").alias("pct_unobligated"))
    else:
        out = rollup(df, level)
        count = F.concat(F.col("account_count").cast("string"), F.lit(" accounts"))
        out = out.withColumn("Account", count)
        if level == "agency":
            out = out.withColumn("Bureau", F.concat(F.col("bureau_count").cast("string"), F.lit(" bureaus")))
    return sort_budget_desc(out, "budget_authority", ties=("Fiscal_Year", *LEVEL_KEYS[level], "Period_of_Performance", "Expiration_Year"))


def view_totals(view: DataFrame, level: str) -> DataFrame:
    """E16 of a view: sums, percentage, and the number of different agencies, bureaus or rows that the level counts."""
    entity = {"agency": F.count_distinct(F.nullif(F.col("Agency"), F.lit(""))),
              "bureau": F.count_distinct(F.nullif(F.col("Bureau"), F.lit(""))), "account": F.count(F.lit(1))}[level]
    one, many = {"agency": ("agency", "agencies"), "bureau": ("bureau", "bureaus"), "account": ("accounts", "accounts")}[level]
    out = view.groupBy("Fiscal_Year").agg(exact_sum("budget_authority").alias("total_budget"),
                                          exact_sum("unobligated").alias("total_unobligated"), entity.alias("entities"))
    return out.withColumns({
        "pct_unobligated": pct_rollup(F.col("total_unobligated"), F.col("total_budget")),
        "entity_type": F.when(F.col("entities") == 1, F.lit(one)).otherwise(F.lit(many))})


def level_display(agg: DataFrame, level: str) -> DataFrame:
    """Display text per level ('N bureaus', 'N accounts', period 'All')."""
    if level == "agency":
        return agg.withColumns({
            "Bureau": F.concat(F.col("bureau_count").cast("string"), F.lit(" bureaus")),
            "Account": F.concat(F.col("account_count").cast("string"), F.lit(" accounts")),
            "Period_of_Performance": F.lit("All")})
    if level == "bureau":
        return agg.withColumns({
            "Account": F.concat(F.col("account_count").cast("string"), F.lit(" accounts")),
            "Period_of_Performance": F.lit("All")})
    return agg.withColumn("Period_of_Performance", or_default("_period", "All")).drop("_period")


def overall_totals(df: DataFrame, ba: str = BA, unob: str = UNOB, group: list[str] | None = None) -> DataFrame:
    """Sums, percentage and row count (optionally per group)."""
    aggs = [exact_sum(ba).alias("total_budget"), exact_sum(unob).alias("total_unobligated"),
            F.count(F.lit(1)).alias("rows")]
    out = df.groupBy(*(group or [])).agg(*aggs)
    return out.withColumn("pct_unobligated", pct_rollup(F.col("total_unobligated"), F.col("total_budget")))


def agency_table(df: DataFrame, k: int = 10, year_col: str = "Fiscal_Year") -> DataFrame:
    """Per agency sums, count, unguarded pct rounded; ranked by budget; the
    agencies beyond the top k are folded into one 'All Other' row per year."""
    from pyspark.sql import Window
    from ..functions.money import pct_unguarded, round_n
    per = (df.groupBy(year_col, "Agency")
           .agg(exact_sum(BA).alias("budget_authority"), exact_sum(UNOB).alias("unobligated"),
                F.count(F.lit(1)).alias("accounts")))
    w = Window.partitionBy(year_col).orderBy(F.col("budget_authority").desc(), F.col("Agency"))
    ranked = per.withColumn("rank", F.row_number().over(w))
    label = F.when(F.col("rank") <= k, F.col("Agency")).otherwise(F.lit("All Other"))
    out = (ranked.groupBy(year_col, label.alias("Agency"))
           .agg(exact_sum("budget_authority").alias("budget_authority"),
                exact_sum("unobligated").alias("unobligated"),
                F.sum("accounts").alias("accounts"), F.min("rank").alias("rank")))
    return out.withColumn("pct_unobligated", round_n(pct_unguarded(F.col("unobligated"), F.col("budget_authority")), 1))


def bubble_scale(df: DataFrame, lo: float = 5.0, hi: float = 40.0, ba: str = "budget_authority",
                 pct: str = "pct_unobligated", group: list[str] | None = None) -> DataFrame:
    """positive-budget points; radius = lo + (hi-lo) * sqrt(ba / max ba);
    x position = pct on a 0-100 axis. The max is a one-row (per group) aggregate."""
    pos = df.where(F.col(ba) > 0)
    group = group or []
    if group:
        joined = pos.join(pos.groupBy(*group).agg(F.max(ba).alias("_max")), group)
    else:
        joined = pos.withColumn("_max", pos.select(F.max(ba)).scalar())
    return (joined.withColumn("radius", F.lit(lo) + F.lit(hi - lo) * F.sqrt(F.col(ba) / F.col("_max")))
            .withColumn("x", F.col(pct) / F.lit(100.0)).drop("_max"))


# ------------------------------------------------------------------ sorts / paging

def sort_budget_desc(df: DataFrame, col: str = BA, ties=("TAFS",)) -> DataFrame:
    """Budget authority descending (ties broken for a total order)."""
    return df.orderBy(F.col(col).desc_nulls_last(), *[F.col(t).asc_nulls_last() for t in ties])


def sort_expiration(df: DataFrame) -> DataFrame:
    """Expiration year ascending as text ('No Year' after the digits)."""
    return df.orderBy(F.col("Expiration_Year").asc_nulls_last())


def page(df: DataFrame, order: list[Column], offset: int, n: int | None) -> DataFrame:
    """One page of an ordered table; n=None shows all."""
    out = df.orderBy(*order)
    if offset:
        out = out.offset(offset)
    return out if n is None else out.limit(n)


def top_k(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    """First k rows by an ordering (TakeOrderedAndProject: per-task top-k, no full sort)."""
    return df.orderBy(*order).limit(k)


def expiry_flags(df: DataFrame, year: int) -> DataFrame:
    """Row flag expiring-in-year / no-year / other for a display year."""
    e = F.col("Expiration_Year")
    return df.withColumn("row_flag", F.when(e == str(year), F.lit("expiring"))
                         .when(e == "No Year", F.lit("no_year")).otherwise(F.lit("other")))
