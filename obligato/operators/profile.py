"""Year profiles, coverage and overlap.

All profiles are single ``groupBy`` passes (partial aggregation first);
set comparisons run on distinct keys via anti/semi/outer joins; the only
broadcasts are per-year or per-agency tables whose size is bounded by the
number of years / agencies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import fiscal_month_ord
from ..functions.constants import COVERAGE_THRESHOLD_PCT, FISCAL_MONTHS, QUARTER_END
from ..functions.money import round_n
from ..functions.text import fund_type, to_number


def line_no(c: str = "LINENO"):
    return to_number(F.col(c))


def year_profile(master: DataFrame) -> DataFrame:
    """Per year rows, distinct agencies / bureaus / symbols, months with data
    (strict count), latest month, line 2490/2500 counts and distinct lines."""
    lg = master.select("fiscal_year", *FISCAL_MONTHS).unpivot(["fiscal_year"], FISCAL_MONTHS, "month", "v")
    months = (lg.groupBy("fiscal_year", "month").agg(F.count_if(F.col("v").isNotNull() & (F.col("v") != 0)).alias("nz"))
              .where("nz > 0").withColumn("ord", fiscal_month_ord(F.col("month")))
              .groupBy("fiscal_year").agg(F.count(F.lit(1)).alias("months_with_data"),
                                          F.max_by("month", "ord").alias("latest_month")))
    base = master.groupBy("fiscal_year").agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_distinct("AGENCY_TITLE").alias("unique_agencies"),
        F.count_distinct("BUREAU").alias("unique_bureaus"),
        F.count_distinct("TAFS").alias("unique_tafs"),
        F.count_if(line_no() == 2490).alias("line_2490"),
        F.count_if(line_no() == 2500).alias("line_2500"),
        F.count_distinct(line_no()).alias("unique_lines"))
    funds = (master.select("fiscal_year", "TAFS").where(F.col("TAFS").isNotNull()).distinct()
             .groupBy("fiscal_year").agg(*[F.count_if(fund_type(F.col("TAFS")) == k).alias(f"{k}_funds")
                                           for k in ("current_year", "multi_year", "no_year")]))
    return base.join(months, "fiscal_year", "left").join(funds, "fiscal_year", "left")


def line_counts(master: DataFrame, n: int = 5) -> DataFrame:
    """Rows per line number in ascending line order, first n per year."""
    c = master.withColumn("line_no", line_no()).where(F.col("line_no").isNotNull()).groupBy(
        "fiscal_year", "line_no").agg(F.count(F.lit(1)).alias("records"))
    w = Window.partitionBy("fiscal_year").orderBy("line_no")      # per-year table of distinct lines
    return c.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def distinct_accounts(df: DataFrame, agency: str = "Agency", tafs: str = "TAFS",
                      year: str = "fiscal_year") -> DataFrame:
    """Distinct symbols per agency and in total (rollup gives both in one pass)."""
    return (df.where(F.col(tafs).isNotNull()).rollup(year, agency)
            .agg(F.count_distinct(tafs).alias("accounts"), F.grouping_id().alias("gid"))
            .where(F.col(year).isNotNull()))


def coverage_vs_baseline(master: DataFrame, baseline_year: int, threshold: float = COVERAGE_THRESHOLD_PCT) -> DataFrame:
    """Per year and baseline agency, accounts vs the baseline year's
    accounts (absent -> 0); agencies only present in the year are ignored;
    an overall row per year. The table of (year, agency) counts is pivoted to one row per agency with a
    map of years, so absent years show without pairing years and agencies."""
    counts = distinct_accounts(master)
    per = counts.groupBy("Agency", "gid").agg(
        F.map_from_entries(F.collect_list(F.struct("fiscal_year", "accounts"))).alias("by_year"))   # one entry per year
    years = F.transform(F.map_keys(F.col("_all")), lambda y: F.struct(
        y.alias("fiscal_year"), F.coalesce(F.try_element_at("by_year", y), F.lit(0)).alias("current_accounts")))
    total = per.where("gid = 1").select(F.col("by_year").alias("_all")).scalar()     # every year has a total
    out = (per.withColumns({"_all": total, "baseline_accounts": F.try_element_at("by_year", F.lit(baseline_year))})
           .where(F.col("baseline_accounts").isNotNull())
           .select("Agency", "gid", "baseline_accounts", F.explode(years).alias("y")).select("Agency", "gid", "baseline_accounts", "y.*"))
    pct = round_n(F.col("current_accounts") * 100.0 / F.col("baseline_accounts"), 2)
    return (out.withColumn("coverage_pct", pct)
            .withColumn("below_threshold", F.col("coverage_pct") < threshold)
            .withColumn("scope", F.when(F.col("gid") == 1, F.lit("overall")).otherwise(F.lit("agency")))
            .drop("gid"))


def account_overlap(master: DataFrame, base_year: int) -> DataFrame:
    """H3: distinct symbols of each year against the base year: overlap,
    only-base, only-current and overlap share of the base. Overlap is an
    equi-join on the symbol; the other counts follow from set sizes."""
    t = master.where(F.col("TAFS").isNotNull()).select("fiscal_year", "TAFS").distinct()
    base = t.where(F.col("fiscal_year") == base_year).select("TAFS")
    n_base = base.select(F.count(F.lit(1))).scalar()
    sizes = t.groupBy("fiscal_year").agg(F.count(F.lit(1)).alias("current_accounts"))
    ov = t.join(base, "TAFS", "left_semi").groupBy("fiscal_year").agg(F.count(F.lit(1)).alias("overlap"))
    j = sizes.join(ov, "fiscal_year", "left").fillna(0, subset=["overlap"])
    return (j.withColumn("base_accounts", n_base)
            .withColumn("only_base", F.col("base_accounts") - F.col("overlap"))
            .withColumn("only_current", F.col("current_accounts") - F.col("overlap"))
            .withColumn("overlap_pct", round_n(F.col("overlap") * 100.0 / F.col("base_accounts"), 2)))


def baseline_profile(summary: DataFrame) -> DataFrame:
    """Per year snapshot: rows, agencies, totals; per-agency sums via rollup."""
    return (summary.rollup("Fiscal_Year", "Agency").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.col("Budget_Authority_M").cast("decimal(38,1)")).cast("double").alias("budget_authority"),
        F.sum(F.col("Unobligated_Balance_M").cast("decimal(38,1)")).cast("double").alias("unobligated"),
        F.count_distinct("Agency").alias("agencies"),
        F.grouping_id().alias("gid"))
        .where(F.col("Fiscal_Year").isNotNull()))


def snapshot_lines(master: DataFrame, unobligated: float = 2490, authority: float = 2500) -> DataFrame:
    """E23, the master's side of the snapshot: per year rows, agencies, distinct report lines and rows of both paired lines.

    The distinct counts run over one row per year, agency and line."""
    small = master.groupBy("fiscal_year", "Agency", "LINENO").agg(F.count(F.lit(1)).alias("n"))
    line = to_number(F.col("LINENO"))
    rows_of = lambda code: F.sum(F.when(line == code, F.col("n")).otherwise(0))
    return small.groupBy("fiscal_year").agg(
        F.sum("n").alias("rows"), F.count_distinct("Agency").alias("agencies"), F.count_distinct("LINENO").alias("distinct_lines"),
        rows_of(unobligated).alias("rows_2490"), rows_of(authority).alias("rows_2500"))


def file_agency_counts(master: DataFrame) -> DataFrame:
    """Master rows and files per agency and year."""
    return master.groupBy("fiscal_year", "Agency").agg(F.count(F.lit(1)).alias("rows"),
                                                       F.count_distinct("Source_File").alias("files"))


def drop_report(master: DataFrame, summary: DataFrame) -> DataFrame:
    """Line-2490 master rows vs summary rows per year (pairs lost or added)."""
    a = master.where(line_no() == 2490).groupBy("fiscal_year").agg(F.count(F.lit(1)).alias("line_2490_rows"))
    b = summary.groupBy(F.col("Fiscal_Year").alias("fiscal_year")).agg(F.count(F.lit(1)).alias("summary_rows"))
    return (a.join(b, "fiscal_year", "full")
            .fillna(0, subset=["line_2490_rows", "summary_rows"])
            .withColumn("dropped", F.col("line_2490_rows") - F.col("summary_rows")))


def agency_month_coverage(ledger: DataFrame, expected=FISCAL_MONTHS) -> DataFrame:
    """Per (year, agency) the expected months not seen, in fiscal order."""
    seen = ledger.groupBy("fiscal_year", "AGENCY_TITLE").agg(F.collect_set("month").alias("_seen"))
    exp = F.array(*[F.lit(m) for m in expected])
    return seen.select("fiscal_year", "AGENCY_TITLE",
                       F.array_join(F.array_except(exp, F.col("_seen")), ",").alias("missing_months"),
                       F.size(F.array_except(exp, F.col("_seen"))).alias("missing_count"))


def year_profile_document(master: DataFrame, as_of_year: int, baseline_year: int, threshold: float = COVERAGE_THRESHOLD_PCT) -> DataFrame:
    """One nested document per year: months present and missing, quarters, counts, the validation flag and the
    account coverage against the baseline year with every baseline agency."""
    from .months import months_with_data, quarter_totals
    m = months_with_data(master, "total")
    months = m.groupBy("fiscal_year").agg(
        F.array_sort(F.collect_list(F.when(F.col("has_data"), F.struct("month_ord", "month")))).alias("_av"),
        F.array_sort(F.collect_list(F.when(~F.col("has_data"), F.struct("month_ord", "month")))).alias("_mi"))
    q = quarter_totals(master).groupBy("fiscal_year").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("quarter", F.struct("total", "has_data"))))).alias("quarter_data"),
        F.bool_or("has_data").alias("validation_passed"))
    base = master.groupBy("fiscal_year").agg(F.count(F.lit(1)).alias("total_rows"),
                                             F.count_distinct("Agency").alias("total_agencies"))
    cover = coverage_vs_baseline(master, baseline_year, threshold)
    agency = F.col("scope") == "agency"
    accounts = F.struct("baseline_accounts", "current_accounts", F.col("coverage_pct").alias("coverage_percent"))
    tafs = cover.groupBy("fiscal_year").agg(F.struct(
        F.bool_or("below_threshold").alias("has_coverage_issues"),
        F.max(F.when(~agency, F.col("coverage_pct"))).alias("overall_coverage_percent"),
        F.max(F.when(~agency, F.col("baseline_accounts"))).alias("baseline_total_accounts"),
        F.max(F.when(~agency, F.col("current_accounts"))).alias("current_total_accounts"),
        F.map_from_entries(F.array_sort(F.collect_list(F.when(agency, F.struct("Agency", accounts))))).alias("agency_coverage"),
        F.array_sort(F.collect_list(F.when(agency & F.col("below_threshold"), F.col("Agency")))).alias("agencies_below_threshold"),
        F.lit(float(threshold)).alias("threshold_percent")).alias("tafs_coverage"))
    j = base.join(months, "fiscal_year", "left").join(q, "fiscal_year", "left").join(tafs, "fiscal_year", "left")
    quarters = F.create_map(*[x for k in QUARTER_END for x in (F.lit(k), F.array(*[F.lit(v) for v in _quarter_months(k)]))])
    return j.select(F.col("fiscal_year"), (F.col("fiscal_year") >= as_of_year).alias("is_current_year"),
                    F.transform("_av", lambda s: s["month"]).alias("available_months"),
                    F.transform("_mi", lambda s: s["month"]).alias("missing_months"), quarters.alias("quarter_mapping"),
                    "quarter_data", "total_agencies", "total_rows", "validation_passed", "tafs_coverage")


def _quarter_months(quarter: str) -> list[str]:
    end = FISCAL_MONTHS.index(QUARTER_END[quarter])
    return FISCAL_MONTHS[end - 2:end + 1]


def year_profile_json(master: DataFrame, as_of_year: int, baseline_year: int) -> DataFrame:
    """The year document as one JSON text per year."""
    doc = year_profile_document(master, as_of_year, baseline_year)
    return doc.select("fiscal_year", F.to_json(F.struct(*doc.columns)).alias("profile_json"))
