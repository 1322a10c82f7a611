"""Data-quality suites and publication gate.

Each suite returns rows (one per year, or per year and column) with the
measured value and a pass flag, so the gate is itself a DataFrame:
approved years = intersection of passing years (H2), and publishing keeps
rows of approved years with a left-semi join (A28). Expected member lists
and exceptions are parameters exploded per year — no cross joins.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.constants import INVALID_TOKEN_PATTERN, OIA
from ..functions.money import parse_money, parse_pct


def _years(df: DataFrame, year: str) -> DataFrame:
    return df.select(F.col(year).alias("fiscal_year")).distinct()


def missing_members(df: DataFrame, expected: list[str], year: str = "Fiscal_Year",
                    member: str = "Agency") -> DataFrame:
    """(fiscal_year, member) expected but absent in that year."""
    exp = _years(df, year).select("fiscal_year", F.explode(F.array(*[F.lit(e) for e in expected])).alias("member"))
    present = df.select(F.col(year).alias("fiscal_year"), F.col(member).alias("member")).distinct()
    return exp.join(present, ["fiscal_year", "member"], "left_anti")


def unexpected_members(df: DataFrame, expected: list[str], year: str = "Fiscal_Year",
                       member: str = "Agency") -> DataFrame:
    """H4: (fiscal_year, member) present but not in the expected list."""
    present = df.select(F.col(year).alias("fiscal_year"), F.col(member).alias("member")).distinct()
    return present.where(~F.col("member").isin(expected))


def apply_exceptions(missing: DataFrame, unexpected: DataFrame, exceptions: list[tuple[int, str]]) -> DataFrame:
    """Drop known (year, member) exceptions; excuse the independent-agency
    bucket in years that list at least one unexpected member instead."""
    spark = missing.sparkSession
    if exceptions:
        exc = spark.createDataFrame(exceptions, "fiscal_year int, member string")
        missing = missing.join(exc, ["fiscal_year", "member"], "left_anti")
    has_unexpected = unexpected.select("fiscal_year").distinct()
    oia = missing.where(F.col("member") == OIA).join(has_unexpected, "fiscal_year", "left_semi")
    return missing.join(oia, ["fiscal_year", "member"], "left_anti")


def dq_completeness(summary: DataFrame, expected: list[str], exceptions, current_fy: int,
                    min_rows: int = 1000, warn_rows: int = 8000, warn_rows_early: int = 3000,
                    early=(2013, 2017), year: str = "Fiscal_Year") -> DataFrame:
    """Per year — no missing member after exceptions and >= min_rows rows;
    past years with fewer than warn_rows (warn_rows_early in the early span) warn."""
    miss = apply_exceptions(missing_members(summary, expected, year),
                            unexpected_members(summary, expected, year), exceptions)
    mc = miss.groupBy("fiscal_year").agg(F.count(F.lit(1)).alias("missing_count"),
                                         F.array_join(F.array_sort(F.collect_list("member")), "|").alias("missing"))
    rows = summary.groupBy(F.col(year).alias("fiscal_year")).agg(F.count(F.lit(1)).alias("rows"))
    out = rows.join(mc, "fiscal_year", "left").fillna({"missing_count": 0, "missing": ""})
    warn_at = F.when(F.col("fiscal_year").between(*early), warn_rows_early).otherwise(warn_rows)
    return (out.withColumn("passed", (F.col("missing_count") == 0) & (F.col("rows") >= min_rows))
            .withColumn("warning", (F.col("fiscal_year") < current_fy) & (F.col("rows") < warn_at)))


def missing_columns(df: DataFrame, required: list[str]) -> list[str]:
    """H7: required columns that a table lacks, in the order of the list (a schema check, no job)."""
    return [c for c in required if c not in df.columns]


def dq_structure(summary: DataFrame, required: list[str], min_rows: int = 100, min_agencies: int = 15,
                 year: str = "Fiscal_Year") -> DataFrame:
    """Per year — required columns present (the missing ones by name), >= min_rows rows and
    >= min_agencies agencies; months present per year."""
    missing = missing_columns(summary, required)
    g = summary.groupBy(F.col(year).alias("fiscal_year")).agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("Agency").alias("agencies"),
        F.count_distinct("Month").alias("months"))
    return g.withColumns({"columns_ok": F.lit(not missing), "missing_columns": F.lit(",".join(missing))}).withColumn(
        "passed", F.col("columns_ok") & (F.col("rows") >= min_rows) & (F.col("agencies") >= min_agencies))


def dq_invalid_tokens(summary: DataFrame, year: str = "Fiscal_Year") -> DataFrame:
    """Per year and string column, values matching the invalid display tokens."""
    strings = [f.name for f in summary.schema.fields if f.dataType.simpleString() == "string"]
    g = summary.groupBy(F.col(year).alias("fiscal_year")).agg(
        *[F.count_if(F.col(c).rlike(INVALID_TOKEN_PATTERN)).alias(c) for c in strings],
        F.count(F.lit(1)).alias("_rows"))
    long = g.unpivot(["fiscal_year", "_rows"], strings, "column", "invalid_count")
    return long.withColumn("passed", (F.col("invalid_count") == 0) & (F.col("_rows") > 0)).drop("_rows")


def dq_parseable(summary: DataFrame, year: str = "Fiscal_Year") -> DataFrame:
    """Unparseable money / percentage display values per year."""
    m1, m2, p = "Unobligated Balance (Line 2490)", "Budget Authority (Line 2500)", "Percentage Unobligated"
    bad = lambda c, f: F.count_if(F.col(c).isNotNull() & f(F.col(c)).isNull())
    g = summary.groupBy(F.col(year).alias("fiscal_year")).agg(
        bad(m1, parse_money).alias("bad_unobligated"), bad(m2, parse_money).alias("bad_budget"),
        bad(p, parse_pct).alias("bad_pct"))
    return g.withColumn("passed", (F.col("bad_unobligated") + F.col("bad_budget") + F.col("bad_pct")) == 0)


def dq_required_fields(summary: DataFrame, fields=("Agency", "Bureau", "Account", "Account_Number"),
                       year: str = "Fiscal_Year") -> DataFrame:
    """NULL or '' values per required field and year."""
    g = summary.groupBy(F.col(year).alias("fiscal_year")).agg(
        *[F.count_if(F.coalesce(F.col(c), F.lit("")) == "").alias(c) for c in fields])
    return g.unpivot(["fiscal_year"], list(fields), "field", "empty_count").withColumn(
        "passed", F.col("empty_count") == 0)


def dq_consistency(summary: DataFrame, min_rows: int = 1000, min_agencies: int = 20,
                   year: str = "Fiscal_Year") -> DataFrame:
    """Rows, agencies and money text starting with '$' (all rows checked)."""
    c = "Budget Authority (Line 2500)"
    g = summary.groupBy(F.col(year).alias("fiscal_year")).agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("Agency").alias("agencies"),
        F.count_if(F.col(c).isNotNull() & ~F.col(c).startswith("$")).alias("bad_money_text"))
    return g.withColumn("passed", (F.col("rows") >= min_rows) & (F.col("agencies") >= min_agencies)
                        & (F.col("bad_money_text") == 0))


def dq_reasonable(summary: DataFrame, lo_billions: float = 1000.0, hi_billions: float = 50000.0,
                  year: str = "Fiscal_Year") -> DataFrame:
    """Total budget (billions) within [lo, hi]; count of |pct| > 1000."""
    ba = parse_money(F.col("Budget Authority (Line 2500)"))
    pct = parse_pct(F.col("Percentage Unobligated"))
    g = summary.groupBy(F.col(year).alias("fiscal_year")).agg(
        (F.sum(ba.cast("decimal(38,1)")).cast("double") / F.lit(1000.0)).alias("total_budget_billions"),
        F.count_if((pct < -1000) | (pct > 1000)).alias("extreme_pct"))
    return g.withColumn("passed", F.col("total_budget_billions").between(lo_billions, hi_billions))


def lost_members(summary: DataFrame, max_lost: int = 3, year: str = "Fiscal_Year",
                 member: str = "Agency") -> DataFrame:
    """Members of the first year missing in each later year; > max_lost fails."""
    seen = summary.groupBy(F.col(year).alias("fiscal_year"), F.col(member).alias("member")).agg(F.count(F.lit(1)).alias("rows"))
    first = seen.select(F.min("fiscal_year")).scalar()
    base = seen.where(F.col("fiscal_year") == first).select("member")
    # lost = members of the first year less those of them that the year still has; no (year, member) grid
    still = seen.join(base, "member", "left_semi").groupBy("fiscal_year").agg(F.count(F.lit(1)).alias("kept"))
    years = seen.select("fiscal_year").distinct().where(F.col("fiscal_year") != first)
    total = base.select(F.count(F.lit(1))).scalar()
    return (years.join(still, "fiscal_year", "left").withColumn("lost", total - F.coalesce("kept", F.lit(0))).drop("kept")
            .withColumn("passed", F.col("lost") <= max_lost))


def yoy_change(summary: DataFrame, flag_pct: float = 50.0, year: str = "Fiscal_Year") -> DataFrame:
    """total budget change % between consecutive available years (a window
    over the per-year totals: one row per year)."""
    tot = summary.groupBy(F.col(year).alias("fiscal_year")).agg(
        F.sum(F.col("Budget_Authority_M").cast("decimal(38,1)")).cast("double").alias("total_budget"))
    w = Window.orderBy("fiscal_year")
    prev = F.lag("total_budget").over(w)
    out = tot.withColumn("prev_budget", prev)
    chg = F.when(F.col("prev_budget") > 0,
                 (F.col("total_budget") - F.col("prev_budget")) / F.col("prev_budget") * F.lit(100.0))
    return out.withColumn("change_pct", chg).withColumn(
        "flagged", F.coalesce(F.abs(F.col("change_pct")) > flag_pct, F.lit(False)))


def snapshot_diff(summary: DataFrame, expected: dict[int, int], year: str = "Fiscal_Year") -> DataFrame:
    """Expected rows per year vs current rows; diff and SAME/CHANGED."""
    spark = summary.sparkSession
    exp = spark.createDataFrame(sorted(expected.items()), "fiscal_year int, expected_rows long")
    cur = summary.groupBy(F.col(year).alias("fiscal_year")).agg(F.count(F.lit(1)).alias("current_rows"))
    j = exp.join(cur, "fiscal_year", "left")
    status = (F.when(F.col("current_rows").isNull(), F.lit("ERROR"))
              .when(F.col("current_rows") == F.col("expected_rows"), F.lit("SAME")).otherwise(F.lit("CHANGED")))
    return (j.withColumn("status", status)
            .withColumn("current_rows", F.coalesce("current_rows", F.lit(0)))
            .withColumn("diff", F.col("current_rows") - F.col("expected_rows"))
            .select("fiscal_year", "expected_rows", "current_rows", "diff", "status"))


def passing_years(check: DataFrame) -> DataFrame:
    """Years whose every row of a suite passed."""
    return check.groupBy("fiscal_year").agg(F.bool_and("passed").alias("ok")).where("ok").select("fiscal_year")


def approved_years(*checks: DataFrame) -> DataFrame:
    """H2: years passing every suite (intersection)."""
    return reduce(lambda a, b: a.intersect(b), [passing_years(c) for c in checks])


def publish_approved(df: DataFrame, approved: DataFrame, year: str = "Fiscal_Year") -> DataFrame:
    """Keep rows of approved years (left semi join on the year)."""
    return df.join(approved.select(F.col("fiscal_year").alias(year)), year, "left_semi")


def publish(df: DataFrame, approved: DataFrame, path: str, year: str = "Fiscal_Year", month: str = "Month") -> DataFrame:
    """A28/P8 as a write: the approved years' rows partitioned by year and month, each published partition replaced as a
    whole; returns the catalogue of what was published (year, month, rows), read back from the folder."""
    (publish_approved(df, approved, year).withColumns({"_y": F.col(year), "_m": F.col(month)}).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("_y", "_m").parquet(path))
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    return back.groupBy(F.col(year).alias("fiscal_year"), F.col(month).alias("month")).agg(F.count(F.lit(1)).alias("rows"))


def unapproved(df: DataFrame, approved: DataFrame, year: str = "Fiscal_Year") -> DataFrame:
    """Rows of years that are not approved (left anti)."""
    return df.join(approved.select(F.col("fiscal_year").alias(year)), year, "left_anti")


def outputs_present(approved: DataFrame, catalogue: DataFrame, month: str = "Sep") -> DataFrame:
    """Per approved year the number of published month outputs and whether ``month`` is among them."""
    per = catalogue.groupBy("fiscal_year").agg(F.count(F.lit(1)).alias("outputs"), F.bool_or(F.col("month") == month).alias("has_month"))
    return (approved.join(per, "fiscal_year", "left")
            .select("fiscal_year", F.coalesce("outputs", F.lit(0)).alias("outputs"), F.coalesce("has_month", F.lit(False)).alias("has_month")))
