"""Month detection operators over the wide master (E5a-c, E6, E7, F1, A6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import fiscal_month_ord, fiscal_quarter
from ..functions.constants import FISCAL_MONTHS, QUARTER_END


def _long(master: DataFrame, months=FISCAL_MONTHS) -> DataFrame:
    present = [m for m in months if m in master.columns]
    return master.select("fiscal_year", *present).unpivot(["fiscal_year"], present, "month", "value")


def months_with_data(master: DataFrame, mode: str = "any", months=FISCAL_MONTHS) -> DataFrame:
    """E5: (fiscal_year, month, month_ord, has_data) per present month column.

    mode 'any'    (E5a) any non-null value and any value != 0 (NULL counts as != 0)
    mode 'strict' (E5b) count of non-null, non-zero values > 0 (also returned)
    mode 'total'  (E5c) |sum of values| > 1000
    Partial aggregation runs before the shuffle, so the output is years x 12.
    """
    lg = _long(master, months)
    v = F.col("value")
    agg = lg.groupBy("fiscal_year", "month").agg(
        F.max(v.isNotNull()).alias("_nn"),
        F.max(F.coalesce(v != 0, F.lit(True))).alias("_nz"),
        F.count_if(v.isNotNull() & (v != 0)).alias("nonzero_count"),
        F.sum(v).alias("_total"),
    )
    if mode == "any":
        has = F.col("_nn") & F.col("_nz")
    elif mode == "strict":
        has = F.col("nonzero_count") > 0
    elif mode == "total":
        has = F.coalesce(F.abs(F.col("_total")) > 1000, F.lit(False))
    else:
        raise ValueError(mode)
    return agg.select("fiscal_year", "month", fiscal_month_ord(F.col("month")).alias("month_ord"),
                      has.alias("has_data"), "nonzero_count",
                      F.col("_total").cast("double").alias("total"))


def available_months(master: DataFrame, mode: str = "any") -> DataFrame:
    """Months with data per year: (fiscal_year, month, month_ord)."""
    return (months_with_data(master, mode).where("has_data")
            .select("fiscal_year", "month", "month_ord"))


def latest_month(master: DataFrame, mode: str = "any", order=FISCAL_MONTHS) -> DataFrame:
    """Last month with data per fiscal year in the given month order."""
    rank = F.array_position(F.array(*[F.lit(m) for m in order]), F.col("month"))
    return (available_months(master, mode)
            .groupBy("fiscal_year")
            .agg(F.max_by("month", rank).alias("month"))
            .withColumn("month_ord", fiscal_month_ord(F.col("month"))))


def quarter_totals(master: DataFrame) -> DataFrame:
    """Total and has-data per fiscal quarter, read from the quarter-end month."""
    ends = {v: k for k, v in QUARTER_END.items()}
    lg = _long(master, list(ends))
    return (lg.groupBy("fiscal_year", "month")
            .agg(F.sum("value").cast("double").alias("total"))
            .select("fiscal_year",
                    F.concat(F.lit("Q"), fiscal_quarter(F.col("month")).cast("string")).alias("quarter"),
                    "month", F.coalesce("total", F.lit(0.0)).alias("total"),
                    (F.abs(F.coalesce("total", F.lit(0.0))) > 0).alias("has_data")))


def most_recent_month(summary: DataFrame, year_col: str = "Fiscal_Year", month_col: str = "Month") -> DataFrame:
    """keep rows of the latest month present in each fiscal year.

    The per-year maximum is a tiny aggregate joined back (no window over a
    whole year's rows in one task).
    """
    ord_c = fiscal_month_ord(F.col(month_col))
    latest = (summary.groupBy(year_col).agg(F.max(ord_c).alias("_ord")))
    return (summary.join(F.broadcast(latest), year_col)
            .where(ord_c == F.col("_ord")).drop("_ord"))


def list_periods(available: DataFrame, year_col: str = "fiscal_year") -> DataFrame:
    """Catalogue of (year, month) in fiscal order, latest flag per year, from the table of months with data
    (at most twelve rows a year), so no summary needs to be built or read for it."""
    return (available.select(F.col(year_col).alias("Fiscal_Year"), F.col("month").alias("Month"), "month_ord")
            .withColumn("is_latest", F.col("month_ord") == F.max("month_ord").over(Window.partitionBy("Fiscal_Year")))
            .orderBy("Fiscal_Year", "month_ord"))
