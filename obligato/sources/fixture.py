"""Ledger-shaped views over the driver's TPC-H-style tables.

One raw ledger row per ``lineitem`` row::

    lineitem ⋈ orders ⋈ supplier ⋈ nation ⋈ region ⋈ part

fiscal year = ship year (+1 for Oct-Dec) + 20, agency = region name,
bureau = supplier nation, account = part brand, report line from the return
flag, amount = extended price. ``nation`` and ``region`` are the fixed
25- and 5-row TPC-H dimensions, so they are the only sides broadcast by
hint; every other join is left to Catalyst/AQE size statistics.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import month_abbr

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


#: A hash of some group keys of E1 by which raw rows have been dealt to tasks.
DEAL = "_deal"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fiscal_year(date: str = "l_shipdate") -> Column:
    """Fiscal year of a line item: ship year (+1 for Oct-Dec) + 20."""
    return (F.year(date) + F.when(F.month(date) >= 10, 1).otherwise(0) + 20).cast("int")


def fiscal_year_rows(spark: SparkSession, sf_dir: str) -> dict[int | None, int]:
    """Line items per fiscal year of the raw ledger, those without a date under None."""
    li = table(spark, sf_dir, "lineitem").groupBy(fiscal_year().alias("fiscal_year")).count()
    return {r["fiscal_year"]: r["count"] for r in li.collect()}


def ledger_rows(spark: SparkSession, sf_dir: str, year: int | None = None, by_part: bool | int = False) -> DataFrame:
    """Raw long-form ledger: one row per line item, of all fiscal years or of ``year``.

    An account is a part brand, so the master's size is bounded; ``by_part`` makes it a part, and the master
    then grows with the tables. A number instead of True deals the rows to so many tasks before their texts are made, by column ``DEAL``,
    which follows from group keys of E1 (year, account, line).

    Columns: fiscal_year, month, AGENCY, AGENCY_TITLE, BUREAU (NULL on seventh lines), BUREAU_TITLE, OMB_ACCT,
    OMB_ACCOUNT, TAFS, LINENO, LINE_DESC (NULL on some), TRAG, TRACCT (optional keys), FY1, FY2,
    ALLOC (given codes, for the match-rate check), amount decimal(18,2),
    Source_File, ordinal (long giving file order).
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice",
        "l_returnflag", "l_shipdate")
    if year is not None:    # a filter on the scanned column prunes row groups
        first = f"{year - 21}-10-01"
        li = li.where((F.col("l_shipdate") >= F.lit(first).cast("timestamp"))
                      & (F.col("l_shipdate") < F.lit(f"{year - 20}-10-01").cast("timestamp")))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.substring("o_orderpriority", 1, 1).alias("prio"))
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = F.broadcast(table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey"))
    region = F.broadcast(table(spark, sf_dir, "region").select("r_regionkey", "r_name"))
    brand = F.concat("p_brand", "p_partkey") if by_part else F.col("p_brand")
    part = table(spark, sf_dir, "part").select("p_partkey", brand.alias("p_brand"), "p_size")

    # the names of nations and regions come last, so that no shuffle carries them
    df = (li.join(orders, li.l_orderkey == orders.o_orderkey)
          .join(supplier, li.l_suppkey == supplier.s_suppkey)
          .join(part, li.l_partkey == part.p_partkey))

    fy = fiscal_year()
    lineno = (F.when(F.col("l_returnflag") == "N", F.lit("2490"))
              .when(F.col("l_returnflag") == "R", F.lit("2500"))
              .when(F.col("l_linenumber") == 1, F.lit("1000"))
              .when(F.col("l_linenumber") == 2, F.lit("0999"))
              .when(F.col("l_linenumber") == 3, F.lit(None).cast("string"))
              .otherwise(F.lit("n/a")))
    dealt = [DEAL] if by_part and by_part is not True else []
    if dealt:    # the account's text ends with the brand, after a code of fixed length
        df = df.withColumn(DEAL, F.hash(fy, "p_brand", lineno)).repartition(by_part, DEAL)
    df = (df.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
          .join(region, F.col("n_regionkey") == F.col("r_regionkey")))

    yy = F.lpad((fy % 100).cast("string"), 2, "0")
    yy1 = F.lpad(((fy - 1) % 100).cast("string"), 2, "0")
    agency_code = F.lpad((F.col("r_regionkey") + 10).cast("string"), 3, "0")
    nation_code = F.lpad(F.col("n_nationkey").cast("string"), 2, "0")
    even = (F.col("p_size") % 2) == 0
    account = F.concat(agency_code,
                       F.when(even, F.concat(F.lit("-"), nation_code)).otherwise(F.lit("")),
                       F.lit("-"), F.lpad(F.substring_index("p_brand", "#", -1), 4, "0"))
    prio = F.col("prio")
    period = (F.when(prio == "1", F.lit(" /X"))
              .when(prio == "2", F.concat(F.lit(" /"), yy))
              .when(prio == "3", F.concat(F.lit(" "), yy1, F.lit("/"), yy))
              .when(prio == "4", F.concat(F.lit(" "), yy, F.lit("/X")))
              .otherwise(F.lit("")))
    # Given codes as a ledger would carry them: '.0' suffixes and unpadded
    # numbers on some rows; one file carries a wrong FY2 (rejected by the check).
    fy1 = (F.when(prio == "3", yy1).when(prio == "4", yy))
    fy1 = F.when((F.col("l_linenumber") % 2 == 0) & fy1.isNotNull(), F.concat(fy1, F.lit(".0"))).otherwise(fy1)
    fy2 = (F.when(prio.isin("1", "4"), F.lit("X")).when(prio.isin("2", "3"), yy))
    bad = (F.col("r_regionkey") == 4) & (fy == 2016) & (F.col("p_size") == 50)
    fy2 = F.when(bad & fy2.isNotNull(), F.lit("00")).otherwise(fy2)
    alloc = F.when(even, F.col("n_nationkey").cast("string")).otherwise(agency_code)

    return df.select(
        fy.alias("fiscal_year"),
        month_abbr("l_shipdate").alias("month"),
        F.when(F.col("l_linenumber") != 1, F.col("r_name")).alias("AGENCY"),
        F.col("r_name").alias("AGENCY_TITLE"),
        F.when(F.col("l_linenumber") != 7, F.col("n_name")).alias("BUREAU"),
        F.concat(F.lit("Bureau of "), F.col("n_name")).alias("BUREAU_TITLE"),
        F.concat(agency_code, F.lit("-"), F.col("p_brand")).alias("OMB_ACCT"),
        F.concat(agency_code, F.lit("-"), nation_code, F.lit("   "), F.col("p_brand"), F.lit(" Commission")).alias("OMB_ACCOUNT"),
        F.when(F.col("l_linenumber") > 2, F.concat(F.lit("Line "), lineno)).alias("LINE_DESC"),
        F.when(F.col("p_size") == 1, F.lit("1")).otherwise(F.lit("0")).alias("TRAG"),
        F.lit("0").alias("TRACCT"),
        F.concat(account, period, F.lit(" - "), F.col("p_brand")).alias("TAFS"),
        lineno.alias("LINENO"),
        fy1.alias("FY1"), fy2.alias("FY2"), alloc.alias("ALLOC"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("amount"),
        F.concat(F.col("r_name"), F.lit("_"), fy.cast("string")).alias("Source_File"),
        # file order: row position key (a sheet row number in a real ledger)
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("ordinal"),
        *dealt,
    )


def unit_notes(ledger: DataFrame) -> DataFrame:
    """Detail-sheet caption rows per file (Source_File, row, text).

    Derived from the ledger's own file list: files of agencies whose name
    sorts into the first half are reported in thousands. Row 6 mentions
    'thousand' too but lies beyond the five rows that decide the unit.
    """
    files = ledger.select("Source_File", "AGENCY_TITLE").distinct()
    thousands = F.col("AGENCY_TITLE") < F.lit("B")
    rows = F.array(
        F.struct(F.lit(1).alias("row"), F.lit("Report on Budget Execution and Budgetary Resources").alias("text")),
        F.struct(F.lit(2).alias("row"), F.concat(F.lit("Agency: "), F.col("AGENCY_TITLE")).alias("text")),
        F.struct(F.lit(3).alias("row"),
                 F.when(thousands, F.lit("(Amounts in Thousands)")).otherwise(F.lit("(Amounts in Dollars)")).alias("text")),
        F.struct(F.lit(6).alias("row"), F.lit("see thousand-dollar rounding note").alias("text")),
    )
    return files.select("Source_File", F.inline(rows))


def statement_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statement text per order (doc_id, text): account metadata, then line 2490 of its open and 2500 of its other
    line items, each with the four quarters' amounts, as extracted statement pages read."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_returnflag", "l_shipdate")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    code = F.when(F.col("l_returnflag") == "N", F.lit("2490")).otherwise(F.lit("2500"))
    price, quarter = F.col("l_extendedprice").cast("decimal(18,2)"), F.quarter("l_shipdate")
    texts = {"2490": "Unobligated balance, end of year", "2500": "Budgetary resources total"}
    # one aggregate per order; an order without line items of a code has no line of it
    orders = li.where("l_orderkey IS NOT NULL").groupBy("l_orderkey").agg(
        F.min("l_suppkey").alias("l_suppkey"), *[F.count_if(code == c).alias(f"n{c}") for c in texts],
        *[F.coalesce(F.sum(F.when((code == c) & (quarter == q), price)), F.lit(0)).cast("double").alias(f"q{c}_{q}") for c in texts for q in (1, 2, 3, 4)])
    line = {c: F.when(F.col(f"n{c}") > 0, F.concat_ws(" ", F.lit(c), F.lit(t), *[F.format_number(f"q{c}_{q}", 2) for q in (1, 2, 3, 4)])) for c, t in texts.items()}
    orders = orders.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    key = F.col("l_orderkey").cast("string")
    head = F.concat(F.lit("BudgetAgency: Legislative"), F.when(F.col("s_nationkey") % 2 == 0, F.lit("Branch")).otherwise(F.lit("")),
                    F.lit("\nBudgetBureau:  Bureau "), F.col("s_nationkey").cast("string"), F.lit("\nBudgetAccount: Account "), key,
                    F.lit("\nbudgetaccountid: 01-"), F.lpad(F.col("s_nationkey").cast("string"), 2, "0"), F.lit("-"), key, F.lit("\npage one of one\n"))
    return orders.select(F.col("l_orderkey").alias("doc_id"), F.concat(head, F.concat_ws("\n", *line.values())).alias("text"))
