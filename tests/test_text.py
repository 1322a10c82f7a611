"""Unit tables for the account-symbol grammars.

Expected values follow the published examples (see FIXTURES.md §A9).
"""

from pyspark.sql import functions as F

from obligato.functions import text as T

SYMBOLS = [
    # tafs, account number, period, expiration, (fy1, fy2), alloc
    ("018-45-0243 /25 - Federal Direct Student Loan Program Account", "018-45-0243", "FY2025", "2025", ("", "25"), "45"),
    ("95-2300 24/25 - Salaries and Expenses", "95-2300", "FY2024-FY2025", "2025", ("24", "25"), "95"),
    ("17-1804 /20 - Operation and Maintenance, Navy", "17-1804", "FY2020", "2020", ("", "20"), "17"),
    ("12-2500 /X", "12-2500", "No Year", "No Year", ("", "X"), "12"),
    ("14-91-0400 16/21", "14-91-0400", "FY2016-FY2021", "2021", ("16", "21"), "91"),
    ("48-1550", "48-1550", "", "", ("", ""), "48"),
    ("", "", "", "", ("", ""), ""),
    (None, "", "", "", ("", ""), ""),
    ("72-1037 22/X - Development Assistance", "72-1037", "FY2022-No Year", "No Year", ("22", "X"), "72"),
]


def _df(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_components_bounds_alloc(spark):
    df = _df(spark, [(s[0],) for s in SYMBOLS], "tafs string").withColumn("Agency", F.lit("Department of State"))
    out = (T.with_components(df, "tafs", "Agency")
           .select("tafs", "Account_Number", "Period_of_Performance", "Expiration_Year",
                   T.tafs_fy_bounds(F.col("tafs")).alias("b"), T.tafs_alloc(F.col("tafs")).alias("alloc"))
           .collect())
    got = {r.tafs: (r.Account_Number, r.Period_of_Performance, r.Expiration_Year, (r.b.fy1, r.b.fy2), r.alloc)
           for r in out}
    for tafs, acct, per, exp, bounds, alloc in SYMBOLS:
        assert got[tafs] == (acct, per, exp, bounds, alloc), tafs


def test_oia_grammar(spark):
    rows = [("48-5721 /25 - 400 Years of African-American History Commission",),
            ("95-2300 24/25 - Salaries and Expenses",), ("95-2300 24/X - Salaries",), ("12-2500 /X",)]
    df = _df(spark, rows, "tafs string").withColumn("Agency", F.lit("Other Independent Agencies"))
    got = {r.tafs: (r.Account_Number, r.Period_of_Performance, r.Expiration_Year)
           for r in T.with_components(df, "tafs", "Agency").collect()}
    assert got["48-5721 /25 - 400 Years of African-American History Commission"] == ("48-5721", "FY2025", "2025")
    assert got["95-2300 24/25 - Salaries and Expenses"] == ("95-2300", "FY2024-FY2025", "2025")
    assert got["95-2300 24/X - Salaries"] == ("95-2300", "", "")       # a/X is not read in this grammar
    assert got["12-2500 /X"] == ("12-2500", "No Year", "No Year")


def test_normalize_code(spark):
    cases = [("12.0", "12"), ("6", "06"), ("06", "06"), ("0", "00"), ("123", "123"), ("x", "X"), ("X", "X"),
             (None, ""), ("nan", ""), (" 7 ", "07"), ("12.5", "12.5"), ("", "")]
    df = _df(spark, cases, "v string, want string")
    for r in T.with_normalized(df, {"n": "v"}).collect():
        assert r.n == r.want, r.v
    for r in df.select("want", T.normalize_code(F.col("v")).alias("n")).collect():
        assert r.n == r.want


def test_clean_text(spark):
    cases = [("A_x000D_\nB", "AB"), ("a\r\nb  c", "a b c"), ("  x\t y ", "x y"), (None, None)]
    df = _df(spark, cases, "v string, want string")
    for r in df.select("want", T.clean_text(F.col("v")).alias("c")).collect():
        assert r.c == r.want


def test_canonical_agency(spark):
    cases = [("DEPARTMENT OF AGRICULTURE", "Department of Agriculture"),
             ("Department of Defense--Military Programs", "Department of Defense-Military"),
             ("Corps of Engineers, Civil Works", "Corps of Engineers-Civil Works"),
             ("Other Defense Programs - Civil", "Other Defense Civil Programs"),
             ("  Tennessee Valley Authority ", "Tennessee Valley Authority"),
             (None, "Unknown Agency")]
    df = _df(spark, cases, "v string, want string")
    for r in T.with_canonical_agency(df, "v", "a").collect():
        assert r.a == r.want, r.v


def test_fund_type(spark):
    cases = [("12-2500 /X - A", "no_year"), ("17-1804 /20 - B", "current_year"), ("95-2300 21/25 - C", "current_year"),
             ("14-0400 /2025 - D", "multi_year"), ("48-1550 - E", "other"), ("a/b/c", "other")]
    df = _df(spark, cases, "v string, want string")
    for r in df.select("want", T.fund_type(F.col("v")).alias("f")).collect():
        assert r.f == r.want


def test_rename_months_coalesces_quarter_end(spark):
    from obligato.operators.ingest import rename_months
    df = spark.createDataFrame([(1.0, None, 3.0, 4.0), (None, 2.0, 5.0, None)],
                               "AMT_OCT double, AMT_DEC double, AMT1 double, AMT4 double")
    out = rename_months(df)
    assert set(out.columns) == {"Oct", "Dec", "Sep"}
    rows = sorted(out.collect(), key=lambda r: r.Dec)
    assert [(r.Oct, r.Dec, r.Sep) for r in rows] == [(None, 2.0, None), (1.0, 3.0, 4.0)]
