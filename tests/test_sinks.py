"""Summary files: RFC 4180 quoting, blanks, short rows, the month loading rule, publishing."""

import pytest

from obligato.operators import quality as Q
from obligato.sources import sinks as K

DISPLAY = {"Unobligated Balance (Line 2490)": "$1,234.5M", "Budget Authority (Line 2500)": "$-2.0M", "Percentage Unobligated": "12.3%"}


def summary(spark, rows):
    """(year, month, agency, account) rows as display summaries."""
    cols = ["Month", "Fiscal_Year", *K.YEAR_CSV_COLUMNS]
    data = []
    for year, month, agency, account in rows:
        v = {"Month": month, "Fiscal_Year": year, "Agency": agency, "Account": account} | DISPLAY
        data.append(tuple(v.get(c, "") for c in cols))
    return spark.createDataFrame(data, ", ".join(f"`{c}` {'int' if c == 'Fiscal_Year' else 'string'}" for c in cols))


AWKWARD = ['Say "hi", Office', "plain", "", " padded ", 'ends with "', '"', "a,b", "back\\slash", "\\", "'single'", "tab\there"]


def test_year_summaries_come_back_as_written(spark, tmp_path):
    df = summary(spark, [(2020 + i % 2, "Sep", f"A{i}", text) for i, text in enumerate(AWKWARD)])
    path = K.write_year_summary(df, str(tmp_path / "y"))
    back = K.scan_summary_csv(spark, path)
    key = [*K.YEAR_CSV_COLUMNS, "Fiscal_Year"]
    assert sorted(map(tuple, back.select(*key).collect())) == sorted(map(tuple, df.select(*key).collect()))
    text = "".join(f.read_text() for f in (tmp_path / "y").rglob("*.csv"))
    assert '"Say ""hi"", Office"' in text and "\\\"" not in text
    typed = K.parse_summary(back).first()
    assert (typed.Unobligated_Balance_M, typed.Budget_Authority_M, typed.Percentage_Unobligated) == (1234.5, -2.0, 12.3)


def test_monthly_summaries_come_back_as_written(spark, tmp_path):
    df = summary(spark, [(2020, m, "A", text) for m in ("Oct", "Nov") for text in AWKWARD])
    path = K.write_monthly_summary(df, str(tmp_path / "m"))
    back = K.scan_summary_csv(spark, path, K.MONTH_CSV_COLUMNS, "fy int, m string")
    assert back.where("Month <> m").count() == 0
    cols = [c for c in K.MONTH_CSV_COLUMNS if c != "Fiscal_Year"]
    assert sorted(map(tuple, back.select(*cols).collect())) == sorted(map(tuple, df.select(*cols).collect()))


def test_only_rows_with_another_number_of_fields_are_dropped(spark, tmp_path):
    folder = tmp_path / "s" / "Fiscal_Year=2021"
    folder.mkdir(parents=True)
    n = len(K.YEAR_CSV_COLUMNS)
    lines = [",".join(f'"{c}"' for c in K.YEAR_CSV_COLUMNS), ",".join(["kept", '"x, ""y"""', *[""] * (n - 2)]),
             ",".join(["short"] * (n - 1)), ",".join(["long"] * (n + 1)), ",".join([""] * n)]
    (folder / "part.csv").write_text("\n".join(lines) + "\n")
    back = K.scan_summary_csv(spark, str(tmp_path / "s"))
    assert sorted((r.Agency, r.Bureau, r.TAFS) for r in back.collect()) == [("", "", ""), ("kept", 'x, "y"', "")]
    assert back.select("Agency").count() == 2


def test_month_loading_rule(spark):
    yearly = summary(spark, [(2020, "Sep", "y20", "a"), (2021, "Jun", "y21", "a"), (2021, "Jun", "y21", "near zero")])
    monthly = summary(spark, [(2020, "Sep", "m20", "a"), (2020, "Jun", "m20", "b"), (2021, "Jun", "m21", "c")])

    def loaded(*args):
        return sorted((r.Fiscal_Year, r.Agency, r.Account) for r in K.load_year_month(yearly, monthly, *args).collect())

    assert loaded() == [(2020, "y20", "a"), (2021, "y21", "a"), (2021, "y21", "near zero")]
    assert loaded("Jun") == [(2020, "m20", "b"), (2021, "m21", "c")]
    assert loaded("Sep") == [(2020, "m20", "a")]
    assert loaded("Sep", "latest") == [(2020, "m20", "a"), (2021, "y21", "a"), (2021, "y21", "near zero")]
    with pytest.raises(ValueError, match="fallback"):
        K.load_year_month(yearly, monthly, "Sep", "other")


def test_publish_replaces_whole_partitions(spark, tmp_path):
    approved = spark.createDataFrame([(2020,)], "fiscal_year int")
    path = str(tmp_path / "p")
    Q.publish(summary(spark, [(2020, "Sep", "old", "a"), (2020, "Sep", "old", "b"), (2020, "Oct", "keep", "c"), (2021, "Sep", "no", "d")]), approved, path)
    catalogue = Q.publish(summary(spark, [(2020, "Sep", "new", "a")]), approved, path)
    assert sorted(map(tuple, catalogue.collect())) == [(2020, "Oct", 1), (2020, "Sep", 1)]
    out = Q.outputs_present(spark.createDataFrame([(2020,), (2022,)], "fiscal_year int"), catalogue)
    assert sorted(map(tuple, out.collect())) == [(2020, 2, True), (2022, 0, False)]
