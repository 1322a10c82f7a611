"""Ledger ingest: file check before NULL keys go, optional keys in the stream, hash aggregate, sample rows."""

import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from obligato.operators import ingest as I
from obligato.plans import pipelines as P
from obligato.session import shared_dir
from obligato.streaming import months as ST

SF = "/root/testdata/sf0.001"
COLUMNS = ("fiscal_year int, month string, AGENCY string, AGENCY_TITLE string, BUREAU string, OMB_ACCT string, TAFS string, LINENO string, "
           "TRAG string, TRACCT string, FY1 string, FY2 string, ALLOC string, amount decimal(18,2), Source_File string, ordinal long")


def row(n, bureau="B", tafs="012-45-0243 /20 - Name", line="2490", trag="0", fy2="20", amount=1, file="f", month="Oct", agency="ASIA"):
    return (2020, month, agency, "ASIA", bureau, "acct", tafs, line, trag, "0", None, fy2, "45", Decimal(str(amount)), file, n)


def groups(spark, rows):
    return I.aggregate_ledger(I.derive_codes(spark.createDataFrame(rows, COLUMNS)))


def test_a_mismatch_on_a_row_with_a_null_key_rejects_the_file(spark):
    g = groups(spark, [row(1, file="bad"), row(2, bureau=None, fy2="99", file="bad"), row(3, file="good")])
    rates = {r.Source_File: r.rejected for r in I.file_check_rates(I.standard_lines(g)).collect()}
    assert rates == {"bad": True, "good": False}
    assert {r.Source_File for r in P.master_from_groups(g).collect()} == {"good"}


def test_first_texts_and_sums(spark):
    rows = [row(5, tafs=None, amount=2), row(3, agency=None, amount=3), row(4, amount="0.25", month="Nov"), row(9, bureau=None)]
    got = [r for r in groups(spark, rows).collect() if r.BUREAU == "B" and r.DERIVED_FY2 == "20"]
    assert [(float(r.Oct), float(r.Nov), r.source_rows, r.AGENCY, r.AGENCY_ord) for r in got] == [(3.0, 0.25, 2, "ASIA", 4)]


def test_raw_rows_are_aggregated_without_a_sort(spark):
    df = I.partial_groups(I.derive_codes(spark.createDataFrame([row(1)], COLUMNS)))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "Sort " not in plan


def test_codes_are_derived_after_the_raw_aggregate(spark):
    """Given codes are checked per group of raw codes; the counts are those of the single rows."""
    rows = [row(n, fy2=["20", "20.0", " 20", "99", None][n % 5], bureau="AB"[n % 2]) for n in range(40)]
    parts = I.partial_groups(spark.createDataFrame(rows, COLUMNS))
    got = {r.BUREAU: (r.source_rows, r.fy2_tested, r.fy2_matched) for r in I.resolve_groups(parts).collect()}
    assert got == {"A": (20, 16, 12), "B": (20, 16, 12)}


def test_mismatch_samples_are_the_first_in_file_order(spark):
    rows = [row(n, fy2="99", file="f") for n in range(200, 0, -1)] + [row(500, file="g")]
    got = I.mismatch_samples(I.derive_codes(spark.createDataFrame(rows, COLUMNS))).collect()
    assert sorted((r.Source_File, r.code, r.ordinal, r["sample"]) for r in got) == [("f", "FY2", i, i) for i in (1, 2, 3)]


def test_streamed_groups_keep_optional_keys_and_compact(spark, tmp_path):
    rows = [row(1, trag="1"), row(2, trag="2"), row(3, trag="1", month="Nov"), row(4, trag="2", month="Nov", agency=None)]
    df = spark.createDataFrame(rows, COLUMNS)
    base = str(tmp_path)
    src = ST.write_month_partitions(df, f"{base}/raw")
    ST.ingest_stream(spark, src, f"{base}/groups", f"{base}/checkpoint", files_per_trigger=1)
    key = lambda g: sorted((r.TRAG, float(r.Oct), float(r.Nov), r.source_rows, r.AGENCY_ord) for r in g.collect())
    want = key(I.aggregate_ledger(I.derive_codes(df)))
    assert want == [("1", 1.0, 1.0, 2, 1), ("2", 1.0, 1.0, 2, 2)]
    assert key(ST.streamed_groups(spark, f"{base}/groups")) == want
    assert key(ST.streamed_groups(spark, ST.compact(spark, f"{base}/groups", f"{base}/compact"))) == want


def test_a_cluster_must_name_its_shared_folder():
    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        conf = Conf()
        sparkContext = type("C", (), {"master": "spark://host:7077", "getCheckpointDir": lambda self: None})()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Session(), "x")


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
def test_one_month_summary_pairs_that_month_alone(spark):
    m = P.build_master(spark, SF)
    june = P.monthly_summary_from(m, ["Jun"])
    assert {r.Month for r in june.select("Month").distinct().collect()} == {"Jun"}
    everything = P.monthly_summary_from(m).where(F.col("Month") == "Jun")
    assert sorted(map(tuple, june.collect())) == sorted(map(tuple, everything.collect()))
