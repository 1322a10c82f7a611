"""Rounding/format parity with Python and statistics against brute force."""

import math
import random
import statistics

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from obligato.functions.money import fmt_money, fmt_pct, pct_account, round1
from obligato.functions.stats import erfc, erfc_sql, two_sided_p
from obligato.operators.outliers import bh_fdr


def test_round1_matches_python(spark):
    rnd = random.Random(7)
    vals = [k / 20 for k in range(-400, 400)] + [k / 200 for k in range(0, 400)] + \
           [rnd.uniform(-1e6, 1e6) for _ in range(500)] + [0.05, 0.15, 0.25, 0.35, 2.675, -0.04]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    out = df.select("x", round1(F.col("x")).alias("r"), fmt_money(F.col("x")).alias("m"),
                    fmt_pct(F.col("x")).alias("p")).collect()
    for r in out:
        assert r.r == round(r.x, 1), r.x
        assert r.m == f"${r.x:,.1f}M", r.x
        assert r.p == f"{r.x:.1f}%", r.x


def test_pct_account(spark):
    rows = [(0.0, 0.0, 0.0), (5.0, 0.0, 100.0), (5.0, 10.0, 50.0), (-5.0, 10.0, -50.0)]
    df = spark.createDataFrame(rows, "u double, b double, want double")
    for r in df.select("want", pct_account(F.col("u"), F.col("b")).alias("p")).collect():
        assert r.p == r.want


def test_erfc_is_exact_to_double_precision(spark):
    xs = [i / 20 for i in range(-100, 500)]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    con = duckdb.connect()
    sql = dict(con.execute(f"SELECT x, {erfc_sql('x')} FROM (SELECT unnest({xs!r}::DOUBLE[]) AS x)").fetchall())
    for r in df.select("x", erfc(F.col("x")).alias("e"), two_sided_p(F.col("x")).alias("p")).collect():
        assert math.isclose(r.e, math.erfc(r.x), rel_tol=2e-12), r.x
        assert math.isclose(sql[r.x], math.erfc(r.x), rel_tol=2e-12), r.x
        assert math.isclose(r.p, 2 * statistics.NormalDist().cdf(-abs(r.x)), rel_tol=1e-9, abs_tol=1e-15), r.x


def _bh_brute(ps, alpha):
    n = len(ps)
    order = sorted(range(n), key=lambda i: ps[i])
    reject = [False] * n
    rmax = -1
    for k, i in enumerate(order, 1):
        if ps[i] <= k / n * alpha:
            rmax = k
    for k, i in enumerate(order, 1):
        if k <= rmax:
            reject[i] = True
    raw = [ps[i] * n / k for k, i in enumerate(order, 1)]
    corr = [0.0] * n
    m = float("inf")
    for k in range(n - 1, -1, -1):
        m = min(m, raw[k])
        corr[order[k]] = min(1.0, m)
    return reject, corr


@pytest.fixture
def many_ranges(spark):
    """Small ranges stay apart."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_bh_matches_brute_force(spark, many_ranges):
    rnd = random.Random(11)
    ps = [rnd.random() ** 3 for _ in range(300)] + [0.001] * 5 + [0.5] * 20    # ties included
    df = spark.createDataFrame([(i, p) for i, p in enumerate(ps)], "id long, p_value double") \
        .withColumn("level", F.lit("x"))
    got = {r.id: (r.is_outlier, r.p_corrected) for r in bh_fdr(df, 0.05).collect()}
    reject, corr = _bh_brute(ps, 0.05)
    for i in range(len(ps)):
        assert got[i][0] == reject[i], i
    # corrected p for tied values is the smallest over the tie block
    for i in range(len(ps)):
        tied = [corr[j] for j in range(len(ps)) if ps[j] == ps[i]]
        assert abs(got[i][1] - min(tied)) < 1e-12, i


def test_bh_of_a_million_values(spark, many_ranges):
    """Two levels, one with most of the values, against the definition in numpy."""
    df = spark.range(1_000_000).select("id", F.when(F.col("id") % 10 == 0, "a").otherwise("b").alias("level"), F.pow(F.rand(5), 4.0).alias("p_value"))
    got = bh_fdr(df, 0.05).toPandas()
    assert len(got) == 1_000_000
    for _, rows in got.groupby("level"):
        rows = rows.sort_values("p_value")
        p, n = rows.p_value.to_numpy(), len(rows)
        raw = p * n / np.searchsorted(p, p, side="right")
        corrected = np.minimum(np.minimum.accumulate(raw[::-1])[::-1], 1.0)
        assert np.allclose(rows.p_corrected, corrected, rtol=1e-12)
        assert (rows.is_outlier.to_numpy() == (p <= p[raw <= 0.05].max(initial=-1))).all()

