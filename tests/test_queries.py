"""Smoke and oracle tests on the smallest scale (sf0.001)."""

import functools
import math
import os
import sys
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from obligato.plans import pipelines, registry
from obligato.sources.fixture import TABLES

registry.load_all()

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if hasattr(v, "item"):
        v = v.item()
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    return cols, Counter(tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False, name=None))


def test_entry_runs(spark):
    df = E.entry(spark)
    assert "Budget_Authority_M" in df.columns
    assert df.count() > 0


def test_registry_has_oracles():
    registry.load_all()
    assert len(registry.QUERIES) >= 120
    assert set(registry.ORACLE) == set(registry.QUERIES)


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.fixture(scope="module")
def one_master():
    """Queries of the module share the tables that they would each build."""
    patch = pytest.MonkeyPatch()
    for name in ("build_master", "ledger_groups"):
        cached = functools.cache(lambda spark, d, *a, f=getattr(pipelines, name), **k: f(spark, d, *a, **k))
        plain = lambda spark, d, skip=None, *a, f=cached, **k: f(spark, d, tuple(skip) if skip is not None else None, *a, **k)
        for module in [m for n, m in sys.modules.items() if n.startswith("obligato.plans") and hasattr(m, name)]:
            patch.setattr(module, name, plain)
    for name in ("year_summary_from", "monthly_summary_from"):
        known, build = {}, getattr(pipelines, name)

        def cached(master, months=None, known=known, build=build, name=name):
            key = (id(master), tuple(months or ()))
            if key not in known:
                known[key] = (master, build(master, months) if name == "monthly_summary_from" else build(master))
            return known[key][1]

        for module in [m for n, m in sys.modules.items() if n.startswith("obligato.plans") and hasattr(m, name)]:
            patch.setattr(module, name, cached)
    yield
    patch.undo()


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_matches_oracle(spark, oracle, one_master, name):
    s_cols, s_rows = _rows(registry.QUERIES[name](spark, SF).toPandas())
    d_cols, d_rows = _rows(oracle.execute(registry.ORACLE[name]).df())
    assert s_cols == d_cols
    assert s_rows == d_rows
