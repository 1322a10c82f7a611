import math
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__
from obligato.llm import queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


def test_every_operator_is_registered():
    names = __spark_entry__.queries()
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)] == [1] * 13
    assert "pipeline" in names and set(queries.ORACLE) <= set(__spark_entry__.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    expected, got = con.execute(queries.ORACLE[name]).df(), queries.QUERIES[name](spark, SF).toPandas()

    def rows(pdf):
        plain = lambda v: None if v is None or isinstance(v, float) and math.isnan(v) else v
        return Counter(tuple(map(plain, r)) for r in pdf[sorted(pdf.columns)].itertuples(index=False, name=None))

    assert sorted(expected.columns) == sorted(got.columns)
    assert rows(got) == rows(expected)


def test_toxicity_and_licences_cover_every_document(spark):
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    for name in ("op2_toxicity", "op5_licences"):
        out = queries.QUERIES[name](spark, SF)
        assert out.count() == out.select("doc_id").distinct().count() == n
