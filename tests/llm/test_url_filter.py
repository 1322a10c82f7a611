import random
import re

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from obligato.llm import queries, url_filter

RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
PAGES, LABELS = "page_id long, url string, html string", "page_id long, bad boolean"


def judged(spark, pages, labels=(), rules=RULES, schema=PAGES, **kwargs):
    out = url_filter.judge(spark.createDataFrame(pages, schema), spark.createDataFrame(rules, "verdict string, host string, path string"),
                           spark.createDataFrame(list(labels), LABELS), **kwargs)
    return out.collect()


def by_id(rows):
    return {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in rows}


def test_urls_and_rules(spark):
    urls = ["http://A.Example.NET/en/x?q=1#f", "https://example.net/de/", "http://net", "http://net/", "http://x.net?y", "http://xnet/",
            "http://www.example.com/de/1", "http://example.com/DE/1", "http://a.org/fr/", "http://a.org/en/", "http://a.org:80/fr/x",
            "ftp://user@Ä.ORG/fr/é?://b.net/", "no scheme", "", None, "://", "http://", "http:///en/", "x://y://z.net/", "a\nb://C.net/p\nq#r",
            "http://notexample.net/en/", "http://x.example.net/en/://", "http://example.com/de", "http://" + "a." * 20000 + "net/" + "x" * 50000]
    rows = [(i, u, None) for i, u in enumerate(urls)]
    assert by_id(judged(spark, rows)) == {i: brute.url(u, RULES) for i, u, _ in rows}


def test_longest_rule_wins(spark):
    rules = [("block", "a.b", "/"), ("allow", "b", "/x/"), ("block", "b", "/x/y"), ("allow", "c.a.b", "/"), ("allow", "a.b", "/"), ("block", None, "/"),
             ("block", "zz", "")]
    urls = ["http://a.b/x/y", "http://a.b/x/", "http://a.b/", "http://b/x/y", "http://c.a.b/x", "http://d.c.a.b/", "http://zz", "http://c"]
    rows = [(i, u, None) for i, u in enumerate(urls)]
    assert by_id(judged(spark, rows, rules=rules)) == {i: brute.url(u, rules) for i, u, _ in rows}


def test_reputation_matches_numpy_and_the_beta_quantile(spark):
    rng = random.Random(3)
    hosts = [f"h{i}.{d}" for i in range(12) for d in ("one.com", "two.com", "three.org", "four.co.uk")] + ["10.0.0.1:8080"]
    pages, labels = [], []
    for i in range(3000):
        h = hosts[0] if i % 3 == 0 else rng.choice(hosts)
        pages.append((i, f"http://{h}/{i}", None))
        if i % 2:
            labels.append((i, rng.random() < (0.95 if "two" in h else 0.1)))
    rows = judged(spark, pages, [*labels, (1, None), (None, True)])
    expected = brute.reputations(pages, labels)
    assert {r.host: (r.host_labelled, r.host_bad) for r in rows} == {h: e[:2] for h, e in expected.items()}
    for r in rows:
        a, b = expected[r.host][2:]
        assert r.bad_bound == pytest.approx(max(a / (a + b) - 1.645 * np.sqrt(a * b / ((a + b) ** 2 * (a + b + 1))), 0))
        assert r.verdict == ("block" if r.bad_bound > 0.5 else "allow")
        if r.host_labelled > 20:  # the bound is close to the posterior's 5 % quantile
            assert r.bad_bound == pytest.approx(np.quantile(np.random.default_rng(1).beta(a, b, 40000), 0.05), abs=0.03)
    assert {re.sub(r"^h\d+\.", "", r.host) for r in rows if r.verdict == "block"} == {"two.com"}


def test_one_bad_page_does_not_block_and_unlabelled_hosts_follow_their_domain(spark):
    pages = [(i, f"http://h{i % 20}.good.com/", None) for i in range(400)] + [(500, "http://new.good.com/", None), (501, "http://alone.org/", None)]
    pages += [(600 + i, f"http://s{i % 20}.spam.biz/", None) for i in range(400)] + [(1100, "http://new.spam.biz/", None)]
    labels = [(i, False) for i in range(400)] + [(600 + i, True) for i in range(400)] + [(500, True)]
    got = {r.page_id: r.verdict for r in judged(spark, pages, labels)}
    assert got[500] == got[501] == got[0] == "allow" and got[1100] == got[600] == "block"


def test_empty_tables_repeated_rows_and_clashing_columns(spark):
    assert judged(spark, []) == []
    row = (1, "http://a.net/", "x")
    assert [r.rule for r in judged(spark, [row, row, (None, row[1], None)])] == ["net/"] * 3
    assert [r.rule for r in judged(spark, [row], rules=[])] == [None]
    assert [r.verdict for r in judged(spark, [row], [(1, True)], rules=[])] == ["allow"]
    extra = "page_id long, url string, html string, host string, path string, rules string, n int, bad int, domain string, _best int, verdict string"
    (r,) = judged(spark, [(*row, "h", "p", "r", 1, 2, "d", 3, "v")], schema=extra)
    assert (r.host, r.path, r.rule, r.verdict) == ("a.net", "/", "net/", "block")


def test_query_stays_in_the_jvm(spark):
    plan = queries.op11_url_filter(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "ExistingRDD"))


def test_urls_match_brute_force_on_the_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("page_id", "url").collect()
    got = by_id(queries.op11_url_filter(spark, "/root/testdata/sf0.001").where(F.col("rule").isNotNull()).collect())
    expected = {p.page_id: brute.url(p.url, RULES) for p in pages}
    assert got == {i: e for i, e in expected.items() if e[2]}
