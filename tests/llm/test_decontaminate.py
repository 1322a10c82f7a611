import os
import random

import brute
import numpy as np
import pytest

from obligato.llm import decontaminate, fmindex
from obligato.llm.common import table
from obligato.llm.queries import op9_decontamination

SF = "/root/testdata/sf0.001"


def test_fm_index_finds_what_a_scan_finds():
    rng = np.random.default_rng(1)
    for sigma, n in ((2, 300), (5, 500), (200, 700), (1, 50)):
        text = rng.integers(1, sigma + 1, n)
        index = fmindex.FMIndex(text, sample=7)
        for m in (1, 2, 5):
            patterns = np.stack([text[i:i + m] for i in rng.integers(0, n - m, 20)] + [np.full(m, sigma + 3)])
            low, high = index.search(patterns)
            for p, a, b in zip(patterns, low, high, strict=True):
                expected = [i for i in range(n - m + 1) if (text[i:i + m] == p).all()]
                assert sorted(index.locate(np.arange(a, b)).tolist()) == expected


def case():
    rng, words = random.Random(2), [f"w{i}" for i in range(30)]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(12, 25)))) for i in range(8)]
    items += [(50, "only Three words"), (51, ""), (52, None), (53, items[0][1]), (54, "lone"), (0, items[0][1])]
    rows = []
    for i in range(40):
        text = rng.choices([*words, "the", "x"], k=rng.randint(0, 60))
        for _ in range(rng.randint(0, 2)):
            item = (rng.choice(items)[1] or "").split()
            text[rng.randint(0, len(text)):0] = item[:rng.randint(0, len(item))]
        rows.append((i, "-".join(text).upper() if i % 3 else " ".join(text)))
    return rows + [(90, None), (91, ""), (92, "only three, WORDS lone-lone"), (93, "é" * 20)], items


def result(df):
    return {r.doc_id: (r.n_words, r.n_hit, sorted(r.items), sum(b - a for a, b in zip(r.spans[::2], r.spans[1::2], strict=True))) for r in df.collect()}


@pytest.mark.parametrize("block", [1 << 20, 60])
def test_matches_brute_force_in_one_block_or_many(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    rows, items = case()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {k: (n, h, len(i), s) for k, (n, h, i, s) in result(decontaminate.contamination(docs, bench)).items()}
    assert got == {k: (n, h, i, h) for k, (n, h, i, _, _) in brute.contamination(rows, items).items()}


def test_plan_and_driver_hold_one_block(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 300)
    rows, items = case()
    docs, bench = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert sum(more for _, more in decontaminate._blocks(bench, "item_id", "text")) > 1
    found = decontaminate.contamination(docs, bench, keep=("doc_id",))
    assert found._jdf.queryExecution().analyzed().toString().count("MapInArrow") == 1
    assert found.count() == len(rows)


def test_blocks_of_rows_located(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "ROWS", 3)
    rows, items = case()
    p = decontaminate.phrases([(str(i), (t or "").encode()) for i, t in items], 10)
    counts, spans, found = decontaminate.search_shard([(t or "").encode() for _, t in rows], p)
    expected = brute.contamination(rows, items)
    assert [(n, sum(s[1::2]) - sum(s[::2])) for n, s in zip(counts, spans, strict=True)] == [expected[i][:2] for i, _ in rows]


def test_clean_documents_empty_tables_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a b", "k", 2), (1, "a b", "k", 2), (2, None, None, 3), (3, "zz", "l", 4)],
                                 "doc_id long, text string, spans string, items long")
    bench = spark.createDataFrame([(7, "A b")], "item_id long, text string")
    clean = decontaminate.clean_documents(docs, bench)
    assert clean.columns == docs.columns
    assert sorted(r.doc_id for r in clean.collect()) == [2, 3]
    assert decontaminate.clean_documents(docs, bench.limit(0)).count() == 4
    assert decontaminate.contamination(docs.limit(0), bench).count() == 0


def test_an_item_without_id_hits_but_is_not_listed(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    bench = spark.createDataFrame([(None, "b")], "item_id long, text string")
    assert result(decontaminate.contamination(docs, bench)) == {1: (3, 1, [], 1)}


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
def test_query_on_given_tables(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in op9_decontamination(spark, SF).collect()}
    assert got == brute.contamination(rows, items)
