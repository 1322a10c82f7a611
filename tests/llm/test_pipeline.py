import os

import brute
import pytest

import corpus_pipeline
from obligato.llm import toxicity
from obligato.llm.common import table
from obligato.llm.queries import CATEGORIES

tokenizers = pytest.importorskip("tokenizers")
public = pytest.importorskip("public_tokenizers")
SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


def test_stages_match_brute_force(spark):
    """Every stage against a plain-Python version of it on the stage's own input."""
    docs = table(spark, SF, "documents").where("doc_id < 260").cache()
    columns = docs.columns
    stage = dict(corpus_pipeline.STAGES)
    rows = {r.doc_id: r for r in docs.collect()}

    chain = toxicity.fit_chain(docs, table(spark, SF, "labels"), CATEGORIES)
    toxic = chain.models[1]
    p = chain.probabilities([chain.features((r.text or "").encode()) for r in rows.values()])[:, 1]
    left = [i for i, x in zip(rows, p, strict=True) if x < toxic.threshold]
    out = stage["toxicity"](spark, docs, SF)
    assert out.columns == columns and sorted(r.doc_id for r in out.collect()) == sorted(left)

    found = brute.components([(i, rows[i].text) for i in left])
    left = [i for i in left if found[i][1] == i]
    out = stage["near_dedup"](spark, out, SF)
    assert out.columns == columns and sorted(r.doc_id for r in out.collect()) == sorted(left)

    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    found = brute.contamination([(i, rows[i].text) for i in left], items)
    left = [i for i in left if not found[i][-1]]
    out = stage["decontamination"](spark, out, SF).cache()
    assert out.columns == columns and sorted(r.doc_id for r in out.collect()) == sorted(left)

    taken = brute.copies([(i, rows[i].source, rows[i].text) for i in left])
    out = stage["mixing"](spark, out, SF).cache()
    mixed = [i for i in sorted(left) for _ in range(taken[i][3])]
    assert out.columns == columns and sorted(r.doc_id for r in out.collect()) == mixed

    tokenizer = tokenizers.Tokenizer.from_file(public.path("word_bpe_49k.json"))
    out = stage["token_files"](spark, out, SF)
    got = sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in out.collect())
    assert got == brute.tokens([(i, rows[i].text) for i in mixed], tokenizer)


def test_run_takes_an_empty_corpus(spark, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        table(spark, SF, name).limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
