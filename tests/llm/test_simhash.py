import os
import random

import brute
import pytest

from obligato.llm import simhash
from obligato.llm.common import table

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return {r.doc_id: (r.fingerprint, r.component_id) for r in df.collect()}


def near_copies(n, seed):
    rng, words = random.Random(seed), [f"w{i}" for i in range(400)]
    base, out = [" ".join(rng.choices(words, k=120)) for _ in range(4)], []
    for i in range(n):
        text = rng.choice(base).split()
        for _ in range(rng.randint(0, 3)):
            text[rng.randrange(len(text))] = rng.choice(words)
        out.append((i * 3 + 1, " ".join(text)))
    return out


@pytest.mark.parametrize("segments", [2, 3, 5])
def test_components_match_brute_force(spark, segments):
    rows = near_copies(60, 3) + [(500, None), (501, ""), (502, " \t\n"), (503, "One two"), (504, "ONE two"), (505, "é Ü ß"), (-7, "one TWO")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert rows_of(simhash.near_duplicates(df, segments=segments)) == brute.components(rows)


@pytest.mark.parametrize("max_distance", [0, 1, 2, 3])
def test_other_distances(spark, max_distance):
    rows = near_copies(40, 5)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(simhash.near_duplicates(df, max_distance=max_distance)) == brute.components(rows, max_distance)


def test_a_large_group_of_near_copies_needs_few_links(spark):
    rng = random.Random(4)
    fps = {sum(1 << b for b in rng.sample(range(10, 50), 2)) ^ 0x5A5A for _ in range(600)}
    nodes = spark.createDataFrame([(i, f - (1 << 64) if f >> 63 else f) for i, f in enumerate(sorted(fps))], "id long, fp long")
    close = simhash.connected_components(simhash.close_links(nodes))
    grouped = nodes.join(close, "id", "left").selectExpr("id", "fp", "coalesce(component, id) AS `group`")
    assert simhash.close_links(nodes).count() <= 65 * len(fps)
    assert simhash.links(nodes.selectExpr("id", "fp", "id AS `group`")).count() > 50 * len(fps)
    assert simhash.links(grouped).count() < len(fps)


def test_long_text_counts_blocks(monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 7)
    text = " ".join(f"w{i % 50} x{i % 7}" for i in range(300))
    assert simhash.fingerprint(text) == brute.fingerprint(text)


def test_nulls_repeats_and_clashing_columns(spark):
    rows = [(None, "a b c d e", 1, "x"), (4, "a b c d e", 2, "y"), (4, "a b c d e", 3, None), (9, "a b c d e", 4, "z"), (None, "solo", 5, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, id long, nth string")
    got = [(r.doc_id, r.component_id) for r in simhash.near_duplicates(df).collect()]
    assert sorted(g for g in got if g[0] is not None) == [(4, 4), (4, 4), (9, 4)]
    assert [g for g in got if g[0] is None] == [(None, None)] * 2
    kept = simhash.keep_representatives(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 0, 4]
    assert {r.nth for r in kept.collect()} <= {"x", "y", "z", None}


def test_different_texts_that_share_an_id_are_kept(spark):
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(60)) for x in "abcd")
    near = " ".join([*b.split()[:-1], "other"])
    distance = (brute.fingerprint(b) ^ brute.fingerprint(near)).bit_count()
    rows = [(2, a, 1), (4, a, 2), (4, b, 3), (4, c, 4), (4, near, 5), (4, c, 4), (4, c, 6), (9, b, 7), (10, c, 8), (11, d, 9), (-3, d, 10),
            (2 ** 63 - 1, "e", 11), (-(2 ** 63), "f", 12), (5, None, 13), (5, "g", 14)]
    for parts in (1, 3):
        df = spark.createDataFrame(rows, "doc_id long, text string, key int").repartition(parts)
        kept = sorted((r.doc_id, r.text or "") for r in simhash.keep_representatives(df, max_distance=max(4, distance)).collect())
        assert [k for k in kept if k[1] not in (b, near)] == sorted([
            (2, a), (4, c), (-3, d), (2 ** 63 - 1, "e"), (-(2 ** 63), "f"), (5, ""), (5, "g")])
        assert [k[0] for k in kept if k[1] in (b, near)] == [4]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(df).count() == 0
    assert simhash.keep_representatives(df).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
def test_given_documents(spark):
    docs = table(spark, SF, "documents")
    assert rows_of(simhash.near_duplicates(docs)) == brute.components([(r.doc_id, r.text) for r in docs.collect()])
