import random

import brute
import pytest
from pyspark.sql import functions as F

from obligato.llm import mixing
from obligato.llm.queries import SLOPES

SCHEMA = "doc_id long, source string, text string"


def rows_of(seed, n=120):
    rng, sources = random.Random(seed), ["b", "a", "é", "Z", None, "hot", "empty"]
    rows = []
    for i in range(n):
        source = rng.choices(sources, weights=[2, 2, 1, 1, 1, 9, 1])[0]
        rows.append((i, source, "" if source == "empty" else " ".join(["w"] * rng.randint(0, 40))))
    return [*rows, (900, "a", None), (901, "b", "\t \n"), (902, "a", "long " * 30000)]


def planned(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).withColumn("size", mixing.word_count(F.col("text"))).repartition(3)
    return mixing.first_positions(mixing.plan(df, SLOPES))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_matches_brute_force(spark, seed):
    rows = rows_of(seed)
    got = {r.doc_id: (r.size, r.source_size, r.target, r.copies) for r in planned(spark, rows).collect()}
    expected = brute.copies(rows)
    assert {k: v[:2] + v[3:] for k, v in got.items()} == {k: v[:2] + v[3:] for k, v in expected.items()}
    assert all(got[k][2] == pytest.approx(expected[k][2]) for k in got)


def test_sources_come_near_their_targets_and_epochs_are_limited(spark):
    got = planned(spark, rows_of(4)).collect()
    for source in {r.source for r in got}:
        mine = [r for r in got if r.source == source]
        assert all(0 <= r.copies <= 3 for r in mine)
        assert abs(sum(r.copies * r.size for r in mine) - mine[0].target) <= max(r.size for r in mine) / 2 + 1e-6
    assert sum({r.source: r.target for r in got}.values()) == pytest.approx(sum({r.source: r.source_size for r in got}.values()))


def test_positions_follow_the_schedule(spark):
    """Up to any time a source has given the integral of its weight up to then, to half a document."""
    rows = [(i, s, "w " * 10) for s, k in (("a", 0), ("b", 1), ("c", 2)) for i in range(k * 1000, k * 1000 + 300)]
    got = planned(spark, rows).collect()
    for source, (w0, w1) in zip("abc", SLOPES, strict=True):
        mine = [r for r in got if r.source == source]
        once = sum(r.size for r in mine if r.copies)
        for t in (0.1, 0.25, 0.5):
            given = sum(r.size for r in mine if r.first_position is not None and r.first_position <= t)
            asked = (w0 * t + (w1 - w0) * t * t / 2) / ((w0 + w1) / 2) * mine[0].target
            assert given == pytest.approx(min(asked, once), abs=10)


def test_mixed_documents_are_copies_with_their_own_columns(spark):
    rows = rows_of(5)
    extra = ", copies int, size string, target string, before int, _row int, _key string, position string"
    df = spark.createDataFrame([(*r, -1, "x", "y", 7, 8, "k", None) for r in rows], SCHEMA + extra)
    mixed = mixing.mixed_documents(df, SLOPES)
    assert mixed.schema.names == df.schema.names
    assert {tuple(r)[3:] for r in mixed.collect()} == {(-1, "x", "y", 7, 8, "k", None)}
    expected = brute.copies(rows)
    count = {r.doc_id: r.n for r in mixed.groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    assert count == {k: v[3] for k, v in expected.items() if v[3]}


def test_reruns_agree_and_repeated_rows(spark):
    rows = [(1, "a", "x y"), (1, "a", "x y"), (None, None, "z"), (2, "b", "x")]
    first, again = (sorted(map(str, planned(spark, rows).collect())) for _ in range(2))
    assert first == again and len(first) == 4


def test_empty_table_and_tables_without_words(spark):
    assert planned(spark, []).count() == 0
    got = planned(spark, [(1, "a", None), (2, "b", "")]).collect()
    assert [(r.copies, r.target, r.first_position) for r in got] == [(0, 0.0, None)] * 2
    df = spark.createDataFrame([], SCHEMA)
    assert mixing.mixed_documents(df, SLOPES).count() == 0


def test_plan_stays_in_the_jvm(spark):
    plan = planned(spark, rows_of(6))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
