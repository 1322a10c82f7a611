import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from obligato.llm import merkle
from obligato.llm.positions import numbered

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def rows_of(seed, n):
    rng = random.Random(seed)
    sources = ["b", "a", "é", "Z", None, "", "hot", "\U0001f600", "￿"]
    rows = [(i, rng.choices(sources, weights=[2, 2, 1, 1, 1, 1, 30, 1, 1])[0], rng.choice(["en", None]), rng.choice([None, 5, -3]),
             rng.choice(["", f"x\ny{i}", "line\n" * 3, f"plain é {i}", "\n", None])) for i in range(n)]
    return [*rows, (None, "a", "en", 1, "p\nq"), (None, "a", "en", 1, "r"), (3, "a", "de", 2, "other\ntext"), (-7, None, None, None, None),
            *rows[:1] * 3, (10 ** 15, "hot", "en", 1, "long\n" * 100_000)]


def made(spark, rows, schema=SCHEMA, **kwargs):
    df = spark.createDataFrame(rows, schema).repartition(3)
    out = merkle.manifest(df, merkle.without_line_feeds(df), **kwargs)
    return sorted(map(tuple, out.collect()), key=str)


@pytest.mark.parametrize(("n", "height"), [(300, 1), (300, 2), (700, 6), (40, 6)])
def test_matches_brute_force(spark, n, height):
    rows = rows_of(n + height, n)
    got = made(spark, rows, height=height)
    assert got == sorted(brute.manifest(rows), key=str)
    assert {r[-1] for r in got} == {True, False}


def test_small_tables(spark):
    assert made(spark, []) == []
    for rows in ([(1, "a", "en", 1, "x")], [(1, "a", "en", 1, "x\n"), (2, "a", None, None, None)], [(None, None, None, None, None)] * 5,
                 [(2 * i, f"s{i}", "en", 1, "x\ny") for i in range(11)]):
        assert made(spark, rows) == sorted(brute.manifest(rows), key=str)


def test_extra_columns_do_not_matter(spark):
    rows = rows_of(9, 30)
    extra = ", tree string, digest string, position long, total int, given string, _text int, _id int, _salt int, _at int, root string"
    assert made(spark, [(*r, "t", "d", 1, 2, "g", 3, 4, 5, 6, "r") for r in rows], SCHEMA + extra) == sorted(brute.manifest(rows), key=str)


def test_any_change_is_found(spark):
    rows = [(i, "a", "en", 1, f"text {i}") for i in range(30)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = merkle.manifest(df, F.when(F.col("doc_id") == 7, F.lit("text 8"))).collect()
    assert [r.doc_id for r in out if not r.verified] == [7]


@pytest.mark.parametrize("levels", [1, 2, 3, 4, 7])
def test_addresses_are_a_van_emde_boas_order(levels):
    def order(depth, index, levels):
        """Nodes (depth, index) of the subtree in storage order."""
        if levels == 1:
            return [(depth, index)]
        top = levels // 2
        out = order(depth, index, top)
        for k in range(3 ** top):
            out += order(depth + top, index * 3 ** top + k, levels - top)
        return out

    expected = {node: place for place, node in enumerate(order(0, 0, levels))}
    for depth in range(levels):
        places = merkle.address(levels, depth, np.arange(3 ** depth))
        assert places.tolist() == [expected[depth, i] for i in range(3 ** depth)]
    assert len(expected) == merkle.tree_size(levels)


def test_block_paths_fold_to_the_root():
    for n in (1, 2, 3, 4, 9, 10, 26, 28):
        leaves = [bytes([i]) * 32 for i in range(n)]
        for height in {merkle.height_of(n), merkle.height_of(n) + 2}:
            store = merkle.build_block(leaves, height)
            assert all(merkle.fold(x, p) == store[:32] for x, p in zip(leaves, merkle.block_paths(store, height, n), strict=True))


def test_numbered_splits_runs_of_equal_rows(spark):
    df = spark.createDataFrame([("g", 1)] * 5000 + [("h", k % 7) for k in range(100)], "g string, v int")
    out = numbered(df, "g", ["v"]).collect()
    for g, n in (("g", 5000), ("h", 100)):
        mine = sorted((r.position, r.v, r.total) for r in out if r.g == g)
        assert [m[0] for m in mine] == list(range(n)) and [m[1] for m in mine] == sorted(m[1] for m in mine) and {m[2] for m in mine} == {n}
