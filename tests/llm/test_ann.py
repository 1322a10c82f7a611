import numpy as np

from obligato.llm import ann


def table(spark, ids, vectors, extra=False):
    rows = [(int(i), None if v is None else [None if x is None else float(x) for x in v]) for i, v in zip(ids, vectors, strict=True)]
    return spark.createDataFrame([(*r, 0.5) for r in rows], "vec_id long, embedding array<float>, score double")


def exact(ids, vectors, q, k):
    v = vectors.astype(np.float32).astype(np.float64)
    s = (v @ v[q]) / np.sqrt((v ** 2).sum(1) * (v[q] ** 2).sum())
    return sorted((-x, i) for x, i in zip(s, ids, strict=True) if i != ids[q])[:k]


def test_recall_and_scores_over_shards(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(20, 24))
    vectors = centres[rng.integers(0, 20, 3000)] + rng.normal(size=(3000, 24)) * 0.7
    ids = np.arange(3000)
    df = table(spark, ids, vectors)
    got = ann.nearest(df, df.where("vec_id % 50 = 0"), k=5, shard=700).collect()
    by = {}
    for r in got:
        by.setdefault(r.query_id, []).append(r)
    assert set(by) == set(range(0, 3000, 50))
    hits = 0
    for q, rows in by.items():
        rows.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in rows] == [1, 2, 3, 4, 5]
        assert [(-r.score, r.vec_id) for r in rows] == sorted((-r.score, r.vec_id) for r in rows)
        best = exact(ids, vectors, q, 5)
        hits += len({i for _, i in best} & {r.vec_id for r in rows})
    assert hits / (5 * len(by)) > 0.95


def test_equal_vectors_ties_and_unusable_ones(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [[1, 0], [1, 0], [2, 0], [0, 1], [1, 1], None, [0, 0], [1, None], [nan, 1], [inf, 1], [], [1, 0, 0], [0.5, 0, 0], [1, 0]]
    df = table(spark, range(len(vectors)), vectors)
    got = {}
    for r in ann.nearest(df, df, k=3, shard=4).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, round(r.score, 9)))
    got = {q: sorted(r) for q, r in got.items()}
    assert got[0] == [(1, 1, 1.0), (2, 2, 1.0), (3, 13, 1.0)]
    assert got[13] == [(1, 0, 1.0), (2, 1, 1.0), (3, 2, 1.0)]
    assert got[11] == [(1, 12, 1.0)] and got[12] == [(1, 11, 1.0)]
    assert set(got) == {0, 1, 2, 3, 4, 11, 12, 13}


def test_many_copies_of_one_vector(spark):
    rng = np.random.default_rng(1)
    vectors = np.vstack([np.tile(rng.normal(size=8), (300, 1)), rng.normal(size=(100, 8))])
    df = table(spark, range(400), vectors)
    got = ann.nearest(df, df.where("vec_id in (0, 7, 350)"), k=5, shard=1000)
    assert sorted((r.query_id, r.vec_id) for r in got.collect() if r.query_id < 300) == [(0, i) for i in range(1, 6)] + [(7, i) for i in range(5)]


def test_empty_tables(spark):
    df = table(spark, [1], [[1, 2]])
    assert ann.nearest(df.limit(0), df).count() == 0
    assert ann.nearest(df, df.limit(0)).count() == 0
    assert ann.nearest(df, df).count() == 0


def test_pruning_keeps_diverse_edges():
    rng = np.random.default_rng(5)
    points = rng.normal(size=(500, 6))
    points = (points / np.linalg.norm(points, axis=1, keepdims=True)).astype(np.float32)
    graph = ann.build(points)
    d = 2 - 2 * points @ points.T
    for p in range(0, 500, 25):
        kept = [e for e in graph.edges[p] if e >= 0]
        assert p not in kept and len(set(kept)) == len(kept) > 0
    graph.prune(np.arange(500), np.tile(np.arange(500), (500, 1)))
    for p in range(0, 500, 25):
        kept = [e for e in graph.edges[p] if e >= 0]
        for i, a in enumerate(kept):
            assert all(ann.ALPHA ** 2 * d[b, a] > d[p, a] - 1e-5 for b in kept[:i])
