import random

import brute
import numpy as np
import pytest

from obligato.llm import collocations
from obligato.llm import quotient_filter as qf

SCHEMA = "lang string, text string"


def rows_of(seed, n=600):
    rng = random.Random(seed)
    words = ["the", "The", "new", "york", "city", "of", "é", "É", "a\x00b", "\x1c", "naïve", "x" * 50] + [f"w{i}" for i in range(15)]
    ends = [" ", "  ", "\t", " ", " ", ". ", ",", ";", ": ", "!", "?", "\n", "\r\n", "\x0b", "\x0c"]
    rows = []
    for _ in range(n):
        text = "".join(rng.choice(words) + rng.choice(ends) for _ in range(rng.randint(0, 60)))
        text += "new york city" * rng.randint(0, 1) + " san  francisco bay" * rng.randint(0, 2)
        rows.append((rng.choice(["en", "en", "en", None, "und", "de"]), text))
    return [*rows, ("en", None), ("en", ""), (None, "..., \t\n"), ("fr", "rare words only"), ("en", "deep sea " * 3000 + "."), *[("hot", "same words here")] * 12]


def mined(spark, rows, schema=SCHEMA, **kwargs):
    out = collocations.mine(spark.createDataFrame(rows, schema).repartition(3), **kwargs).collect()
    return sorted(map(tuple, out))


@pytest.mark.parametrize(("seed", "kwargs"), [(1, {}), (2, {"chunk": 200, "fan_bits": 2}), (3, {"max_words": 4, "min_count": 5, "share": 80, "top": 20})])
def test_matches_brute_force(spark, seed, kwargs):
    """The second case has many chunks and several rounds of merging."""
    rows = rows_of(seed)
    got = mined(spark, rows, **kwargs)
    expected = brute.phrases(rows, **{k: v for k, v in kwargs.items() if k not in ("chunk", "fan_bits")})
    assert got == sorted(expected) and len(got) > 15


def test_long_texts_are_split_at_pieces(spark):
    rows = [("en", "alpha beta gamma. " * 150_000), ("en", "alpha beta " * 200_000)]
    assert min(len(t) for _, t in rows) > 2 * collocations.SLICE
    assert mined(spark, rows, chunk=5000) == sorted(brute.phrases(rows))


def test_empty_and_clashing_columns(spark):
    assert mined(spark, []) == [] == mined(spark, [("en", "once only")]) == mined(spark, [(None, None)])
    rows = rows_of(4, 40)
    extra = SCHEMA + ", word string, words int, ids string, n int, k int, chunk int, position int, total int, a int, rank string"
    assert mined(spark, [(*r, "w", 1, "i", 2, 3, 4, 5, 6, 7, "x") for r in rows], extra) == sorted(brute.phrases(rows))


def test_products_may_pass_64_bits(spark):
    big = 10 ** 14
    phrases = spark.createDataFrame([("en", [0, 1], big - 1), ("en", [0, 1, 2], big - 2)], "lang string, ids array<long>, a long")
    words = spark.createDataFrame([("en", [0], big), ("en", [1], big + 1), ("en", [2], big - 1)], "lang string, ids array<long>, a long")
    got = {tuple(r.ids): (r.l, r.r, r.score) for r in collocations.best_cuts(phrases, words).collect()}
    cuts = [(big, big - 1), (big - 1, big - 1)]  # f(1 2) is unknown here, so only the cut after two words counts
    assert got[0, 1] == (big, big + 1, 10 ** 6 * (big - 1) ** 2 // (big * (big + 1)))
    assert got[0, 1, 2] == (*cuts[1], 10 ** 6 * (big - 2) ** 2 // (cuts[1][0] * cuts[1][1]))


@pytest.mark.parametrize(("n", "bits"), [(2, 1), (2, 5), (3, 7), (3, 21), (3, 32), (3, 42), (2, 63), (5, 9)])
def test_filters_are_lossless(n, bits):
    rng = np.random.default_rng(n * 100 + bits)
    shards, total = [], {}
    for _ in range(4):
        ids = [rng.integers(0, 1 << bits, 3000) >> rng.integers(0, max(1, bits - 3), 3000) for _ in range(n)]
        for key in zip(*(c.tolist() for c in ids), strict=True):
            total[key] = total.get(key, 0) + 1
        high, low, counts = qf.counted(*qf.permute(*qf.pack(ids, bits), n, bits))
        back = qf.unpack(*qf.permute(high, low, n, bits, back=True), n, bits)
        assert len(set(zip(*(c.tolist() for c in back), strict=True))) == len(high)
        whole = qf.encode(high, low, counts, n, bits)
        assert all((a == b).all() for a, b in zip(qf.decode(whole), (high, low, counts), strict=True))
        shards.append(dict(qf.split(high, low, counts, n, bits, 0, 3)))
    got = {}
    for lead in set().union(*shards):
        high, low, counts = qf.merge([s[lead] for s in shards if lead in s])
        for _, part in qf.split(high, low, counts, n, bits, qf.shape(next(s[lead] for s in shards if lead in s))[2], 4):
            h, l, c = qf.decode(part)
            ids = qf.unpack(*qf.permute(h, l, n, bits, back=True), n, bits)
            got |= dict(zip(zip(*(x.tolist() for x in ids), strict=True), c.tolist(), strict=True))
    assert got == total


def test_large_counts_and_empty_filters():
    high, low = np.arange(5, dtype=np.uint64), np.arange(5, dtype=np.uint64)
    counts = np.array([1, 254, 255, 256, 10 ** 15])
    assert qf.decode(qf.encode(high, low, counts, 3, 8))[2].tolist() == counts.tolist()
    none = np.zeros(0, np.uint64)
    assert [len(x) for x in qf.decode(qf.encode(none, none, counts[:0], 3, 8))] == [0, 0, 0] and qf.split(none, none, counts[:0], 3, 8, 0, 6) == []
    with pytest.raises(ValueError, match="cannot be packed"):
        qf.halves(3, 43)


def test_filters_are_compact():
    rng = np.random.default_rng(5)
    ids = [rng.integers(0, 1 << 20, 100_000) for _ in range(3)]
    values = qf.counted(*qf.permute(*qf.pack(ids, 20), 3, 20))
    assert len(qf.encode(*values, 3, 20)) < 8 * len(values[0])  # 60-bit keys and their counts in under 8 bytes each
