import hashlib
import random

import brute
import numpy as np
import pytest
import xxhash

from obligato.llm import repeats


def rows_of(df):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()}


def mixed_rows(seed, letters, n=50):
    rng, rows = random.Random(seed), []
    parts = ["".join(rng.choices(letters, k=rng.randint(20, 400))) for _ in range(12)]
    for i in range(n):
        pieces = [rng.choice(parts)[rng.randint(0, 20):] if rng.random() < 0.7 else "".join(rng.choices("abc", k=rng.randint(0, 150)))
                  for _ in range(rng.randint(0, 6))]
        rows.append((i, "".join(pieces)))
    return rows


@pytest.mark.parametrize(("seed", "letters"), [(1, "ab"), (2, "abcdefgh é"), (3, "a")])
def test_matches_brute_force(spark, seed, letters):
    rows = mixed_rows(seed, letters) + [(100, "a" * 1000), (101, "a" * 150), (102, None), (103, ""), (104, "é" * 300),
                                        (105, "abc" * 200), (106, "xabc" * 2 + "abc" * 60), (107, "a" * 99), (108, "a" * 100)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert rows_of(repeats.remove_repeats(df)) == brute.removed(rows)


def test_pieces_of_a_long_text(spark, monkeypatch):
    rng = random.Random(4)
    text = "".join(rng.choices("abcdef", k=700))
    rows = [(1, text + "#" + text), (2, text[50:400] + "?" + text[:300])]
    data = np.frombuffer(rows[0][1].encode(), np.uint8)
    whole = [x.tolist() for x in repeats.runs_of(data)]
    monkeypatch.setattr(repeats, "PIECE", 64)
    cut = [repeats.runs_of(d) for _, d in repeats.pieces(data)]
    assert sum(int(c[3].sum()) for c in cut) == sum(whole[3]) == len(data) - 99
    assert rows_of(repeats.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"))) == brute.removed(rows)


def test_null_ids_repeated_rows_and_clashing_columns(spark):
    a, b = "".join(random.Random(5).choices("abcdef", k=300)), "".join(random.Random(6).choices("abcdef", k=300))
    rows = [(None, a, 1), (3, a, 2), (3, a, 3), (5, a + b, 4), (6, b, 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, doc long")
    got = sorted((r.doc_id or 0, r.n_removed, r.n_spans) for r in repeats.remove_repeats(df).collect())
    assert got == [(0, 0, 0), (3, 0, 0), (3, 0, 0), (5, 300, 1), (6, 300, 1)]


def test_kept_bytes_and_empty_table(spark):
    text = "".join(random.Random(7).choices("abcdef", k=250))
    df = spark.createDataFrame([(1, text), (2, "head " + text + " tail")], "doc_id long, text string")
    assert {r.doc_id: bytes(r.kept).decode() for r in repeats.remove_repeats(df, texts=True).collect()} == {1: text, 2: "head  tail"}
    assert repeats.remove_repeats(df.limit(0)).count() == 0


def by_id_and_text(rows):
    """{(doc_id, text): (n_bytes, n_removed)} where ids may be shared: strings come by id, start and the text's hash."""
    hash_of = {t: np.uint64(xxhash.xxh64_intdigest(t.encode(), 42)).astype(np.int64) for _, t in rows}
    first = {}
    for i, t in set(rows):
        for a in range(len(t) - 99):
            place = (i, a, hash_of[t])
            first[t[a:a + 100]] = min(first.get(t[a:a + 100], place), place)
    out = {}
    for i, t in set(rows):
        gone = {b for a in range(len(t) - 99) if first[t[a:a + 100]] != (i, a, hash_of[t]) for b in range(a, a + 100)}
        out[i, t] = (len(t), len(gone))
    return out


@pytest.mark.parametrize("ids", [1, 3])
def test_different_texts_of_one_id(spark, ids):
    rows = [(i % ids, t) for i, t in mixed_rows(11, "abcd", 60) if t] + [(0, "x" * 193), (0, "y" * 193), (0, "x" * 193)]
    out = repeats.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), texts=True).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_removed) for r in out) == sorted((i, *by_id_and_text(rows)[i, t]) for i, t in rows)


def test_ten_thousand_texts_of_one_id_and_a_row_a_thousand_times(spark):
    rng = random.Random(12)
    long = "".join(rng.choices("abcdefgh", k=300))
    rows = [(2, hashlib.sha512(str(k).encode()).hexdigest()[:104]) for k in range(10_000)] + [(3, long)] * 1000 + [(4, "head" + long + "tail")]
    out = repeats.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).groupBy(
        "doc_id", "n_bytes", "n_removed", "n_spans").count().collect()
    assert sorted(map(tuple, out)) == [(2, 104, 0, 0, 10_000), (3, 300, 0, 0, 1000), (4, 308, 300, 1, 1)]
