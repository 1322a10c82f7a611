import hashlib
import random

from obligato.llm import line_chunks

SCHEMA = "doc_id long, text string"


def chunked(text, divisor=line_chunks.DIVISOR):
    lines = text.split("\n")
    hashes = [int(hashlib.md5(x.encode()).hexdigest()[:8], 16) for x in lines]
    chunks, now = [], []
    for i, line in enumerate(lines):
        now.append(line)
        if sum(f * hashes[i - k] for k, f in enumerate(line_chunks.FACTORS) if i >= k) % divisor == 0:
            chunks.append(now)
            now = []
    return chunks + [now] * bool(now)


def brute(rows):
    seen, out = set(), {}
    for i, text in sorted(rows):
        if text is None:
            out[i] = (0, 0, None)
            continue
        kept, gone = [], 0
        for c in chunked(text):
            if len(c) > 1 and tuple(c) in seen:
                gone += len(c)
            else:
                kept += c
            seen.add(tuple(c))
        out[i] = (len(text.split("\n")), gone, "\n".join(kept))
    return out


def result(df, **kw):
    return {r.doc_id: (r.n_lines, r.n_removed, r.kept) for r in line_chunks.remove_repeated_chunks(df, **kw).collect()}


def rows_of(seed):
    rng = random.Random(seed)
    passages = [[f"line {rng.randint(0, 9999)}" for _ in range(rng.randint(3, 20))] for _ in range(5)]
    rows = []
    for i in range(60):
        lines = [f"own {i} {k}" for k in range(rng.randint(0, 8))]
        for _ in range(rng.randint(0, 2)):
            lines[rng.randint(0, len(lines)):0] = rng.choice(passages)
        rows.append((i, "\n".join(lines)))
    return rows + [(100, None), (101, ""), (102, "\n\n\n\n"), (103, "\n\n\n\n"), (104, "é\r\nü\n" * 50)]


def test_matches_brute_force(spark):
    for seed in (1, 2):
        rows = rows_of(seed)
        got = result(spark.createDataFrame(rows, SCHEMA).repartition(3))
        assert got == brute(rows)
        assert sum(n for _, n, _ in got.values()) > 50


def test_boundaries_resist_shifts():
    rng = random.Random(3)
    lines = [f"line {rng.randint(0, 10**6)}" for _ in range(200)]
    whole, shifted = chunked("\n".join(lines)), chunked("\n".join(["new", *lines]))
    assert whole[2:] == shifted[-len(whole[2:]):]


def test_equal_hashes_are_told_apart_by_their_bytes(spark, monkeypatch):
    monkeypatch.setattr(line_chunks.F, "xxhash64", lambda *c: line_chunks.F.lit(1).cast("long"))
    rows = rows_of(4)
    assert result(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_null_ids_repeated_rows_clashing_columns_and_empty_table(spark):
    text = "\n".join(f"l{i}" for i in range(40))
    df = spark.createDataFrame([(None, text, 1), (3, text, 2), (3, text, 3), (4, text, 4)], SCHEMA + ", lines int")
    got = sorted(((r.doc_id or 0), r.n_removed) for r in line_chunks.remove_repeated_chunks(df).collect())
    multi = sum(len(c) for c in chunked(text) if len(c) > 1)
    assert got == [(0, 0), (3, 0), (3, 0), (4, multi)]
    assert line_chunks.remove_repeated_chunks(df.limit(0)).count() == 0


def test_plan_stays_in_the_jvm(spark):
    df = line_chunks.remove_repeated_chunks(spark.createDataFrame(rows_of(5), SCHEMA))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
