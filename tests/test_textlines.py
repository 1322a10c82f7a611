import random
import re

import pytest

from obligato.sources import textlines as T


def walk(docs):
    """[(doc_id, page, pos, code, account, bureau, first amount)] by reading every document line by line."""
    out = []
    for doc, text in docs:
        meta = {}
        for page, body in enumerate(text.split("\f"), 1):
            for pos, line in enumerate(body.split("\n"), 1):
                line = line.strip(" \t\n\x0b\f\r")
                found = next(((k, m) for k, p in T.META_PATTERNS if (m := re.search(p, line, re.I))), None)
                if found:
                    meta[found[0]] = re.sub(r"\s+", " ", found[1].group(1).strip())
                elif m := re.match(T.LINE_PATTERN, line):
                    amounts = [float(x.replace(",", "")) for x in m.group(2).split() if re.match(T.AMOUNT_PATTERN, x)]
                    out.append((doc, page, pos, m.group(1), meta.get("budget_account"), meta.get("budget_bureau"), amounts[0] if amounts else 0.0))
    return out


@pytest.mark.parametrize(("seed", "lines"), [(1, 8192), (2, 5), (3, 1)])
def test_metadata_carries_over_pages_and_blocks(spark, seed, lines, monkeypatch):
    rng = random.Random(seed)
    monkeypatch.setattr(T.carry_forward, "__defaults__", (lines,))
    parts = ["BudgetAccount: Account {n}", "budgetbureau:  Bureau  {n}", "2490 Unobligated balance 1,{n:03d}.50 2 3 4", "2500 Resources {n}", "text", "", "\f", "\f\f"]
    docs = [(d, "\n".join(rng.choices(parts, weights=[1, 1, 6, 6, 3, 2, 2, 1], k=120)).format(n=0) if d == 0 else
             "\n".join(p.format(n=rng.randint(0, 99)) for p in rng.choices(parts, weights=[1, 1, 6, 6, 3, 2, 2, 1], k=200))) for d in range(12)]
    df = spark.createDataFrame(docs, "doc_id int, text string").repartition(3)
    items = T.extract_line_items(T.text_lines(df, page_break="\f")).collect()
    got = sorted((r.doc_id, r.page, r.pos, r.line_code, r.budget_account or "", r.budget_bureau or "", r.q1_amount) for r in items)
    assert got == sorted((*w[:4], w[4] or "", w[5] or "", w[6]) for w in walk(docs)) and max(g[1] for g in got) > 10
