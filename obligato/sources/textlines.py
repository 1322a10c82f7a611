"""Line-item extraction from page-ordered text.

Documents are split into numbered lines (``posexplode``); metadata lines are
recognised by an ordered list of patterns; values carry forward to later
lines and pages in two levels, within blocks of lines and from block to block, so that
a long document is not one task. Line items split their tokens into amounts and description words
with array higher-order functions — no Python per row.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import WS, strip_ws
from ..operators.blocks import scan_blocks

META_KEYS = ["budget_agency", "budget_bureau", "budget_account", "treasury_account",
             "budget_account_id", "treasury_account_id"]
# FIXED VALUES — published patterns for statement text.
META_PATTERNS = [
    ("budget_agency", r"BudgetAgency:\s*(.+)"),
    ("budget_bureau", r"BudgetBureau:\s*(.+)"),
    ("budget_account", r"BudgetAccount:\s*(.+)"),
    ("treasury_account", r"TreasuryAccount:\s*(.+)"),
    ("budget_account_id", r"BudgetAccountID:\s*([^\s]+)"),
    ("treasury_account_id", r"TreasuryAccountID:\s*(.+)"),
]
#: Positions of a page that are one block of the carry-forward.
BLOCK_LINES = 8192
LINE_PATTERN = r"^(249[0-9]|250[0-9])\s+(.+)"
AMOUNT_PATTERN = r"^-?\d{1,3}(,\d{3})*(\.\d+)?$"
QUARTER_MONTH = [("q1_amount", "Dec"), ("q2_amount", "Mar"), ("q3_amount", "Jun"), ("q4_amount", "Sep")]


def text_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", page_break: str | None = None) -> DataFrame:
    """(doc_id, page, pos, line): stripped, non-empty lines in order. Pages, numbered from 1, end at ``page_break``
    (a form feed in extracted text); without one a document is one page."""
    x = docs.select(F.col(id_col).alias("doc_id"), F.lit(0).alias("page"), F.col(text_col).alias("text"))
    if page_break is not None:
        x = x.select("doc_id", F.posexplode(F.split("text", re.escape(page_break))).alias("page", "text"))
    x = x.select("doc_id", "page", F.posexplode(F.split("text", "\n")).alias("pos", "raw"))
    return (x.select("doc_id", (F.col("page") + 1).alias("page"), (F.col("pos") + 1).alias("pos"),
                     strip_ws(F.col("raw")).alias("line"))
            .where(F.col("line") != ""))


def carry_forward(df: DataFrame, part: list[str], order: list[str], cols: list[str], block_lines: int = BLOCK_LINES) -> DataFrame:
    """each column takes the last non-null value at or before the row, by ``order`` (page and position) within ``part``.

    Rows meet in blocks of ``block_lines`` positions of a page; the blocks' last values are carried from one to the next."""
    page, pos = order
    block = F.col(page).cast("long") * (1 << 32) + F.floor(F.col(pos) / block_lines)
    kept = df.withColumn("_block", block).withColumnsRenamed({c: f"_old_{c}" for c in cols})
    out = scan_blocks(kept, part, "_block", pos, lasts={c: F.col(f"_old_{c}") for c in cols})
    return out.select(*df.columns)


def extract_line_items(lines: DataFrame, meta_patterns=META_PATTERNS, line_pattern: str = LINE_PATTERN,
                       amount_pattern: str = AMOUNT_PATTERN) -> DataFrame:
    """A10: metadata lines (first matching pattern, case-insensitive) set the
    current metadata; other lines matching ``line_pattern`` are line items
    with description words and the first four amounts (missing -> 0.0)."""
    kind = None
    for key, pat in meta_patterns:
        cond = F.col("line").rlike(f"(?i){pat}")
        kind = F.when(cond, F.lit(key)) if kind is None else kind.when(cond, F.lit(key))
    # other lines neither set metadata nor become items
    staged = lines.withColumn("_meta", kind).where(F.col("_meta").isNotNull() | F.col("line").rlike(line_pattern))
    vals = {}
    for key, pat in meta_patterns:
        v = F.regexp_replace(strip_ws(F.regexp_extract(F.col("line"), f"(?i){pat}", 1)), r"\s+", " ")
        vals[key] = F.when(F.col("_meta") == key, v)
    staged = carry_forward(staged.withColumns(vals), ["doc_id"], ["page", "pos"], [k for k, _ in meta_patterns])
    items = staged.where(F.col("_meta").isNull() & F.col("line").rlike(line_pattern))
    data = strip_ws(F.regexp_extract(F.col("line"), line_pattern, 2))
    items = items.withColumn("_toks", F.split(data, r"\s+"))
    toks, amounts = F.col("_toks"), F.col("_amounts")
    items = items.withColumn("_amounts", F.transform(F.filter(toks, lambda t: t.rlike(amount_pattern)),
                                                     lambda t: F.replace(t, F.lit(","), F.lit("")).try_cast("double")))
    out = items.select(
        "doc_id", "page", "pos",
        F.regexp_extract(F.col("line"), line_pattern, 1).alias("line_code"),
        F.array_join(F.filter(toks, lambda t: ~t.rlike(amount_pattern)), " ").alias("description"),
        *[F.coalesce(F.try_element_at(amounts, F.lit(i + 1)), F.lit(0.0)).alias(q) for i, (q, _) in enumerate(QUARTER_MONTH)],
        *[F.col(k) for k, _ in meta_patterns])
    return out


def rebuild_account_id(c):
    """B23: 'a-b-c...' -> 'b-c'; shorter ids kept."""
    parts = F.split(c, "-")
    return F.when(F.size(parts) >= 3, F.concat(F.element_at(parts, 2), F.lit("-"), F.element_at(parts, 3))).otherwise(c)


def quarter_records(items: DataFrame, unob_code: str = "2490", ba_code: str = "2500",
                    fiscal_year: int = 2017, default_agency: str = "Legislative Branch") -> DataFrame:
    """E24 + B23 + B17c: per (document, agency, bureau, account, account id) the
    first unobligated and first budget line; groups lacking either are
    skipped; four quarter rows (Dec/Mar/Jun/Sep), both-zero quarters skipped."""
    keys = ["doc_id", "budget_agency", "budget_bureau", "budget_account", "budget_account_id"]
    it = items.where(F.col("doc_id").isNotNull() & F.col("line_code").isin(unob_code, ba_code))
    it = it.withColumns({k: F.coalesce(F.col(k), F.lit("")) for k in keys[1:]})
    order = F.struct("page", "pos")
    q = F.struct(*[F.col(c) for c, _ in QUARTER_MONTH])

    def first(code):
        return F.min_by(q, F.when(F.col("line_code") == code, order))
    # one pass for both lines; a group without one of them has a null there
    j = it.groupBy(*keys).agg(first(unob_code).alias("u"), first(ba_code).alias("b")).where("u IS NOT NULL AND b IS NOT NULL")
    stacked = j.select(*keys, F.explode(F.array(*[
        F.struct(F.lit(m).alias("Month"), F.col(f"u.{c}").alias("unob"), F.col(f"b.{c}").alias("ba"))
        for c, m in QUARTER_MONTH])).alias("r")).select(*keys, "r.*")
    kept = stacked.where(~((F.col("unob") == 0) & (F.col("ba") == 0)))
    pct = F.when(F.col("ba") > 0, F.col("unob") / F.col("ba") * F.lit(100.0)).otherwise(F.lit(0.0))
    acct_id = rebuild_account_id(F.col("budget_account_id"))

    def money(c):
        return F.when(F.col(c) != 0, F.concat(F.lit("$"), F.replace(F.format_number(F.col(c) / F.lit(1e6), 1),
                                                                    F.lit(","), F.lit("")), F.lit("M"))
                      ).otherwise(F.lit("$0.0M"))
    return kept.select(
        "doc_id", "Month", F.lit(fiscal_year).alias("Fiscal_Year"),
        F.when(F.col("budget_agency") != "", F.replace(F.col("budget_agency"), F.lit("Branch"), F.lit(" Branch")))
        .otherwise(F.lit(default_agency)).alias("Agency"),
        F.col("budget_bureau").alias("Bureau"), F.col("budget_account").alias("Account"),
        acct_id.alias("Account_Number"),
        F.lit("No Year").alias("Period_of_Performance"), F.lit("No Year").alias("Expiration_Year"),
        F.when((acct_id != "") & (F.col("budget_account") != ""),
               F.concat(acct_id, F.lit(" /X - "), F.col("budget_account"))).otherwise(F.lit("")).alias("TAFS"),
        money("unob").alias("Unobligated Balance (Line 2490)"),
        money("ba").alias("Budget Authority (Line 2500)"),
        F.concat(F.replace(F.format_number(pct, 1), F.lit(","), F.lit("")), F.lit("%")).alias("Percentage Unobligated"))
