"""Registered queries: line items from text.

``documents`` prose has no statement lines, so for it patterns are arguments chosen
to hit its common line openings: metadata lines start with Der / La / De /
In / To / Of (case-insensitive), line items with 'The' or 'And'. The quarter records read statement texts
made of ``lineitem`` (one per order, with amounts) through the published patterns.
"""

from __future__ import annotations

from ..sources import textlines as T
from ..sources.fixture import statement_texts, table
from . import oracle_sql as S
from .registry import register

META = [("budget_agency", r"^Der\s+(.+)"), ("budget_bureau", r"^La\s+(.+)"), ("budget_account", r"^De\s+(.+)"),
        ("treasury_account", r"^In\s+(.+)"), ("budget_account_id", r"^To\s+([^\s]+)"),
        ("treasury_account_id", r"^Of\s+(.+)")]
LINE = r"^(The|And)\s+(.+)"
AMT = T.AMOUNT_PATTERN


def _items_sql(source: str = "documents", META=META, LINE=LINE, before: str = "") -> str:
    kinds = " ".join(f"WHEN regexp_matches(line, {S.q('(?i)' + p)}) THEN {S.q(k)}" for k, p in META)
    vals = ", ".join(
        f"CASE WHEN _meta = {S.q(k)} THEN regexp_replace({S.strip(f'regexp_extract(line, {S.q(chr(40) + chr(63) + chr(105) + chr(41) + p)}, 1)')}, "
        f"'\\s+', ' ', 'g') END AS {k}" for k, p in META)
    cf = ", ".join(f"last_value({k} IGNORE NULLS) OVER w AS {k}" for k, _ in META)
    amounts = f"list_transform(list_filter(toks, lambda t: regexp_matches(t, {S.q(AMT)})), lambda t: TRY_CAST(replace(t, ',', '') AS DOUBLE))"
    qs = ", ".join(f"coalesce(({amounts})[{i + 1}], 0.0) AS {q}" for i, (q, _) in enumerate(T.QUARTER_MONTH))
    return f"""WITH {before} lines AS (
  SELECT doc_id, 1 AS page, CAST(pos AS INTEGER) AS pos, {S.strip('raw')} AS line FROM (
    SELECT doc_id, unnest(generate_series(1, len(string_split(text, chr(10))))) AS pos,
           unnest(string_split(text, chr(10))) AS raw FROM {source}) WHERE {S.strip('raw')} <> ''),
m AS (SELECT *, CASE {kinds} END AS _meta FROM lines),
v AS (SELECT *, {vals} FROM m),
cf AS (SELECT doc_id, page, pos, line, _meta, {cf} FROM v
       WINDOW w AS (PARTITION BY doc_id ORDER BY page, pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
it AS (SELECT *, string_split_regex({S.strip(f'regexp_extract(line, {S.q(LINE)}, 2)')}, '\\s+') AS toks
       FROM cf WHERE _meta IS NULL AND regexp_matches(line, {S.q(LINE)})),
items AS (SELECT doc_id, page, pos, regexp_extract(line, {S.q(LINE)}, 1) AS line_code,
  array_to_string(list_filter(toks, lambda t: NOT regexp_matches(t, {S.q(AMT)})), ' ') AS description,
  {qs}, {', '.join(k for k, _ in META)} FROM it)
"""


def _lines(spark, d):
    return T.text_lines(table(spark, d, "documents"))


@register("extract_line_items", _items_sql() + "SELECT * FROM items")
def q_extract_line_items(spark, d):
    """A10 + F2: line items with description, four amounts and carried-forward metadata."""
    return T.extract_line_items(_lines(spark, d), META, LINE, AMT)


@register("carry_forward", _items_sql() + """
SELECT doc_id, page, pos, _meta, budget_agency, budget_bureau, budget_account FROM cf""")
def q_carry_forward(spark, d):
    """metadata carried forward over every line of every document."""
    from pyspark.sql import functions as F
    lines = _lines(spark, d)
    kind = None
    for key, pat in META:
        cond = F.col("line").rlike(f"(?i){pat}")
        kind = F.when(cond, F.lit(key)) if kind is None else kind.when(cond, F.lit(key))
    st = lines.withColumn("_meta", kind)
    st = st.withColumns({k: F.when(F.col("_meta") == k, F.regexp_replace(
        T.strip_ws(F.regexp_extract(F.col("line"), f"(?i){p}", 1)), r"\s+", " ")) for k, p in META})
    cf = T.carry_forward(st, ["doc_id"], ["page", "pos"], [k for k, _ in META])
    return cf.select("doc_id", "page", "pos", "_meta", "budget_agency", "budget_bureau", "budget_account")


_STATEMENTS = """
sl AS (SELECT l_orderkey, CASE WHEN l_returnflag = 'N' THEN '2490' ELSE '2500' END AS code,
         [CAST(coalesce(sum(CAST(l_extendedprice AS DECIMAL(18,2))) FILTER (WHERE quarter(l_shipdate) = 1), 0) AS DOUBLE),
          CAST(coalesce(sum(CAST(l_extendedprice AS DECIMAL(18,2))) FILTER (WHERE quarter(l_shipdate) = 2), 0) AS DOUBLE),
          CAST(coalesce(sum(CAST(l_extendedprice AS DECIMAL(18,2))) FILTER (WHERE quarter(l_shipdate) = 3), 0) AS DOUBLE),
          CAST(coalesce(sum(CAST(l_extendedprice AS DECIMAL(18,2))) FILTER (WHERE quarter(l_shipdate) = 4), 0) AS DOUBLE)] AS a
       FROM lineitem GROUP BY 1, 2),
st2 AS (SELECT l_orderkey, string_agg(code || CASE WHEN code = '2490' THEN ' Unobligated balance, end of year ' ELSE ' Budgetary resources total ' END
         || format('{:,.2f} {:,.2f} {:,.2f} {:,.2f}', a[1], a[2], a[3], a[4]), chr(10) ORDER BY code) AS lines FROM sl GROUP BY 1),
statements AS (SELECT l.l_orderkey AS doc_id, 'BudgetAgency: Legislative' || CASE WHEN s_nationkey % 2 = 0 THEN 'Branch' ELSE '' END || chr(10)
         || 'BudgetBureau:  Bureau ' || s_nationkey || chr(10) || 'BudgetAccount: Account ' || l.l_orderkey || chr(10)
         || 'budgetaccountid: 01-' || lpad(s_nationkey::VARCHAR, 2, '0') || '-' || l.l_orderkey || chr(10) || 'page one of one' || chr(10) || lines AS text
       FROM (SELECT l_orderkey, min(l_suppkey) AS l_suppkey FROM lineitem GROUP BY 1) l
       JOIN supplier ON l_suppkey = s_suppkey JOIN st2 ON st2.l_orderkey = l.l_orderkey),"""
_PUBLISHED = _items_sql("statements", T.META_PATTERNS, T.LINE_PATTERN, _STATEMENTS)


@register("statement_line_items", _PUBLISHED + "SELECT * FROM items")
def q_statement_line_items(spark, d):
    """A10 + F2: line items of statement texts by the published patterns, with amounts."""
    return T.extract_line_items(T.text_lines(statement_texts(spark, d)))


_Q_SQL = _PUBLISHED + """
, keyed AS (SELECT doc_id, coalesce(budget_agency, '') AS budget_agency, coalesce(budget_bureau, '') AS budget_bureau,
     coalesce(budget_account, '') AS budget_account, coalesce(budget_account_id, '') AS budget_account_id,
     line_code, page, pos, q1_amount, q2_amount, q3_amount, q4_amount FROM items),
fu AS (SELECT doc_id, budget_agency, budget_bureau, budget_account, budget_account_id,
     arg_min([q1_amount, q2_amount, q3_amount, q4_amount], {'p': page, 'l': pos}) AS u FROM keyed WHERE line_code = '2490'
     GROUP BY 1, 2, 3, 4, 5),
fb AS (SELECT doc_id, budget_agency, budget_bureau, budget_account, budget_account_id,
     arg_min([q1_amount, q2_amount, q3_amount, q4_amount], {'p': page, 'l': pos}) AS b FROM keyed WHERE line_code = '2500'
     GROUP BY 1, 2, 3, 4, 5),
st AS (SELECT fu.*, fb.b, unnest(['Dec', 'Mar', 'Jun', 'Sep']) AS Month, unnest(u) AS unob, unnest(fb.b) AS ba
     FROM fu JOIN fb USING (doc_id, budget_agency, budget_bureau, budget_account, budget_account_id)),
k AS (SELECT *, CASE WHEN len(string_split(budget_account_id, '-')) >= 3
       THEN string_split(budget_account_id, '-')[2] || '-' || string_split(budget_account_id, '-')[3]
       ELSE budget_account_id END AS acct FROM st WHERE NOT (unob = 0 AND ba = 0))
SELECT doc_id, Month, 2017 AS Fiscal_Year,
  CASE WHEN budget_agency <> '' THEN replace(budget_agency, 'Branch', ' Branch') ELSE 'Legislative Branch' END AS Agency,
  budget_bureau AS Bureau, budget_account AS Account, acct AS Account_Number, 'No Year' AS Period_of_Performance,
  'No Year' AS Expiration_Year,
  CASE WHEN acct <> '' AND budget_account <> '' THEN acct || ' /X - ' || budget_account ELSE '' END AS TAFS,
  CASE WHEN unob <> 0 THEN '$' || format('{:.1f}', unob / 1e6::DOUBLE) || 'M' ELSE '$0.0M' END AS "Unobligated Balance (Line 2490)",
  CASE WHEN ba <> 0 THEN '$' || format('{:.1f}', ba / 1e6::DOUBLE) || 'M' ELSE '$0.0M' END AS "Budget Authority (Line 2500)",
  format('{:.1f}', CASE WHEN ba > 0 THEN unob / ba * 100.0 ELSE 0.0 END) || '%' AS "Percentage Unobligated"
FROM k"""


@register("quarter_records", _Q_SQL)
def q_quarter_records(spark, d):
    """Quarter records from the first unobligated and budget line per account group."""
    return T.quarter_records(T.extract_line_items(T.text_lines(statement_texts(spark, d))))
