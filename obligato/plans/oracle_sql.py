"""DuckDB oracle SQL: an independent SQL rendering of every registered query.

The driver runs each query's SQL on the same parquet tables (pre-registered
views) and compares row counts, schema and values. The CTE chain below
mirrors the ledger fixture, master build and summaries in plain SQL text.
Expression helpers return SQL strings; regexes use RE2 syntax with the 'g'
flag where Spark's regexp_replace is global.
"""

from __future__ import annotations

from ..functions.constants import (AGENCY_SPECIAL_CASES, CALENDAR_MONTHS, FISCAL_MONTHS,
                                   OIA, TARGET_AGENCIES)

WS = r"[ \t\n\x0B\f\r]"
BIG = 1 << 30


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def months_list(months=FISCAL_MONTHS) -> str:
    return "[" + ", ".join(q(m) for m in months) + "]"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def digits(x: str) -> str:
    return f"regexp_full_match({x}, '[0-9]+')"


def clean_text(x: str) -> str:
    s = f"replace(replace({x}, '_x000D_' || chr(10), ''), '_x000D_', '')"
    s = f"regexp_replace({s}, '\\r\\n|\\r|\\n', ' ', 'g')"
    return f"regexp_replace({strip(s)}, '{WS}+', ' ', 'g')"


def code_part(x: str) -> str:
    return strip(f"split_part({clean_text(x)}, ' - ', 1)")


def fy_bounds(x: str) -> tuple[str, str]:
    code = code_part(x)
    toks = f"string_split({code}, ' ')"
    last = f"({toks})[-1]"
    halves = f"string_split({last}, '/')"
    blank = f"({x} IS NULL OR {x} = '' OR len({toks}) < 2)"
    fy1 = (f"(CASE WHEN {blank} THEN '' WHEN starts_with({last}, '/') THEN '' "
           f"WHEN contains({last}, '/') AND len({halves}) = 2 THEN {strip(f'({halves})[1]')} ELSE '' END)")
    fy2 = (f"(CASE WHEN {blank} THEN '' WHEN starts_with({last}, '/') THEN {strip(f'substr({last}, 2)')} "
           f"WHEN contains({last}, '/') AND len({halves}) = 2 THEN {strip(f'({halves})[2]')} ELSE '' END)")
    return fy1, fy2


def alloc(x: str) -> str:
    code = code_part(x)
    account = (f"(CASE WHEN contains({code}, ' /') THEN {strip(f'split_part({code}, {q(chr(32) + chr(47))}, 1)')} "
               f"WHEN contains({code}, ' ') THEN split_part({code}, ' ', 1) ELSE {code} END)")
    pieces = f"string_split({account}, '-')"
    return (f"(CASE WHEN {x} IS NULL OR {x} = '' THEN '' WHEN len({pieces}) >= 3 THEN {strip(f'({pieces})[2]')} "
            f"WHEN len({pieces}) = 2 THEN {strip(f'({pieces})[1]')} ELSE '' END)")


def normalize(x: str) -> str:
    s = strip(f"coalesce(CAST({x} AS VARCHAR), '')")
    d = f"TRY_CAST({s} AS DOUBLE)"
    as_int = (f"(CASE WHEN contains({s}, '.') AND {d} IS NOT NULL AND {d} = floor({d}) AND abs({d}) < 1e15 "
              f"THEN CAST(CAST(floor({d}) AS BIGINT) AS VARCHAR) ELSE {s} END)")
    padded = (f"(CASE WHEN {digits(as_int)} AND length({as_int}) <= 2 "
              f"THEN lpad(CAST(CAST({as_int} AS BIGINT) AS VARCHAR), 2, '0') "
              f"WHEN upper({as_int}) = 'X' THEN 'X' ELSE {as_int} END)")
    return f"(CASE WHEN {s} = '' OR {s} = 'nan' THEN '' ELSE {padded} END)"


def year_full(y: str) -> str:
    return f"(CASE WHEN length({y}) = 2 THEN '20' || {y} ELSE {y} END)"


def components(t: str, agency: str) -> tuple[str, str, str]:
    """B11 as three SQL expressions (account_number, period, expiration)."""
    # standard grammar
    head = f"split_part({t}, ' - ', 1)"
    code = f"split_part({head}, ' ', 1)"
    yp = strip(f"(CASE WHEN contains({head}, ' ') THEN substr({head}, instr({head}, ' ') + 1) ELSE '' END)")
    pieces = f"string_split({code}, '-')"
    acct = f"(CASE WHEN len({pieces}) >= 2 THEN array_to_string(({pieces})[1:3], '-') ELSE '' END)"
    yv = f"substr({yp}, 2)"
    halves = f"string_split({yp}, '/')"
    a, b = f"({halves})[1]", f"({halves})[2]"
    two = f"len({halves}) = 2"
    bd = f"({two} AND {digits(a)} AND {digits(b)})"
    ax = f"({two} AND {b} = 'X')"
    lead = f"starts_with({yp}, '/')"
    per = (f"(CASE WHEN NOT contains({yp}, '/') THEN '' WHEN {lead} AND {yv} = 'X' THEN 'No Year' "
           f"WHEN {lead} AND {digits(yv)} THEN 'FY20' || {yv} WHEN {lead} THEN '' "
           f"WHEN {bd} THEN 'FY' || {year_full(a)} || '-FY' || {year_full(b)} "
           f"WHEN {ax} THEN 'FY' || {year_full(a)} || '-No Year' ELSE '' END)")
    exp = (f"(CASE WHEN NOT contains({yp}, '/') THEN '' WHEN {lead} AND {yv} = 'X' THEN 'No Year' "
           f"WHEN {lead} AND {digits(yv)} THEN '20' || {yv} WHEN {lead} THEN '' "
           f"WHEN {bd} THEN {year_full(b)} WHEN {ax} THEN 'No Year' ELSE '' END)")
    # whitespace-token grammar (Other Independent Agencies)
    ohead = strip(f"split_part({t}, ' - ', 1)")
    toks = f"regexp_split_to_array({ohead}, '{WS}+')"
    oacct = f"(CASE WHEN {ohead} = '' THEN '' ELSE ({toks})[1] END)"
    oyp = f"(CASE WHEN len({toks}) >= 2 THEN ({toks})[2] ELSE '' END)"
    oyv = f"substr({oyp}, 2)"
    oh = f"string_split({oyp}, '/')"
    oa, ob = f"({oh})[1]", f"({oh})[2]"
    obd = f"(len({oh}) = 2 AND {digits(oa)} AND {digits(ob)})"
    olead = f"starts_with({oyp}, '/')"
    oper = (f"(CASE WHEN {oyp} = '/X' THEN 'No Year' WHEN NOT contains({oyp}, '/') THEN '' "
            f"WHEN {olead} AND {digits(oyv)} THEN 'FY20' || {oyv} WHEN {olead} THEN '' "
            f"WHEN {obd} THEN 'FY' || {year_full(oa)} || '-FY' || {year_full(ob)} ELSE '' END)")
    oexp = (f"(CASE WHEN {oyp} = '/X' THEN 'No Year' WHEN NOT contains({oyp}, '/') THEN '' "
            f"WHEN {olead} AND {digits(oyv)} THEN '20' || {oyv} WHEN {olead} THEN '' "
            f"WHEN {obd} THEN {year_full(ob)} ELSE '' END)")
    blank = f"({t} IS NULL OR {t} = '')"
    oia = f"({agency} = {q(OIA)})"
    pick = lambda s, o: f"(CASE WHEN {blank} THEN '' WHEN coalesce({oia}, false) THEN {o} ELSE {s} END)"
    return pick(acct, oacct), pick(per, oper), pick(exp, oexp)


def account_name(t: str) -> str:
    return f"(CASE WHEN instr({t}, ' - ') > 0 THEN substr({t}, instr({t}, ' - ') + 3) ELSE '' END)"


def canonical_agency(a: str) -> str:
    norm = f"lower(replace({a}, '--', '-'))"
    special = {t: (alls, anys) for t, alls, anys in AGENCY_SPECIAL_CASES}
    parts = [f"WHEN {a} IS NULL THEN 'Unknown Agency'"]
    for target in TARGET_AGENCIES:
        cond = f"contains({norm}, {q(target.lower())})"
        if target in special:
            alls, anys = special[target]
            s = " AND ".join(f"contains({norm}, {q(x)})" for x in alls)
            if anys:
                s += " AND (" + " OR ".join(f"contains({norm}, {q(x)})" for x in anys) + ")"
            cond = f"({cond} OR ({s}))"
        parts.append(f"WHEN {cond} THEN {q(target)}")
    return "(CASE " + " ".join(parts) + f" ELSE {strip(a)} END)"


def round1(x: str, n: int = 1) -> str:
    return f"CAST(replace(format('{{:,.{n}f}}', {x}), ',', '') AS DOUBLE)"


def fmt_money(x: str, grouping: bool = True) -> str:
    spec = "{:,.1f}" if grouping else "{:.1f}"
    return f"('$' || format('{spec}', {x}) || 'M')"


def fmt_pct(x: str) -> str:
    return f"(format('{{:.1f}}', {x}) || '%')"


def fmt_fixed(x: str, n: int) -> str:
    return f"format('{{:.{n}f}}', {x})"


def pct_account(u: str, b: str) -> str:
    return f"(CASE WHEN {b} = 0 THEN (CASE WHEN {u} = 0 THEN 0.0 ELSE 100.0 END) ELSE {u} / {b} * 100.0 END)"


def pct_rollup(u: str, b: str) -> str:
    return f"(CASE WHEN {b} > 0 THEN {u} / {b} * 100.0 ELSE 0.0 END)"


def month_ord(m: str) -> str:
    return f"CAST(list_position({months_list()}, {m}) AS INTEGER)"


def exact_sum(x: str, scale: int = 1) -> str:
    return f"CAST(sum(CAST({x} AS DECIMAL(38,{scale}))) AS DOUBLE)"


def unnest_months(prefix: str = "") -> str:
    return (f"unnest({months_list()}) AS month, "
            f"unnest([{', '.join(prefix + m for m in FISCAL_MONTHS)}]) AS value")


# ---------------------------------------------------------------- CTE chain

_CAL = "[" + ", ".join(q(m) for m in CALENDAR_MONTHS) + "]"

CTES: dict[str, tuple[list[str], str]] = {}


def cte(name: str, deps: list[str], body: str) -> None:
    CTES[name] = (deps, body)


cte("ledger_base", [], """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_shipdate, l.l_extendedprice,
       l.l_returnflag, o.o_orderpriority, n.n_nationkey, n.n_name, r.r_regionkey, r.r_name,
       p.p_brand, p.p_size,
       CAST(year(l.l_shipdate) + CASE WHEN month(l.l_shipdate) >= 10 THEN 1 ELSE 0 END + 20 AS INTEGER) AS fy
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation n ON s.s_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
JOIN part p ON l.l_partkey = p.p_partkey""")

cte("ledger_k", ["ledger_base"], """
SELECT *, lpad(CAST(fy % 100 AS VARCHAR), 2, '0') AS yy,
       lpad(CAST((fy - 1) % 100 AS VARCHAR), 2, '0') AS yy1,
       lpad(CAST(r_regionkey + 10 AS VARCHAR), 3, '0') AS agency_code,
       lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS nation_code,
       (p_size % 2 = 0) AS even, substr(o_orderpriority, 1, 1) AS prio
FROM ledger_base""")

cte("ledger_g", ["ledger_k"], """
SELECT *, CASE WHEN prio = '3' THEN yy1 WHEN prio = '4' THEN yy END AS g_fy1,
       CASE WHEN prio IN ('1', '4') THEN 'X' WHEN prio IN ('2', '3') THEN yy END AS g_fy2
FROM ledger_k""")

cte("ledger", ["ledger_g"], f"""
SELECT fy AS fiscal_year, {_CAL}[month(l_shipdate)] AS month, CASE WHEN l_linenumber <> 1 THEN r_name END AS AGENCY,
       r_name AS AGENCY_TITLE, CASE WHEN l_linenumber <> 7 THEN n_name END AS BUREAU, 'Bureau of ' || n_name AS BUREAU_TITLE,
       agency_code || '-' || p_brand AS OMB_ACCT, agency_code || '-' || nation_code || '   ' || p_brand || ' Commission' AS OMB_ACCOUNT,
       CASE WHEN p_size = 1 THEN '1' ELSE '0' END AS TRAG, '0' AS TRACCT,
       CASE WHEN l_linenumber > 2 THEN 'Line ' || CASE WHEN l_returnflag = 'N' THEN '2490' WHEN l_returnflag = 'R' THEN '2500'
            WHEN l_linenumber = 3 THEN NULL ELSE 'n/a' END END AS LINE_DESC,
       agency_code || CASE WHEN even THEN '-' || nation_code ELSE '' END || '-'
         || lpad(string_split(p_brand, '#')[-1], 4, '0')
         || CASE prio WHEN '1' THEN ' /X' WHEN '2' THEN ' /' || yy WHEN '3' THEN ' ' || yy1 || '/' || yy
                      WHEN '4' THEN ' ' || yy || '/X' ELSE '' END
         || ' - ' || p_brand AS TAFS,
       CASE WHEN l_returnflag = 'N' THEN '2490' WHEN l_returnflag = 'R' THEN '2500'
            WHEN l_linenumber = 1 THEN '1000' WHEN l_linenumber = 2 THEN '0999'
            WHEN l_linenumber = 3 THEN NULL ELSE 'n/a' END AS LINENO,
       CASE WHEN l_linenumber % 2 = 0 AND g_fy1 IS NOT NULL THEN g_fy1 || '.0' ELSE g_fy1 END AS FY1,
       CASE WHEN r_regionkey = 4 AND fy = 2016 AND p_size = 50 AND g_fy2 IS NOT NULL THEN '00' ELSE g_fy2 END AS FY2,
       CASE WHEN even THEN CAST(n_nationkey AS VARCHAR) ELSE agency_code END AS ALLOC,
       CAST(l_extendedprice AS DECIMAL(18,2)) AS amount,
       r_name || '_' || CAST(fy AS VARCHAR) AS Source_File,
       l_orderkey * 8 + l_linenumber AS ordinal
FROM ledger_g""")

cte("ledger_files", ["ledger"], "SELECT DISTINCT Source_File, AGENCY_TITLE FROM ledger")

cte("unit_notes", ["ledger_files"], """
SELECT Source_File, 1 AS row, 'Report on Budget Execution and Budgetary Resources' AS text FROM ledger_files
UNION ALL SELECT Source_File, 2, 'Agency: ' || AGENCY_TITLE FROM ledger_files
UNION ALL SELECT Source_File, 3, CASE WHEN AGENCY_TITLE < 'B' THEN '(Amounts in Thousands)' ELSE '(Amounts in Dollars)' END
          FROM ledger_files
UNION ALL SELECT Source_File, 6, 'see thousand-dollar rounding note' FROM ledger_files""")

cte("units", ["unit_notes"], """
SELECT Source_File, max(CASE WHEN contains(lower(text), 'thousand') THEN 1000 ELSE 1 END) AS unit_multiplier
FROM unit_notes WHERE row <= 5 GROUP BY Source_File""")

cte("scaled", ["ledger", "units"], """
SELECT l.* REPLACE (CAST(l.amount * coalesce(u.unit_multiplier, 1) AS DECIMAL(18,2)) AS amount)
FROM ledger l LEFT JOIN units u USING (Source_File)""")

cte("file_agency", ["scaled"], f"""
SELECT Source_File, {canonical_agency('first_agency')} AS Agency FROM (
  SELECT Source_File, arg_min(AGENCY, ordinal) FILTER (WHERE AGENCY IS NOT NULL) AS first_agency
  FROM scaled GROUP BY Source_File)""")

_FY1, _FY2 = fy_bounds("TAFS")

cte("std", ["scaled"], f"""
SELECT *, {_FY1} AS DERIVED_FY1, {_FY2} AS DERIVED_FY2, {alloc('TAFS')} AS DERIVED_ALLOC
FROM scaled WHERE TRY_CAST(LINENO AS DOUBLE) BETWEEN 1000 AND 9999""")

cte("rates", ["std"], f"""
SELECT Source_File, count(*) AS rows,
  count(*) FILTER (WHERE {normalize('FY1')} <> '') AS fy1_tested,
  count(*) FILTER (WHERE {normalize('FY1')} <> '' AND {normalize('FY1')} = {normalize('DERIVED_FY1')}) AS fy1_matched,
  count(*) FILTER (WHERE {normalize('FY2')} <> '') AS fy2_tested,
  count(*) FILTER (WHERE {normalize('FY2')} <> '' AND {normalize('FY2')} = {normalize('DERIVED_FY2')}) AS fy2_matched,
  count(*) FILTER (WHERE {normalize('ALLOC')} <> '') AS alloc_tested,
  count(*) FILTER (WHERE {normalize('ALLOC')} <> '' AND {normalize('ALLOC')} = {normalize('DERIVED_ALLOC')}) AS alloc_matched
FROM std GROUP BY Source_File""")

cte("rejected", ["rates"], """
SELECT Source_File FROM rates
WHERE fy1_matched < fy1_tested OR fy2_matched < fy2_tested OR alloc_matched < alloc_tested""")

cte("kept", ["std", "rejected"], """
SELECT * FROM std
WHERE Source_File NOT IN (SELECT Source_File FROM rejected)
  AND BUREAU IS NOT NULL AND OMB_ACCT IS NOT NULL AND LINENO IS NOT NULL""")

_MONTH_AGGS = ",\n  ".join(
    f"CAST(coalesce(sum(amount) FILTER (WHERE month = {q(m)}), 0) AS DECIMAL(38,2)) AS {m}" for m in FISCAL_MONTHS)

_FIRSTS = ",\n  ".join(f"arg_min({c}, ordinal) FILTER (WHERE {c} IS NOT NULL) AS {c}"
                       for c in ("TAFS", "AGENCY_TITLE", "BUREAU_TITLE", "OMB_ACCOUNT", "LINE_DESC"))

cte("master_raw", ["kept"], f"""
SELECT fiscal_year, Source_File, BUREAU, OMB_ACCT, LINENO, DERIVED_FY1, DERIVED_FY2, DERIVED_ALLOC, TRACCT, TRAG,
  {_MONTH_AGGS},
  {_FIRSTS},
  count(*) AS source_rows
FROM kept
GROUP BY fiscal_year, Source_File, BUREAU, OMB_ACCT, LINENO, DERIVED_FY1, DERIVED_FY2, DERIVED_ALLOC, TRACCT, TRAG""")

cte("master", ["master_raw", "file_agency"], f"""
SELECT m.* REPLACE ({', '.join(clean_text('m.' + c) + ' AS ' + c for c in ('TAFS', 'BUREAU', 'AGENCY_TITLE', 'BUREAU_TITLE', 'OMB_ACCOUNT', 'LINE_DESC'))}),
  fa.Agency
FROM master_raw m JOIN file_agency fa USING (Source_File)""")

cte("master_long", ["master"], f"""
SELECT fiscal_year, Source_File, Agency, BUREAU, TAFS, LINENO, {unnest_months()} FROM master""")

cte("month_flags", ["master_long"], f"""
SELECT fiscal_year, month, {month_ord('month')} AS month_ord,
       bool_or(value IS NOT NULL) AND bool_or(coalesce(value <> 0, true)) AS has_data,
       count(*) FILTER (WHERE value IS NOT NULL AND value <> 0) AS nonzero_count,
       CAST(sum(value) AS DOUBLE) AS total
FROM master_long GROUP BY fiscal_year, month""")

cte("avail", ["month_flags"], "SELECT fiscal_year, month, month_ord FROM month_flags WHERE has_data")

cte("latest", ["avail"], f"""
SELECT fiscal_year, arg_max(month, month_ord) AS month, max(month_ord) AS month_ord FROM avail GROUP BY fiscal_year""")

_STD_AGENCY = f"(Agency <> {q(OIA)} OR Agency IS NULL)"

cte("u_long", ["master_long"], f"""
SELECT fiscal_year, month, Agency, TAFS, BUREAU, value FROM master_long
WHERE TRY_CAST(LINENO AS DOUBLE) = 2490 AND {_STD_AGENCY}""")

cte("b_long", ["master_long"], f"""
SELECT fiscal_year, month, Agency, TAFS, value FROM master_long
WHERE TRY_CAST(LINENO AS DOUBLE) = 2500 AND {_STD_AGENCY}""")


def _pairs_body(months_cte: str) -> str:
    return f"""
SELECT u.fiscal_year, u.month, u.Agency, u.TAFS, u.BUREAU, u.value AS value_2490, b.value AS value_2500
FROM u_long u
JOIN b_long b ON u.fiscal_year = b.fiscal_year AND u.month = b.month
  AND u.Agency IS NOT DISTINCT FROM b.Agency AND u.TAFS IS NOT DISTINCT FROM b.TAFS
JOIN {months_cte} mm ON u.fiscal_year = mm.fiscal_year AND u.month = mm.month"""


cte("pairs_all", ["u_long", "b_long", "avail"], _pairs_body("avail"))
cte("pairs_latest", ["u_long", "b_long", "latest"], _pairs_body("latest"))

_ACC, _PER, _EXP = components("TAFS", "Agency")


def _summary_body(pairs_cte: str, near_zero: bool, null_text: str) -> str:
    where = "WHERE NOT coalesce(abs(unob) < 0.001 AND abs(ba) < 0.001, false)" if near_zero else ""
    return f"""
SELECT Month, Fiscal_Year, Agency, Bureau, Account, Account_Number, Period_of_Performance, Expiration_Year, TAFS,
  Unobligated_Balance_M, Budget_Authority_M, Percentage_Unobligated,
  coalesce({fmt_money('Unobligated_Balance_M')}, {q(null_text)}) AS "Unobligated Balance (Line 2490)",
  coalesce({fmt_money('Budget_Authority_M')}, {q(null_text)}) AS "Budget Authority (Line 2500)",
  coalesce({fmt_pct('Percentage_Unobligated')}, {q(null_text)}) AS "Percentage Unobligated"
FROM (
  SELECT month AS Month, fiscal_year AS Fiscal_Year, Agency, coalesce(BUREAU, '') AS Bureau,
    {account_name('TAFS')} AS Account, {_ACC} AS Account_Number, {_PER} AS Period_of_Performance,
    {_EXP} AS Expiration_Year, TAFS, unob, ba,
    {round1('unob')} AS Unobligated_Balance_M, {round1('ba')} AS Budget_Authority_M,
    {round1(pct_account('unob', 'ba'))} AS Percentage_Unobligated
  FROM (SELECT *, CAST(value_2490 AS DOUBLE) / CAST(1000000 AS DOUBLE) AS unob,
               CAST(value_2500 AS DOUBLE) / CAST(1000000 AS DOUBLE) AS ba FROM {pairs_cte}) p
  {where})"""


cte("monthly", ["pairs_all"], _summary_body("pairs_all", True, ""))
cte("yearly", ["pairs_latest"], _summary_body("pairs_latest", False, "0.0"))


def with_ctes(*names: str, extra: list[tuple[str, str]] | None = None) -> str:
    """WITH clause holding the named CTEs and their dependencies in order,
    followed by ``extra`` (name, body) CTEs."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][0]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    parts = [f"{n} AS ({CTES[n][1].strip()})" for n in order]
    parts += [f"{n} AS ({body.strip()})" for n, body in (extra or [])]
    return "WITH " + ",\n".join(parts) + "\n"
