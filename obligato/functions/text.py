"""Account-symbol grammars and text clean-up as built-in Column expressions.

Every function returns a Column made of JVM-side functions only (btrim,
substring_index, split, when chains), so it stays inside whole-stage codegen.
The grammars read a *prepared* input (the cleaned code part of a symbol);
the ``with_*`` DataFrame helpers compute that input once in its own
projection, so the heavy part is not re-evaluated inside every CASE branch.
Empty results are '' (never NULL) where the published grammar yields ''.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .constants import AGENCY_SPECIAL_CASES, OIA, TARGET_AGENCIES

WS_CHARS = " \t\n\x0b\f\r"
WS = r"[ \t\n\x0B\f\r]"
REST_LEN = 1 << 30


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c) -> Column:
    """Python str.strip(): remove leading/trailing whitespace."""
    return F.btrim(_c(c), F.lit(WS_CHARS))


def is_digits(c) -> Column:
    """Python str.isdigit() for ASCII text ('' is False)."""
    return _c(c).rlike("^[0-9]+$")


NUMERIC_RE = r"^[ \t\n\x0B\f\r]*[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?[ \t\n\x0B\f\r]*$"


def to_number(c) -> Column:
    """Lenient text -> double (NULL when not numeric). The regex guard keeps
    non-numeric text away from the cast, whose failure path is costly."""
    return F.when(_c(c).rlike(NUMERIC_RE), _c(c).try_cast("double"))


def count_char(c, ch: str) -> Column:
    return F.length(_c(c)) - F.length(F.replace(_c(c), F.lit(ch), F.lit("")))


def after_first(c, sep: str) -> Column:
    """Text after the first ``sep`` ('' when absent)."""
    c = _c(c)
    return F.when(F.instr(c, sep) > 0, F.substring(c, F.instr(c, sep) + len(sep), F.lit(REST_LEN))).otherwise(F.lit(""))


def clean_text(c) -> Column:
    """Drop _x000D_ markers, CR/LF and whitespace runs to one space, strip.
    NULL stays NULL."""
    s = F.replace(F.replace(_c(c), F.lit("_x000D_\n"), F.lit("")), F.lit("_x000D_"), F.lit(""))
    return F.btrim(F.regexp_replace(s, f"{WS}+", " "), F.lit(" "))


def code_part(c) -> Column:
    """Cleaned symbol text before the first ' - ' ('' for NULL)."""
    return F.coalesce(strip_ws(F.substring_index(clean_text(c), " - ", 1)), F.lit(""))


# ------------------------------------------------------------ B8 / B9

def fy_bounds_from_code(code) -> Column:
    """B8 on a prepared code part: (fy1, fy2) from the last space-separated token.
    '/X' -> ('', 'X'); '/yy' -> ('', yy); 'a/b' -> (a, b); else ('', '')."""
    code = _c(code)
    last = F.substring_index(code, " ", -1)
    two_tokens = code.contains(" ")
    lead = last.startswith("/")
    one_slash = count_char(last, "/") == 1
    fy1 = (F.when(~two_tokens | lead, F.lit(""))
           .when(one_slash, strip_ws(F.substring_index(last, "/", 1)))
           .otherwise(F.lit("")))
    fy2 = (F.when(~two_tokens, F.lit(""))
           .when(lead, strip_ws(F.substring(last, F.lit(2), F.lit(REST_LEN))))
           .when(one_slash, strip_ws(F.substring_index(last, "/", -1)))
           .otherwise(F.lit("")))
    return F.struct(fy1.alias("fy1"), fy2.alias("fy2"))


def alloc_from_code(code) -> Column:
    """B9 on a prepared code part: middle piece of a 3-part account, first of a 2-part one."""
    code = _c(code)
    account = (F.when(code.contains(" /"), strip_ws(F.substring_index(code, " /", 1)))
               .when(code.contains(" "), F.substring_index(code, " ", 1))
               .otherwise(code))
    dashes = count_char(account, "-")
    return (F.when(dashes >= 2, strip_ws(F.substring_index(F.substring_index(account, "-", 2), "-", -1)))
            .when(dashes == 1, strip_ws(F.substring_index(account, "-", 1)))
            .otherwise(F.lit("")))


def tafs_fy_bounds(c) -> Column:
    """B8 on a raw symbol (single-use convenience)."""
    return fy_bounds_from_code(code_part(c))


def tafs_alloc(c) -> Column:
    """B9 on a raw symbol (single-use convenience)."""
    return alloc_from_code(code_part(c))


def with_derived_codes(df: DataFrame, tafs: str = "TAFS") -> DataFrame:
    """DERIVED_FY1/FY2/ALLOC with the cleaned code part computed once."""
    staged = df.withColumn("_code", code_part(F.col(tafs)))
    b = fy_bounds_from_code(F.col("_code"))
    return (staged.withColumns({"DERIVED_FY1": b["fy1"], "DERIVED_FY2": b["fy2"],
                                "DERIVED_ALLOC": alloc_from_code(F.col("_code"))})
            .drop("_code"))


# ------------------------------------------------------------ B10

def normalize_stripped(s) -> Column:
    """B10 on an already stripped, non-NULL text."""
    s = _c(s)
    d = to_number(s)
    as_int = F.when(s.contains(".") & (d == F.floor(d)) & (F.abs(d) < 1e15),
                    F.floor(d).cast("bigint").cast("string")).otherwise(s)
    padded = (F.when(is_digits(as_int) & (F.length(as_int) <= 2),
                     F.lpad(as_int.cast("bigint").cast("string"), 2, "0"))
              .when(F.upper(as_int) == "X", F.lit("X"))
              .otherwise(as_int))
    return F.when((s == "") | (s == "nan"), F.lit("")).otherwise(padded)


def normalize_code(c) -> Column:
    """B10: '12.0'->'12', 1-2 digit codes zero-padded to 2, 'x'->'X', NULL/'nan'->''."""
    return normalize_stripped(strip_ws(F.coalesce(_c(c).cast("string"), F.lit(""))))


def with_normalized(df: DataFrame, cols: dict[str, str]) -> DataFrame:
    """B10 for several columns ({output: input}); the stripped text, its numeric
    parse and the integral form are each staged once."""
    st = df.withColumns({f"_s_{o}": strip_ws(F.coalesce(F.col(i).cast("string"), F.lit("")))
                         for o, i in cols.items()})
    st = st.withColumns({f"_d_{o}": F.when(F.col(f"_s_{o}").contains("."), to_number(F.col(f"_s_{o}")))
                         for o in cols})
    st = st.withColumns({f"_i_{o}": F.when(F.col(f"_s_{o}").contains(".")
                                           & (F.col(f"_d_{o}") == F.floor(F.col(f"_d_{o}")))
                                           & (F.abs(F.col(f"_d_{o}")) < 1e15),
                                           F.floor(F.col(f"_d_{o}")).cast("bigint").cast("string"))
                                    .otherwise(F.col(f"_s_{o}")) for o in cols})
    out = {}
    for o in cols:
        s_, i_ = F.col(f"_s_{o}"), F.col(f"_i_{o}")
        padded = (F.when(is_digits(i_) & (F.length(i_) <= 2), F.lpad(i_.cast("bigint").cast("string"), 2, "0"))
                  .when(F.upper(i_) == "X", F.lit("X")).otherwise(i_))
        out[o] = F.when((s_ == "") | (s_ == "nan"), F.lit("")).otherwise(padded)
    return st.withColumns(out).drop(*[f"_{k}_{o}" for o in cols for k in "sdi"])


# ------------------------------------------------------------ B11

def _year_full(y) -> Column:
    return F.when(F.length(y) == 2, F.concat(F.lit("20"), y)).otherwise(y)


def _standard(head: Column, yp: Column):
    code = F.substring_index(head, " ", 1)
    account = F.when(count_char(code, "-") >= 1,
                     F.array_join(F.slice(F.split(code, "-"), 1, 3), "-")).otherwise(F.lit(""))
    yv = F.substring(yp, F.lit(2), F.lit(REST_LEN))
    one_slash = count_char(yp, "/") == 1
    a, b = F.substring_index(yp, "/", 1), F.substring_index(yp, "/", -1)
    both_digits = one_slash & is_digits(a) & is_digits(b)
    a_x = one_slash & (b == "X")
    slash, lead = yp.contains("/"), yp.startswith("/")
    period = (F.when(~slash, F.lit(""))
              .when(lead & (yv == "X"), F.lit("No Year"))
              .when(lead & is_digits(yv), F.concat(F.lit("FY20"), yv))
              .when(lead, F.lit(""))
              .when(both_digits, F.concat(F.lit("FY"), _year_full(a), F.lit("-FY"), _year_full(b)))
              .when(a_x, F.concat(F.lit("FY"), _year_full(a), F.lit("-No Year")))
              .otherwise(F.lit("")))
    expiry = (F.when(~slash, F.lit(""))
              .when(lead & (yv == "X"), F.lit("No Year"))
              .when(lead & is_digits(yv), F.concat(F.lit("20"), yv))
              .when(lead, F.lit(""))
              .when(both_digits, _year_full(b))
              .when(a_x, F.lit("No Year"))
              .otherwise(F.lit("")))
    return account, period, expiry


def _oia(head: Column):
    h = strip_ws(head)
    toks = F.split(h, f"{WS}+")
    account = F.when(h == "", F.lit("")).otherwise(F.element_at(toks, 1))
    yp = F.when(F.size(toks) >= 2, F.element_at(toks, 2)).otherwise(F.lit(""))
    yv = F.substring(yp, F.lit(2), F.lit(REST_LEN))
    one_slash = count_char(yp, "/") == 1
    a, b = F.substring_index(yp, "/", 1), F.substring_index(yp, "/", -1)
    both_digits = one_slash & is_digits(a) & is_digits(b)
    lead = yp.startswith("/")
    period = (F.when(yp == "/X", F.lit("No Year"))
              .when(~yp.contains("/"), F.lit(""))
              .when(lead & is_digits(yv), F.concat(F.lit("FY20"), yv))
              .when(lead, F.lit(""))
              .when(both_digits, F.concat(F.lit("FY"), _year_full(a), F.lit("-FY"), _year_full(b)))
              .otherwise(F.lit("")))
    expiry = (F.when(yp == "/X", F.lit("No Year"))
              .when(~yp.contains("/"), F.lit(""))
              .when(lead & is_digits(yv), F.concat(F.lit("20"), yv))
              .when(lead, F.lit(""))
              .when(both_digits, _year_full(b))
              .otherwise(F.lit("")))
    return account, period, expiry


def components_from_parts(tafs, agency, head, yp) -> Column:
    """B11 on prepared parts: ``head`` = symbol before ' - ', ``yp`` = stripped
    text after the first space of ``head``."""
    t = _c(tafs)
    blank = t.isNull() | (t == "")
    is_oia = F.coalesce(_c(agency) == OIA, F.lit(False))
    std, oia = _standard(_c(head), _c(yp)), _oia(_c(head))
    names = ("account_number", "period_of_performance", "expiration_year")
    return F.struct(*[F.when(blank, F.lit("")).when(is_oia, o).otherwise(s).alias(n)
                      for s, o, n in zip(std, oia, names)])


def _head(t) -> Column:
    return F.substring_index(_c(t), " - ", 1)


def _year_part(head) -> Column:
    return strip_ws(after_first(head, " "))


def tafs_components(tafs, agency) -> Column:
    """struct(account_number, period_of_performance, expiration_year).

    Standard grammar: account = first <= 3 '-' pieces of the first word (needs
    >= 2); period token '/X', '/yy', 'a/b', 'a/X'. Other Independent Agencies:
    whitespace tokens, account = token 0, only token 1 is read.
    """
    h = _head(tafs)
    return components_from_parts(tafs, agency, h, _year_part(h))


def with_components(df: DataFrame, tafs: str = "TAFS", agency: str = "Agency") -> DataFrame:
    """Adds Account_Number, Period_of_Performance, Expiration_Year (B11) with
    the symbol head and period text staged in their own projection."""
    staged = df.withColumn("_head", _head(F.col(tafs))).withColumn("_yp", _year_part(F.col("_head")))
    comp = components_from_parts(F.col(tafs), F.col(agency), F.col("_head"), F.col("_yp"))
    return (staged.withColumn("_comp", comp)
            .withColumns({"Account_Number": F.col("_comp.account_number"),
                          "Period_of_Performance": F.col("_comp.period_of_performance"),
                          "Expiration_Year": F.col("_comp.expiration_year")})
            .drop("_head", "_yp", "_comp"))


# ------------------------------------------------------------ B5, B12-B14, B21-B26

def account_name(tafs) -> Column:
    """Text after the first ' - ' (rest kept), else ''."""
    return F.coalesce(after_first(tafs, " - "), F.lit(""))


def or_default(c, text: str) -> Column:
    """NULL or '' -> default text."""
    return F.coalesce(F.nullif(_c(c), F.lit("")), F.lit(text))


def oia_bureau(code_name, fallback) -> Column:
    """bureau = text after the first whitespace run of a 'code name' value."""
    rest = F.regexp_extract(_c(code_name), r"^\S+\s+(.*)$", 1)
    return F.coalesce(F.nullif(rest, F.lit("")), _c(fallback))


def with_canonical_agency(df: DataFrame, raw: str, out: str) -> DataFrame:
    """B5 with the lower-cased text staged once (keeps the 29-branch chain small)."""
    staged = df.withColumn("_agency_norm", F.lower(F.replace(F.col(raw).cast("string"), F.lit("--"), F.lit("-"))))
    return staged.withColumn(out, canonical_agency(F.col(raw), F.col("_agency_norm"))).drop("_agency_norm")


def canonical_agency(raw, norm=None) -> Column:
    """Map one raw agency text to a target agency (first match in list order).

    Lower-cased, '--' -> '-'; a target matches when it is a substring or by one of
    the special rules; otherwise the stripped raw text; NULL -> 'Unknown Agency'.
    """
    if norm is None:
        norm = F.lower(F.replace(_c(raw).cast("string"), F.lit("--"), F.lit("-")))
    special = {t: (alls, anys) for t, alls, anys in AGENCY_SPECIAL_CASES}
    expr = None
    for target in TARGET_AGENCIES:
        cond = norm.contains(target.lower())
        if target in special:
            alls, anys = special[target]
            s = F.lit(True)
            for a in alls:
                s = s & norm.contains(a)
            if anys:
                any_c = F.lit(False)
                for a in anys:
                    any_c = any_c | norm.contains(a)
                s = s & any_c
            cond = cond | s
        expr = F.when(cond, F.lit(target)) if expr is None else expr.when(cond, F.lit(target))
    return F.when(_c(raw).isNull(), F.lit("Unknown Agency")).otherwise(
        F.coalesce(expr, strip_ws(_c(raw).cast("string"))))


def fund_type(tafs) -> Column:
    """no_year / current_year / multi_year / other from a symbol's period token.

    '/X' anywhere -> no_year; otherwise exactly one '/' and the first word after it
    two digits -> current_year (so '21/25' counts here), longer -> multi_year.
    """
    s = strip_ws(_c(tafs))
    tok = F.substring_index(strip_ws(after_first(s, "/")), " ", 1)
    one = count_char(s, "/") == 1
    return (F.when(s.contains("/X"), F.lit("no_year"))
            .when(one & tok.rlike("^[0-9]{2}$"), F.lit("current_year"))
            .when(one & (F.length(tok) > 2), F.lit("multi_year"))
            .otherwise(F.lit("other")))


def external_account_url(account_number, base: str) -> Column:
    """Two-part numbers 'aa-bbbb' -> base + 3-digit first part + '-' + rest; else NULL."""
    parts = F.split(_c(account_number), "-")
    first = F.element_at(parts, 1)
    return F.when(F.size(parts) == 2,
                  F.concat(F.lit(base),
                           F.when(F.length(first) == 2, F.lpad(first, 3, "0")).otherwise(first),
                           F.lit("-"), F.element_at(parts, 2)))


def entity_label(*cols) -> Column:
    """Key columns joined with ' | '."""
    return F.concat_ws(" | ", *[_c(c).cast("string") for c in cols])


def expiry_flag(expiration, fiscal_year) -> Column:
    """B24: 'expiring' when expiration equals the fiscal year, 'no_year', else 'other'."""
    e = _c(expiration)
    return (F.when(e == _c(fiscal_year).cast("string"), F.lit("expiring"))
            .when(e == "No Year", F.lit("no_year"))
            .otherwise(F.lit("other")))
