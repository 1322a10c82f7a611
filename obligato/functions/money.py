"""Money, ratio, rounding and display-text Column helpers.

Rounding note: published values are rounded half-even on the exact binary
value (Python ``round``/``format``). Spark's ``round`` is half-up on the
decimal text and ``bround`` differs too, so ``round1`` goes through
``format_number`` (exact-binary half-even) and parses the text back.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_millions(c) -> Column:
    """Dollars (decimal or double) -> double millions."""
    return _c(c).cast("double") / F.lit(1e6)


def pct_account(unob, ba) -> Column:
    """ba = 0 -> 0 when unob = 0 else 100; otherwise unob / ba * 100."""
    u, b = _c(unob), _c(ba)
    return (F.when(b == 0, F.when(u == 0, F.lit(0.0)).otherwise(F.lit(100.0)))
            .otherwise(F.try_divide(u, b) * F.lit(100.0)))


def pct_rollup(unob, ba) -> Column:
    """Ba > 0 -> unob / ba * 100, else 0."""
    u, b = _c(unob), _c(ba)
    return F.when(b > 0, F.try_divide(u, b) * F.lit(100.0)).otherwise(F.lit(0.0))


def pct_unguarded(unob, ba) -> Column:
    """Plain ratio; NULL where the divisor is 0."""
    return F.try_divide(_c(unob), _c(ba)) * F.lit(100.0)


def round_n(c, n: int) -> Column:
    """Half-even rounding of the exact binary value to n places (Python round)."""
    return F.replace(F.format_number(_c(c), n), F.lit(","), F.lit("")).try_cast("double")


def round1(c) -> Column:
    """Python round(x, 1)."""
    return round_n(c, 1)


def fmt_money(c, null_text: str | None = None, grouping: bool = True) -> Column:
    """B17b/c: '$1,234.5M' (or '$1234.5M' without grouping); NULL -> null_text."""
    num = F.format_number(_c(c), 1)
    if not grouping:
        num = F.replace(num, F.lit(","), F.lit(""))
    text = F.concat(F.lit("$"), num, F.lit("M"))
    return text if null_text is None else F.coalesce(text, F.lit(null_text))


def fmt_pct(c, null_text: str | None = None) -> Column:
    """B17b: '12.3%' (no grouping); NULL -> null_text."""
    text = F.concat(F.replace(F.format_number(_c(c), 1), F.lit(","), F.lit("")), F.lit("%"))
    return text if null_text is None else F.coalesce(text, F.lit(null_text))


def fmt_fixed(c, n: int) -> Column:
    """'{x:.nf}' without grouping."""
    return F.replace(F.format_number(_c(c), n), F.lit(","), F.lit(""))


def parse_money(c, default: float | None = None) -> Column:
    """B18: '$1,234.5M' -> 1234.5; unparseable -> default (NULL when None)."""
    v = F.regexp_replace(_c(c), r"[$,M]", "").try_cast("double")
    return v if default is None else F.coalesce(v, F.lit(float(default)))


def parse_pct(c, default: float | None = None) -> Column:
    """B18: '12.3%' -> 12.3."""
    v = F.regexp_replace(_c(c), "%", "").try_cast("double")
    return v if default is None else F.coalesce(v, F.lit(float(default)))


def obligated(ba, unob) -> Column:
    """Budget authority minus unobligated balance."""
    return _c(ba) - _c(unob)


def exact_sum(c, scale: int = 1) -> Column:
    """Order-independent sum of values carried at ``scale`` decimals.

    Rounded millions are summed as decimals so every engine and every
    partitioning gives the same double back.
    """
    return F.sum(_c(c).cast(f"decimal(38,{scale})")).cast("double")
