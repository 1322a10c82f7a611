"""Statistical Column helpers: normal tail probability without a UDF.

Neither Spark nor DuckDB ships erfc, so it is computed to double precision from its two classical
expansions: Kummer's series of erf below ``SPLIT`` (all terms positive) and the continued
fraction of erfc above, both evaluated from the last term back.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

SPLIT = 2.5
#: Terms after which both expansions have settled to a double on their side of SPLIT.
TERMS = 80
ROOT_PI = math.sqrt(math.pi)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _backward(init: Column, step) -> Column:
    return F.aggregate(F.sequence(F.lit(TERMS), F.lit(1), F.lit(-1)), init, step)


def erfc(x) -> Column:
    z = F.abs(_c(x).cast("double"))
    t = z * z * F.lit(2.0)
    series = _backward(F.lit(1.0), lambda acc, k: F.lit(1.0) + t / (k * F.lit(2.0) + F.lit(1.0)) * acc)
    fraction = _backward(z, lambda acc, k: z + k / F.lit(2.0) / acc)
    tail = F.exp(-z * z)
    ans = F.when(z < SPLIT, F.lit(1.0) - F.lit(2.0) * z / F.lit(ROOT_PI) * tail * series).otherwise(tail / (F.lit(ROOT_PI) * fraction))
    return F.when(_c(x) >= 0, ans).otherwise(F.lit(2.0) - ans)


def two_sided_p(z) -> Column:
    """p = 2 * (1 - Phi(|z|)) = erfc(|z| / sqrt(2))."""
    return erfc(F.abs(_c(z)) / F.lit(math.sqrt(2.0)))


def erfc_sql(x: str) -> str:
    """The same expansions as SQL text (used by the oracle queries; tests compare both with the exact function)."""
    z = f"abs({x})"
    steps = f"generate_series({TERMS}, 1, -1)"
    series = f"list_reduce(list_prepend(1.0::DOUBLE, {steps}::DOUBLE[]), lambda acc, k: 1.0::DOUBLE + {z} * {z} * 2.0::DOUBLE / (k * 2.0::DOUBLE + 1.0::DOUBLE) * acc)"
    fraction = f"list_reduce(list_prepend({z}, {steps}::DOUBLE[]), lambda acc, k: {z} + k / 2.0::DOUBLE / acc)"
    tail = f"exp(-{z} * {z})"
    ans = (f"(CASE WHEN {z} < {SPLIT!r}::DOUBLE THEN 1.0::DOUBLE - 2.0::DOUBLE * {z} / {ROOT_PI!r}::DOUBLE * {tail} * {series} "
           f"ELSE {tail} / ({ROOT_PI!r}::DOUBLE * {fraction}) END)")
    return f"(CASE WHEN {x} >= 0 THEN {ans} ELSE 2.0::DOUBLE - {ans} END)"


def two_sided_p_sql(z: str) -> str:
    return erfc_sql(f"(abs({z})/{math.sqrt(2.0)!r}::DOUBLE)")
