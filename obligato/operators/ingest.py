"""Ledger ingest operators.

The raw ledger arrives long (one row per source line and month, ``amount``)
or wide (``AMT_*`` columns, see ``rename_months``). The master is wide: one
row per (file, account key, line) with twelve month columns, as published.
All per-file facts (unit, agency, match rate) are small per-file aggregates
joined back on ``Source_File``; no step groups raw rows by a single low-
cardinality key without map-side partial aggregation first.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.constants import FISCAL_MONTHS, LINE_MAX, LINE_MIN, RAW_MONTH_COLUMNS, UNIT_EXEMPT
from ..functions.text import to_number, with_canonical_agency, with_derived_codes, with_normalized
from ..sources.fixture import DEAL

MASTER_KEYS = ["BUREAU", "OMB_ACCT", "LINENO", "DERIVED_FY1", "DERIVED_FY2", "DERIVED_ALLOC"]
OPTIONAL_KEYS = ["TRACCT", "TRAG"]
# Keys that can be NULL in a raw ledger. The derived codes are never NULL
# (blank is ''), and leaving them out of the NULL filter keeps Catalyst from
# pushing that filter below (and duplicating) the code derivation.
NULLABLE_KEYS = ["BUREAU", "OMB_ACCT", "LINENO", "TRACCT", "TRAG"]


# numeric columns added by the scan itself (never money)
NOT_AMOUNTS = {"fiscal_year", "ordinal"}


def skip_files(df: DataFrame, skip: DataFrame, col: str = "Source_File") -> DataFrame:
    """A2: drop rows of files on a skip list (left anti join on the file name)."""
    return df.join(skip.select(F.col(col)).distinct(), col, "left_anti")


def rename_months(df: DataFrame, mapping: dict[str, str] = RAW_MONTH_COLUMNS) -> DataFrame:
    """B1: AMT_* / AMTn columns -> month names; a monthly and a quarter-end column
    for the same month are merged with coalesce (monthly first)."""
    present = [c for c in mapping if c in df.columns]
    by_month: dict[str, list[str]] = {}
    for c in present:
        by_month.setdefault(mapping[c], []).append(c)
    out = df
    for month, cols in by_month.items():
        out = out.withColumn(month, F.coalesce(*[F.col(c) for c in cols]) if len(cols) > 1 else F.col(cols[0]))
    return out.drop(*[c for c in present if c not in by_month])


def detect_units(notes: DataFrame, max_row: int = 5) -> DataFrame:
    """B2: per file multiplier from the first ``max_row`` caption rows:
    'thousand' anywhere -> 1000, else 1."""
    text = F.lower(F.col("text"))
    return (notes.where(F.col("row") <= max_row)
            .groupBy("Source_File")
            .agg(F.max(F.when(text.contains("thousand"), 1000).otherwise(1)).alias("unit_multiplier")))


def apply_fixed_units(df: DataFrame, factor: int = 1000, exempt=UNIT_EXEMPT) -> DataFrame:
    """Every numeric, non-exempt column times a literal factor."""
    cols = {f.name: (F.col(f.name) * F.lit(factor)).cast(f.dataType)
            for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in exempt and f.name not in NOT_AMOUNTS}
    return df.withColumns(cols)


def first_agency(groups: DataFrame) -> DataFrame:
    """Per file, the first non-null raw agency text in file order mapped to a target agency.

    Reads group aggregates that carry the first agency text and its position (``AGENCY``,
    ``AGENCY_ord``), so the minimum per file runs over the reduced table.
    """
    first = F.min_by("AGENCY", "AGENCY_ord")
    return (groups.groupBy("Source_File").agg(first.alias("_first_agency"))
            .transform(lambda x: with_canonical_agency(x, "_first_agency", "Agency"))
            .withColumnRenamed("_first_agency", "agency_text"))


def standard_lines(df: DataFrame, lo: int = LINE_MIN, hi: int = LINE_MAX, col: str = "LINENO") -> DataFrame:
    """Keep rows whose line number parses and lies in [lo, hi]."""
    n = to_number(F.col(col))
    return df.where(n.isNotNull() & (n >= lo) & (n <= hi))


def drop_null_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Drop rows with NULL in any group key."""
    return df.dropna(subset=[k for k in keys if k in df.columns])


def derive_codes(df: DataFrame, tafs: str = "TAFS") -> DataFrame:
    """B8 + B9: DERIVED_FY1/FY2 from the period token, DERIVED_ALLOC from the account."""
    return with_derived_codes(df, tafs)


def mismatch_samples(df: DataFrame, n: int = 3, order_col: str = "ordinal", spread: int = 64) -> DataFrame:
    """The first n mismatching rows (in file order) per file and code.

    A file that mismatches throughout is one hot key, so the first n are taken within ``spread`` slices
    of a file first and among those slices' survivors after.
    """
    pairs = [(g, d) for g, d in CODE_PAIRS if g in df.columns]
    staged = with_normalized(df, {f"_n_{c}": c for p in pairs for c in p})
    codes = F.array(*[F.struct(F.lit(g).alias("code"), F.col(f"_n_{g}").alias("given"), F.col(f"_n_{d}").alias("derived"))
                      for g, d in pairs])
    rows = (staged.select("Source_File", "TAFS", F.col(order_col).alias("ordinal"), F.inline(codes))
            .where((F.col("given") != "") & (F.col("given") != F.col("derived"))))
    key = ["Source_File", "code"]
    part = F.pmod("ordinal", F.lit(spread))
    for by in ([*key, part], key):
        rows = (rows.withColumn("_rn", F.row_number().over(Window.partitionBy(*by).orderBy("ordinal", "TAFS")))
                .where(F.col("_rn") <= n))
    return rows.withColumnRenamed("_rn", "sample")


CODE_PAIRS = [("FY1", "DERIVED_FY1"), ("FY2", "DERIVED_FY2"), ("ALLOC", "DERIVED_ALLOC")]
CHECK_COLUMNS = [f"{g.lower()}_{k}" for g, _ in CODE_PAIRS for k in ("tested", "matched")]
# Descriptive columns: a group keeps the first non-null value of each in file order.
FIRST_COLUMNS = ["TAFS", "AGENCY", "AGENCY_TITLE", "BUREAU_TITLE", "OMB_ACCOUNT", "LINE_DESC"]


def group_keys(df: DataFrame, keys: list[str] | None = None) -> list[str]:
    """Year, file, account keys and those optional keys that the ledger has; last the hash of some of them that dealt rows carry: it parts
    no group and saves another shuffle."""
    keys = list(keys or MASTER_KEYS)
    return ["fiscal_year", "Source_File", *keys, *[k for k in [*OPTIONAL_KEYS, DEAL] if k in df.columns and k not in keys]]


#: Rows of one task, on average, where there are about as many groups as raw rows: a group's row takes some KB in sorts and hash maps.
TASK_ROWS = 65_536


def task_count(spark: SparkSession, rows: int) -> int:
    """Tasks for ``rows`` wide rows; they grow in number with the rows, not in size."""
    return max(rows // TASK_ROWS + 1, spark.sparkContext.defaultParallelism)


#: Raw rows of one batch, unless a fiscal year has more: the shuffle files of one batch, some 120 bytes a row, are on disk at a time.
BATCH_ROWS = 1 << 24


def year_batches(rows: dict[int | None, int]) -> list[tuple[list[int | None], int]]:
    """Fiscal years in batches of at most ``BATCH_ROWS`` rows, or one year, each with its number of rows. The year is a group key, so no
    group of E1 spans two batches."""
    batches: list[tuple[list[int | None], int]] = []
    for year in sorted(rows, key=lambda y: (y is None, y)):
        if batches and batches[-1][1] + rows[year] <= BATCH_ROWS:
            years, n = batches.pop()
            batches.append(([*years, year], n + rows[year]))
        else:
            batches.append(([year], rows[year]))
    return batches


def of_years(raw: DataFrame, years: list[int | None]) -> DataFrame:
    """Raw rows of some fiscal years; None stands for rows without one."""
    return raw.where(reduce(lambda a, b: a | b, [F.col("fiscal_year").eqNullSafe(F.lit(y)) for y in years]))


def deal_groups(raw: DataFrame, tasks: int, keys: list[str] | None = None) -> DataFrame:
    """Raw rows dealt to a fixed number of tasks by year, file and the account keys that they have, which serves both aggregates of E1.

    For ledgers whose groups are about as many as their rows: map-side sums would save nothing there, and a shuffle of the session's
    number of partitions would make tasks that grow with the ledger. A row with a NULL key is dealt like any other. Rows that their source
    has dealt stay where they are.
    """
    if DEAL in raw.columns:
        return raw
    dealt_by = ["fiscal_year", "Source_File", *[k for k in keys or MASTER_KEYS if k not in DERIVED]]
    return raw.withColumn(DEAL, F.hash(*dealt_by)).repartition(tasks, DEAL)


DERIVED = ["DERIVED_FY1", "DERIVED_FY2", "DERIVED_ALLOC"]


def partial_groups(raw: DataFrame, keys: list[str] | None = None, months=FISCAL_MONTHS, order_col: str = "ordinal",
                   month_col: str = "month", amount_col: str = "amount") -> DataFrame:
    """E1/E2, the only pass over raw rows: sums per (group keys, descriptive texts, given codes).

    Raw columns alone are grouping keys and every buffer is a long (cents, counts, first position), so this is a hash
    aggregate with map-side combine and no sort. Codes are derived (B8, B9), normalised and compared (B10, E9) on its rows, which are
    few, not on the raw ones. Partial groups of several batches are simply united before ``resolve_groups``.
    """
    given = [g for g, d in CODE_PAIRS if g in raw.columns and "TAFS" in raw.columns]
    keys = [k for k in group_keys(raw, keys) if k not in DERIVED or "TAFS" not in raw.columns]
    texts = [c for c in FIRST_COLUMNS if c in raw.columns and c not in keys]
    cents = (F.col(amount_col) * 100).cast("long")
    out = raw.groupBy(*keys, *texts, *[g for g in given if g not in keys]).agg(
        *[F.sum(F.when(F.col(month_col) == m, cents)).alias(m) for m in months],
        F.count(F.lit(1)).alias("source_rows"), F.min(order_col).alias("_ord"))
    if "TAFS" not in raw.columns:
        return out
    out = derive_codes(out)
    pairs = [(g, d) for g, d in CODE_PAIRS if g in given]
    out = with_normalized(out, {f"_n_{c}": c for p in pairs for c in p})
    tested = {g: F.col(f"_n_{g}") != "" for g, _ in pairs}
    n = F.col("source_rows")
    out = out.withColumns({f"{g.lower()}_tested": F.when(tested[g], n).otherwise(F.lit(0)) for g, _ in pairs}
                          | {f"{g.lower()}_matched": F.when(tested[g] & (F.col(f"_n_{g}") == F.col(f"_n_{d}")), n).otherwise(F.lit(0)) for g, d in pairs})
    return out.drop(*[f"_n_{c}" for p in pairs for c in p], *[g for g in given if g not in keys])


def resolve_groups(parts: DataFrame, keys: list[str] | None = None, months=FISCAL_MONTHS) -> DataFrame:
    """E1 on the reduced table: one row per group; month sums (0 without rows), counts, and the first
    non-null text of every descriptive column, with the position of the first agency text."""
    keys = group_keys(parts, keys)
    texts = [c for c in FIRST_COLUMNS if c in parts.columns and c not in keys]
    at = lambda c: F.when(F.col(c).isNotNull(), F.col("_ord"))
    sums = [(F.coalesce(F.sum(m), F.lit(0)).cast("decimal(38,0)") / F.lit(100)).cast("decimal(38,2)").alias(m) for m in months]
    counts = [F.sum(c).alias(c) for c in ["source_rows", *CHECK_COLUMNS] if c in parts.columns]
    firsts = [F.min_by(c, at(c)).alias(c) for c in texts]
    if "AGENCY" in texts:
        firsts.append(F.min(at("AGENCY")).alias("AGENCY_ord"))
    return parts.groupBy(*keys).agg(*sums, *firsts, *counts).drop(DEAL)


def aggregate_ledger(raw: DataFrame, keys: list[str] | None = None, months=FISCAL_MONTHS) -> DataFrame:
    """Long ledger -> wide master, one row per (fiscal year, file, keys), with the code-check counts.

    Filtering lines and NULL keys afterwards is exact because LINENO and the keys are group keys.
    """
    return resolve_groups(partial_groups(raw, keys, months), keys, months)


def file_check_rates(groups: DataFrame) -> DataFrame:
    """E9 at file level from group-level counts: match % per code, rejected flag."""
    present = [g for g, _ in CODE_PAIRS if f"{g.lower()}_tested" in groups.columns]
    out = groups.groupBy("Source_File").agg(
        F.sum("source_rows").alias("rows"),
        *[F.sum(f"{g.lower()}_{k}").alias(f"{g.lower()}_{k}") for g in present for k in ("tested", "matched")])
    rejected = F.lit(False)
    for g in present:
        t, m = F.col(f"{g.lower()}_tested"), F.col(f"{g.lower()}_matched")
        out = out.withColumn(f"{g.lower()}_match_pct",
                             F.when(t > 0, m.cast("double") * 100.0 / t).otherwise(F.lit(100.0)))
        rejected = rejected | (m < t)
    return out.withColumn("rejected", rejected)


def pivot_months(df: DataFrame, keys: list[str], months: list[str], month_col: str = "month",
                 value_col: str = "amount", order_col: str = "ordinal") -> DataFrame:
    """One row per key with one column per listed month (first value in
    file order, missing -> 0). The explicit month list avoids a distinct pass."""
    return (df.groupBy(*keys).pivot(month_col, months)
            .agg(F.min_by(F.col(value_col), F.col(order_col)))
            .fillna(0, subset=months))


def unpivot_months(df: DataFrame, ids: list[str], months=FISCAL_MONTHS,
                   month_col: str = "month", value_col: str = "amount") -> DataFrame:
    """Wide month columns -> (ids, month, amount); no shuffle."""
    present = [m for m in months if m in df.columns]
    return df.unpivot(ids, present, month_col, value_col)


def blank_profile(groups: DataFrame, cols=("DERIVED_FY1", "DERIVED_FY2", "DERIVED_ALLOC"), null_keys=("BUREAU", "OMB_ACCT", "LINENO")) -> DataFrame:
    """Rows with blank derived codes, all-blank rows, distinct codes, and rows with a NULL key, per year.

    ``groups`` carry ``source_rows``; the distinct counts run over the few distinct code combinations.
    """
    cols = list(cols)
    n = F.col("source_rows")
    keys = [F.sum(F.when(F.col(k).isNull(), n).otherwise(0)).alias(f"{k}_null") for k in null_keys]
    small = groups.groupBy("fiscal_year", *cols).agg(F.sum(n).alias("source_rows"), *keys)
    aggs = [F.sum(n).alias("rows"), *[F.sum(f"{k}_null").alias(f"{k}_null") for k in null_keys]]
    for c in cols:
        aggs += [F.sum(F.when(F.col(c) == "", n).otherwise(0)).alias(f"{c}_blank"), F.count_distinct(F.col(c)).alias(f"{c}_distinct")]
    all_blank = reduce(lambda a, b: a & b, [F.col(c) == "" for c in cols])
    return small.groupBy("fiscal_year").agg(*aggs, F.sum(F.when(all_blank, n).otherwise(0)).alias("all_blank"))


def compression_ratio(groups: DataFrame, warn_above: float = 50.0) -> DataFrame:
    """Input rows per output group (groups without NULL keys), per year; flag > warn_above."""
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in NULLABLE_KEYS if k in groups.columns])
    out = groups.groupBy("fiscal_year").agg(F.sum("source_rows").alias("input_rows"), F.count_if(whole).alias("groups"))
    return (out.withColumn("ratio", F.col("input_rows").cast("double") / F.col("groups"))
            .withColumn("over_aggregated", F.col("ratio") > warn_above))


def union_ledgers(*dfs: DataFrame) -> DataFrame:
    """H1: UNION ALL by column name; absent columns become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)
