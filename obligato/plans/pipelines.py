"""Composite pipelines (P1-P3): ledger -> master -> year and month summaries.

Intermediate tables that several branches read (the group aggregate, the master, a published
summary) are written as reliable checkpoints in the shared folder; building one runs the jobs that
it needs. Everything else is lazy. A query builds one master and hands it on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.constants import FISCAL_MONTHS, LEGACY_MONTHS
from ..operators import ingest
from ..session import materialize, store_parts
from ..functions.text import clean_text
from ..operators.ingest import (CHECK_COLUMNS, NULLABLE_KEYS, apply_fixed_units, deal_groups, detect_units,
                                drop_null_keys, file_check_rates, first_agency, of_years, partial_groups, pivot_months,
                                resolve_groups, skip_files, standard_lines, task_count, year_batches)
from ..operators.months import available_months, latest_month
from ..operators.pairing import (drop_near_zero, oia_bureaus, pair_lines, sort_summary, split_oia,
                                summarize_pairs, with_display)
from ..sources.fixture import fiscal_year_rows, ledger_rows, table, unit_notes

# Consolidated multi-agency file skipped to avoid double counting (fixed value).
DEFAULT_SKIP = ["2668331098.xlsx"]
TEXT_COLUMNS = ["TAFS", "BUREAU", "AGENCY_TITLE", "BUREAU_TITLE", "OMB_ACCOUNT", "LINE_DESC"]


def ledger_groups(spark: SparkSession, sf_dir: str, skip: list[str] | None = None, by_part: bool = False) -> DataFrame:
    """E1 over all raw rows of files not on the skip list, materialised: the one pass over the raw ledger.

    With accounts by part there are about as many groups as line items, so the tasks are as many as these need; a ledger of more rows than
    a batch holds goes through by fiscal years, and the groups are stored by columns."""
    skipped = F.array(*map(F.lit, skip if skip is not None else DEFAULT_SKIP)).cast("array<string>")
    skip_df = spark.range(1).select(F.explode(skipped).alias("Source_File"))    # a list of known size: joined without a shuffle of the raw rows
    if not by_part:
        return materialize(resolve_groups(partial_groups(skip_files(ledger_rows(spark, sf_dir), skip_df))))

    def groups(rows: int, years: list[int | None] | None = None) -> DataFrame:
        tasks = task_count(spark, rows)
        raw = skip_files(ledger_rows(spark, sf_dir, by_part=tasks), skip_df)
        return resolve_groups(partial_groups(deal_groups(raw if years is None else of_years(raw, years), tasks)))

    rows = table(spark, sf_dir, "lineitem").count()
    if rows <= ingest.BATCH_ROWS:
        return store_parts(spark, iter([groups(rows)]), "groups")
    return store_parts(spark, (groups(n, years) for years, n in year_batches(fiscal_year_rows(spark, sf_dir))), "groups")


def build_master(spark: SparkSession, sf_dir: str, skip: list[str] | None = None,
                 reject_mismatches: bool = True, by_part: bool = False) -> DataFrame:
    """One hash aggregate of all raw rows, then everything else on the aggregate.

    Line number and derived codes are group keys, so the line filter (C1), the per-file code check (E9), the
    NULL-key drop (C2), the per-file agency (B5) and the unit scaling (B2/B3, linear over
    exact decimal sums) all run on the aggregate instead of the raw rows.
    """
    return master_from_groups(ledger_groups(spark, sf_dir, skip, by_part), reject_mismatches, by_part)


def master_from_groups(groups: DataFrame, reject_mismatches: bool = True, by_part: bool = False) -> DataFrame:
    """Everything after the single raw pass: line filter, per-file code check (on all standard lines, before rows
    with NULL keys go), NULL keys, agency and units, text clean-up.

    With accounts by part the master is about as large as the stored groups and takes no shuffle to make, so only the facts per file, a
    row each, are materialised; its readers make it from the columns that they need."""
    per_file = materialize if by_part else lambda df: df
    std = standard_lines(groups)
    master = drop_null_keys(std, NULLABLE_KEYS)
    agency = per_file(first_agency(groups))
    units = detect_units(unit_notes(agency.select("Source_File", F.col("agency_text").alias("AGENCY_TITLE"))))
    if reject_mismatches:
        rejected = per_file(file_check_rates(std).where("rejected").select("Source_File"))
        master = master.join(F.broadcast(rejected), "Source_File", "left_anti")
    # one row per raw file, which the driver lists anyway; a shuffle by file would leave the master in as many tasks as there are files
    master = (master.drop("AGENCY", "AGENCY_ord").join(F.broadcast(agency.select("Source_File", "Agency")), "Source_File")
              .join(F.broadcast(per_file(units)), "Source_File", "left"))
    mult = F.coalesce(F.col("unit_multiplier"), F.lit(1))
    master = master.withColumns({m: (F.col(m) * mult).cast("decimal(38,2)") for m in FISCAL_MONTHS})
    master = master.drop("unit_multiplier", *CHECK_COLUMNS)
    master = master.withColumns({c: clean_text(F.col(c)) for c in TEXT_COLUMNS if c in master.columns})
    # the master is a published table read by several branches: cut lineage here
    return master if by_part else materialize(master)


def _finish(pairs: DataFrame, near_zero: bool, null_text: str) -> DataFrame:
    s = summarize_pairs(pairs)
    if near_zero:
        s = drop_near_zero(s)
    return with_display(s, null_text).drop("_unob", "_ba")


def year_summary_from(master: DataFrame) -> DataFrame:
    """P2 body: pair lines at each year's latest month; near-zero rows kept.
    Materialised: it is the published table every explorer reads."""
    latest = materialize(latest_month(master))    # a row per year, read by both lines
    return materialize(_finish(pair_lines(split_oia(master), latest), False, "0.0"))


def monthly_summary_from(master: DataFrame, months: list[str] | None = None) -> DataFrame:
    """P3 body: pair lines for every month with data (or only ``months``);
    near-zero rows dropped. Materialised: it is the published table every
    explorer reads. Restricting months prunes the pairing itself."""
    avail = available_months(master)
    if months:
        avail = avail.where(F.col("month").isin(months))
    return materialize(_finish(pair_lines(split_oia(master), avail), True, ""))


def summary_legacy(master: DataFrame) -> DataFrame:
    """Standard agencies paired on (agency, symbol) and Other Independent Agencies on the symbol alone, with their
    own symbol grammar and bureau (C4, D2, B11, B14), at the legacy latest month; near-zero rows kept, sorted (G1)."""
    months = latest_month(master, order=LEGACY_MONTHS)
    standard = pair_lines(split_oia(master), months)
    independent = pair_lines(oia_bureaus(split_oia(master, keep_oia=True)), months, keys=("TAFS",))
    return sort_summary(_finish(standard.unionByName(independent.select(*standard.columns)), False, ""))


def year_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return year_summary_from(build_master(spark, sf_dir))


def monthly_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monthly_summary_from(build_master(spark, sf_dir))


def build_one_month_files(spark: SparkSession, sf_dir: str, year: int = 2017,
                          months: tuple[str, ...] = ("Nov", "Jul", "Aug")) -> DataFrame:
    """One-month files (B4 fixed x1000 units, B5, C1, E2 3-key aggregate per
    file, E3 pivot to one row per (bureau, account, line, agency) with one
    column per month, missing months 0). The fixture's files are agency x month
    slices of one fiscal year; that year is filtered on the ship date, which reaches the scan."""
    raw = ledger_rows(spark, sf_dir, year).where(F.col("month").isin(list(months)))
    raw = raw.withColumn("Source_File", F.concat_ws("_", "AGENCY_TITLE", F.lit(str(year)), "month"))
    raw = apply_fixed_units(raw, 1000)
    keys = ["month", "BUREAU", "OMB_ACCT", "LINENO"]
    groups = materialize(resolve_groups(partial_groups(raw.drop("TRAG", "TRACCT", "FY1", "FY2", "ALLOC"), keys, months), keys, months))
    amount = F.coalesce(*[F.when(F.col("month") == m, F.col(m)) for m in months]).cast("double")
    per_file = standard_lines(groups).select("Source_File", *keys, amount.alias("amount"))
    j = per_file.join(first_agency(groups).select("Source_File", "Agency"), "Source_File")
    out = pivot_months(j.withColumn("ordinal", F.col("Source_File")), ["BUREAU", "OMB_ACCT", "LINENO", "Agency"],
                       list(months))
    return out.withColumn("Source_File", F.lit(f"{year}_Combined"))
