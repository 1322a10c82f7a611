"""Registered queries: ingest, master and summaries (A1-A3, B*, C1-C5, D1, E1-E11, P1-P3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import discard
from . import oracle_sql as S
from .pipelines import build_master, monthly_summary, year_summary, year_summary_from
from .registry import register

SUMMARY_SELECT = """Month, Fiscal_Year, Agency, Bureau, Account, Account_Number, Period_of_Performance,
  Expiration_Year, TAFS, Unobligated_Balance_M, Budget_Authority_M, Percentage_Unobligated,
  "Unobligated Balance (Line 2490)", "Budget Authority (Line 2500)", "Percentage Unobligated\""""


@register("year_summary", S.with_ctes("yearly") + f"SELECT {SUMMARY_SELECT} FROM yearly")
def q_year_summary(spark, sf_dir):
    """Year summary at each year's latest month, all years in one plan."""
    return year_summary(spark, sf_dir)


@register("monthly_summary", S.with_ctes("monthly") + f"SELECT {SUMMARY_SELECT} FROM monthly")
def q_monthly_summary(spark, sf_dir):
    """One summary per month with data, all years in one plan."""
    return monthly_summary(spark, sf_dir)


_MASTER_COLS = ["fiscal_year", "Source_File", "Agency", "AGENCY_TITLE", "BUREAU", "OMB_ACCT", "LINENO",
                "DERIVED_FY1", "DERIVED_FY2", "DERIVED_ALLOC", "TRACCT", "TRAG", "TAFS", "BUREAU_TITLE", "OMB_ACCOUNT", "LINE_DESC",
                "source_rows"]
_M = ", ".join(f"CAST({m} AS DOUBLE) AS {m}" for m in S.FISCAL_MONTHS)


@register("build_master", S.with_ctes("master") + f"SELECT {', '.join(_MASTER_COLS)}, {_M} FROM master")
def q_build_master(spark, sf_dir):
    """The wide master table (months as double for comparison)."""
    m = build_master(spark, sf_dir)
    return m.select(*_MASTER_COLS, *[F.col(x).cast("double").alias(x) for x in S.FISCAL_MONTHS])


@register("stream_master", S.with_ctes("master") + f"SELECT {', '.join(_MASTER_COLS)}, {_M} FROM master")
def q_stream_master(spark, sf_dir):
    """Month partitions ingested by a file-source stream (foreachBatch, availableNow),
    merged and finished into the master: must equal the batch master."""
    from ..session import shared_dir
    from ..sources.fixture import ledger_rows
    from ..streaming import months as ST
    from .pipelines import master_from_groups
    import uuid
    base = shared_dir(spark, f"stream-{uuid.uuid4().hex[:8]}")
    src = ST.write_month_partitions(ledger_rows(spark, sf_dir), f"{base}/raw")
    ST.ingest_stream(spark, src, f"{base}/groups", f"{base}/checkpoint")
    m = master_from_groups(ST.streamed_groups(spark, f"{base}/groups"))
    return m.select(*_MASTER_COLS, *[F.col(x).cast("double").alias(x) for x in S.FISCAL_MONTHS])


# ------------------------------------------------------------------ the same over a master that grows with the tables

def _by_part(sql: str) -> str:
    return sql.replace("       p.p_brand, p.p_size,", "       p.p_brand || p.p_partkey AS p_brand, p.p_size,")


@register("build_master_by_part", _by_part(S.with_ctes("master") + f"SELECT {', '.join(_MASTER_COLS)}, {_M} FROM master"))
def q_build_master_by_part(spark, sf_dir):
    """P1 with accounts by part."""
    m = build_master(spark, sf_dir, by_part=True)
    return m.select(*_MASTER_COLS, *[F.col(x).cast("double").alias(x) for x in S.FISCAL_MONTHS])


@register("year_summary_by_part", _by_part(S.with_ctes("yearly") + f"SELECT {SUMMARY_SELECT} FROM yearly"))
def q_year_summary_by_part(spark, sf_dir):
    """P2 with accounts by part."""
    master = build_master(spark, sf_dir, by_part=True)
    summary = year_summary_from(master)
    discard(master)
    return summary
