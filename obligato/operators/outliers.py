"""History-aware outlier report.

All report levels go through together, with the level as part of every key:

* entity summary  — one ``groupBy`` of the current-year rows, each row counted once per level;
* mean / std      — one row per report level, joined on the level key;
* BH-FDR ranks    — over *distinct* p-values (ties collapse under partial
  aggregation), range-partitioned by level and p; prefix sums over the ranges' counts give where
  each range starts, windows inside a range do the rest. No window
  ever runs over the whole input in one task;
* history         — aggregated once for all entities (two-level groupBy) and
  left-joined on the entity keys instead of re-reading files per entity.

What several branches read (the exploded rows, the z-scores, the ranks) is written once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.constants import FDR_ALPHA, MIN_BUDGET
from ..functions.money import fmt_fixed, pct_rollup
from ..functions.stats import two_sided_p
from ..functions.text import entity_label
from ..session import materialize
from .blocks import range_blocks, scan_blocks

KEYS = ["Agency", "Bureau", "Account"]
LEVELS = {level: (KEYS[:n], MIN_BUDGET[level]) for n, level in enumerate(("agency", "bureau", "account"), 1)}


def np_round(c, n: int) -> Column:
    """numpy/pandas Series.round: rint(x * 10^n) / 10^n."""
    f = float(10 ** n)
    return F.rint(c * F.lit(f)) / F.lit(f)


def sep_expiring(monthly: DataFrame, month: str = "Sep") -> DataFrame:
    """Rows of the given month whose money expires in their own fiscal year."""
    return monthly.where((F.col("Month") == month)
                         & (F.col("Expiration_Year") == F.col("Fiscal_Year").cast("string")))


def yearly_pct(monthly: DataFrame, month: str = "Sep") -> DataFrame:
    """Per fiscal year with data for ``month``: pct unobligated of the
    money expiring that year (totals of the published, rounded values)."""
    rows = sep_expiring(monthly, month)
    agg = rows.groupBy("Fiscal_Year").agg(
        F.sum(F.col("Unobligated_Balance_M").cast("decimal(38,1)")).cast("double").alias("total_unobligated"),
        F.sum(F.col("Budget_Authority_M").cast("decimal(38,1)")).cast("double").alias("total_budget"))
    return agg.withColumn("percent_unobligated", pct_rollup(F.col("total_unobligated"), F.col("total_budget")))


def yearly_pct_history(yearly: DataFrame, last_year: int) -> DataFrame:
    """Mean and maximum yearly pct over years <= last_year."""
    return (yearly.where(F.col("Fiscal_Year") <= last_year)
            .agg(F.avg("percent_unobligated").alias("avg_pct"), F.max("percent_unobligated").alias("previous_high"),
                 F.count(F.lit(1)).alias("years")))


def entity_summary(rows: DataFrame, cols: list[str], min_budget: float) -> DataFrame:
    """Per entity sums (+ account count when Account is not a key), pct,
    minimum-budget filter; NULL keys are dropped like a pandas groupby."""
    aggs = [F.sum(F.col("Unobligated_Balance_M").cast("decimal(38,1)")).cast("double").alias("unobligated"),
            F.sum(F.col("Budget_Authority_M").cast("decimal(38,1)")).cast("double").alias("budget")]
    if "Account" not in cols:
        aggs.append(F.count("Account").alias("accounts"))
    out = rows.dropna(subset=cols).groupBy(*cols).agg(*aggs)
    out = out.withColumn("pct", pct_rollup(F.col("unobligated"), F.col("budget")))
    return out.where(F.col("budget") >= min_budget)


def z_scores(summary: DataFrame, key: str = "level") -> DataFrame:
    """z = (pct - mean) / sample std per level; p = 2 (1 - Phi(|z|)).
    std = 0 or a single entity leaves z and p NULL (no outliers)."""
    st = summary.groupBy(key).agg(F.avg("pct").alias("_mean"), F.stddev_samp("pct").alias("_std"))
    z = F.when(F.col("_std") > 0, (F.col("pct") - F.col("_mean")) / F.col("_std"))
    return (summary.join(F.broadcast(st), key)   # one row per level
            .withColumn("z", z).withColumn("p_value", two_sided_p(F.col("z")))
            .drop("_mean", "_std"))


def bh_fdr(df: DataFrame, alpha: float = FDR_ALPHA, key: str = "level", p: str = "p_value") -> DataFrame:
    """Benjamini-Hochberg. Reject every p <= T where T is the largest p
    with p <= rank(p) / n * alpha (tied p share the largest rank). Also the
    corrected p = min(1, min over p' >= p of p' n / rank(p')).

    Ranks are prefix sums over the sorted ranges of the distinct p, corrected values running minima against that order."""
    counts = df.where(F.col(p).isNotNull()).groupBy(key, p).agg(F.count(F.lit(1)).alias("n_at"))
    ranged = range_blocks(counts, [key], p)
    totals = ranged.groupBy(key).agg(F.sum("n_at").alias("n"))
    ranks = (scan_blocks(ranged, [key], "_block", p, sums={"_before": F.col("n_at")}).join(totals, key)
             .withColumn("rank_max", F.col("_before") + F.col("n_at")).withColumn("_raw", F.col(p) * F.col("n") / F.col("rank_max")))
    ranks = materialize(ranks.select(key, p, "_block", "_raw", (F.col(p) <= F.col("rank_max") / F.col("n") * F.lit(alpha)).alias("_under")))
    highest = ranks.where("_under").groupBy(key).agg(F.max(p).alias("_highest"))
    ranks = (scan_blocks(ranks, [key], "_block", p, mins={"_least": F.col("_raw")}, descending=True).join(highest, key, "left")
             .select(key, p, F.least(F.lit(1.0), "_least").alias("p_corrected"), F.coalesce(F.col(p) <= F.col("_highest"), F.lit(False)).alias("_reject")))
    return (df.join(ranks, [key, p], "left")
            .withColumn("is_outlier", F.coalesce("_reject", F.lit(False))).drop("_reject"))


def history_of(rows: DataFrame, cols: list[str], expected: int) -> DataFrame:
    """E18 over month-of-record rows of the history years: per entity the yearly pct (budget > 0 and pct >= 0
    only), then mean, max and whether fewer than ``expected`` years have data."""
    per_year = rows.dropna(subset=cols).groupBy(*cols, "Fiscal_Year").agg(
        F.sum(F.col("Unobligated_Balance_M").cast("decimal(38,1)")).cast("double").alias("u"),
        F.sum(F.col("Budget_Authority_M").cast("decimal(38,1)")).cast("double").alias("b"))
    pct = F.when(F.col("b") > 0, F.col("u") / F.col("b") * F.lit(100.0))
    kept = per_year.withColumn("_pct", pct).where(F.col("_pct") >= 0)
    return (kept.groupBy(*cols).agg(F.avg("_pct").alias("hist_avg"), F.max("_pct").alias("hist_high"),
                                    F.count(F.lit(1)).alias("hist_years"))
            .withColumn("missing_years", F.col("hist_years") < expected))


def history_stats(monthly: DataFrame, cols: list[str], first_year: int, last_year: int, month: str = "Sep") -> DataFrame:
    """E18 of a monthly summary for one level's key columns."""
    rows = sep_expiring(monthly, month).where(F.col("Fiscal_Year").between(first_year, last_year))
    return history_of(rows, cols, last_year - first_year + 1)


def by_level(rows: DataFrame, levels: dict) -> DataFrame:
    """Each row once per level with the level's keys; keys below the level are '', rows with a NULL key of the level drop out."""
    def struct(level: str, cols: list[str]) -> Column:
        keys = [(F.col(c) if c in cols else F.lit("")).alias(c) for c in KEYS]
        whole = F.lit(True)
        for c in cols:
            whole = whole & F.col(c).isNotNull()
        return F.when(whole, F.struct(F.lit(level).alias("level"), *keys))

    shape = F.explode(F.array_compact(F.array(*[struct(level, cols) for level, (cols, _) in levels.items()]))).alias("_l")
    return rows.select("Fiscal_Year", "Unobligated_Balance_M", "Budget_Authority_M", shape).select("*", "_l.*").drop("_l")


def level_summaries(rows: DataFrame, levels: dict) -> DataFrame:
    """E20 for all levels at once: sums, pct, each level's minimum budget, and the entity's label."""
    out = entity_summary(rows, ["level", *KEYS], float("-inf"))
    least, label = F.lit(None).cast("double"), F.lit(None).cast("string")
    for level, (cols, min_budget) in levels.items():
        least = F.when(F.col("level") == level, F.lit(float(min_budget))).otherwise(least)
        label = F.when(F.col("level") == level, entity_label(*cols)).otherwise(label)
    return out.where(F.col("budget") >= least).withColumn("entity", label)


def stat_display(df: DataFrame) -> DataFrame:
    """Report columns — pct (1 dp), history 'N/A' / '12.3' / '12.3*',
    budget in billions (1 dp), z (2 dp)."""
    def hist(c):
        txt = fmt_fixed(F.col(c), 1)
        return (F.when(F.col(c).isNull(), F.lit("N/A"))
                .when(F.col("missing_years"), F.concat(txt, F.lit("*"))).otherwise(txt))
    return df.select(
        "level", "kind", "entity",
        np_round(F.col("pct"), 1).alias("pct_unobligated"),
        hist("hist_avg").alias("hist_avg_display"),
        hist("hist_high").alias("previous_high_display"),
        np_round(F.col("budget") / F.lit(1000.0), 1).alias("budget_billions"),
        np_round(F.col("z"), 2).alias("z_score"),
    )


def outlier_report(monthly: DataFrame, current_year: int, hist_first: int, hist_last: int,
                   alpha: float = FDR_ALPHA, levels: dict | None = None, top_candidates: int = 15,
                   top_notable: int = 10) -> DataFrame:
    """P7 at every level: outliers (BH reject, z > 0) and notable entities
    (top non-outliers with z > 0 that beat their own history)."""
    levels = levels or LEVELS
    rows = materialize(by_level(sep_expiring(monthly).where(F.col("Fiscal_Year").between(hist_first, current_year)), levels))
    z = materialize(z_scores(level_summaries(rows.where(F.col("Fiscal_Year") == current_year), levels)))
    keys = ["level", *KEYS]
    history = history_of(rows.where(F.col("Fiscal_Year").between(hist_first, hist_last)), keys, hist_last - hist_first + 1)
    pos = materialize(bh_fdr(z, alpha).where(F.col("z") > 0).join(history, keys, "left"))
    report = stat_display(pos.where("is_outlier").withColumn("kind", F.lit("outlier")))
    by_pct = [F.col("pct").desc(), F.col("entity")]
    for level in levels:   # top-k by orderBy+limit: per-task top k, then one small merge
        cand = pos.where(~F.col("is_outlier") & (F.col("level") == level)).orderBy(*by_pct).limit(top_candidates)
        notable = (cand.where(F.col("hist_avg").isNull() | (F.col("pct") > F.col("hist_avg")))
                   .orderBy(*by_pct).limit(top_notable).withColumn("kind", F.lit("notable")))
        report = report.unionByName(stat_display(notable))
    return report
