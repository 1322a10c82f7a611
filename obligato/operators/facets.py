"""Cascading facets (H5) and stale-selection clearing (H6).

Each facet holds the values of the rows that match the selections above it in the cascade (agency -> bureau ->
period -> expiration year). A row is read once: the number of leading selections it meets says for which
facets it counts, and one aggregate over (facet, value) gives all four, with partial aggregation, so a
hot value costs one row per task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CASCADE = [("agency", "Agency"), ("bureau", "Bureau"), ("period", "Period_of_Performance"),
           ("expiration", "Expiration_Year")]


def facets(df: DataFrame, selection: dict | None = None, group: list[str] | None = None) -> DataFrame:
    """H5: (facet, value, rows) for the cascade, values non-empty, in one pass over ``df``.

    ``selection`` maps facet name -> selected value; facet i is computed over
    rows matching the selections of facets 0..i-1.
    """
    selection, group = selection or {}, group or []
    reached, tagged = F.lit(True), []
    for name, col in CASCADE:
        tagged.append(F.when(reached & (F.col(col) != ""), F.struct(F.lit(name).alias("facet"), F.col(col).alias("value"))))
        if selection.get(name):
            reached = reached & F.coalesce(F.col(col) == selection[name], F.lit(False))
    rows = df.select(*group, F.inline(F.array_compact(F.array(*tagged))))
    return rows.groupBy(*group, "facet", "value").agg(F.count(F.lit(1)).alias("rows")).select(*group, "facet", "value", "rows")


def kept_selections(facet_values: DataFrame, selection: dict, year: Column | None = None, group: list[str] | None = None,
                    fallback: str | None = None, switched: bool = False) -> DataFrame:
    """H6: (facet, selected, kept) of every facet, per group of ``facet_values``.

    A selection that is not among its facet's values is cleared. With ``year`` (the view's fiscal year as text) the
    expiration follows it: with ``switched`` (the view went to another year) always where the year is offered, else only if
    nothing was selected; ``fallback`` is what an empty selection takes where the year is not offered.
    """
    group = group or []
    wanted = F.array(*[F.struct(F.lit(name).alias("facet"), F.lit(selection.get(name) or None).cast("string").alias("selected")) for name, _ in CASCADE])
    year = F.lit(None).cast("string") if year is None else year
    is_expiration = F.col("facet") == "expiration"
    offers = facet_values.groupBy(*group).agg(
        F.max(F.coalesce(is_expiration & (F.col("value") == year), F.lit(False))).alias("_year"),
        F.max(is_expiration & (F.col("value") == F.lit(fallback or ""))).alias("_fallback"),
        *[F.max((F.col("facet") == name) & (F.col("value") == F.lit(selection.get(name) or ""))).alias(f"_{name}") for name, _ in CASCADE])
    rows = offers.select(*group, "_year", "_fallback", F.map_from_arrays(
        F.array(*[F.lit(name) for name, _ in CASCADE]), F.array(*[F.col(f"_{name}") for name, _ in CASCADE])).alias("_hits"), F.inline(wanted))
    none = F.col("selected").isNull()
    kept = F.when(F.element_at("_hits", F.col("facet")), F.col("selected"))
    expiration = F.when(F.col("_year") & (none | F.lit(switched)), year).when(none & F.col("_fallback"), F.lit(fallback)).otherwise(kept)
    return rows.select(*group, "facet", "selected", F.when(is_expiration, expiration).otherwise(kept).alias("kept"))


def clear_stale_filters(spark: SparkSession, selection: dict, facet_values: DataFrame,
                        default_expiration: str | None = None) -> DataFrame:
    """H6 of one view: (facet, selected, kept) of the facets that have a selection; with ``default_expiration`` the
    expiration goes to that year where it is offered, as on a change of the view's year."""
    year = None if default_expiration is None else F.lit(default_expiration)
    return kept_selections(facet_values, selection, year, switched=default_expiration is not None).where("selected IS NOT NULL")
