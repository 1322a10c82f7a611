"""Consecutive numbers for sorted rows, without one task seeing a whole group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import free_name, written


def numbered(df: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``df`` with ``position`` (from 0 within ``group`` by ``order``, nulls first) and ``total`` (rows of the group).

    Rows are range-sorted by group, order and an arbitrary last number (so that any run of equal rows can be cut);
    every range's rows of a group are counted, and prefix sums of those counts, at most one a range and group,
    give each range's start. ``group`` must not be null.
    """
    salt, at, part, first, n = (free_name(df, c) for c in ("_salt", "_at", "_part", "_first", "_n"))
    keys = [group, *order, salt]
    rows = written(df.withColumn(salt, F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
                   .drop(salt).withColumn(at, F.monotonically_increasing_id()), "numbered")
    rows = rows.withColumn(part, F.shiftright(at, 33))
    counts = rows.groupBy(part, group).agg(F.min(at).alias(first), F.count("*").alias(n))
    whole = Window.partitionBy(group)
    ahead = whole.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(part, group, F.sum(n).over(whole).alias("total"),
                           (F.coalesce(F.sum(n).over(ahead), F.lit(0)) - F.col(first)).alias(first))
    return rows.join(starts, [part, group]).withColumn("position", F.col(at) + F.col(first)).drop(part, at, first)
