"""Scans along an order that one task must not see whole: prefix sums and "last value so far" in two levels.

Rows carry a ``block`` (a file split, a range of lines) that bounds how many of them meet in one task. Each block is summed
up to one row, a window over those few rows gives what every block starts from, and a window inside the block does the rest.
A block's start enters that window as one more row ahead of the block's own, so the rows are shuffled and sorted once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize


def range_blocks(df: DataFrame, keys: list[str], order: str, block: str = "_block") -> DataFrame:
    """``df`` range-partitioned by (keys, order) and written, ``block`` the number of each row's range; equal rows share a range."""
    return materialize(df.repartitionByRange(*keys, order).withColumn(block, F.spark_partition_id()))


def scan_blocks(df: DataFrame, keys: list[str], block: str, order: str, sums: dict[str, Column] | None = None,
                lasts: dict[str, Column] | None = None, mins: dict[str, Column] | None = None, descending: bool = False) -> DataFrame:
    """``df`` with running values along (block, order) within ``keys``, or against it with ``descending``.

    ``sums``: name -> addend; the sum of the addends of all rows before this one (0 at first).
    ``lasts``: name -> value; the last non-null value up to and including this row (null before the first).
    ``mins``: name -> value; the least value up to and including this row.
    ``keys`` may be null; the window over blocks holds one row per key and block.
    """
    sums, lasts, mins = sums or {}, lasts or {}, mins or {}
    rows = df.withColumns({f"_v_{n}": c for n, c in (sums | lasts | mins).items()})
    edge = F.min if descending else F.max
    carried = rows
    if lasts and not (sums or mins):    # texts sort before they aggregate, so only rows that carry something go there
        rows = materialize(rows)
        carried = _of_several_blocks(rows, keys, block)
    per_block = carried.groupBy(*keys, block).agg(
        *[F.sum(f"_v_{n}").alias(f"_b_{n}") for n in sums], *[F.min(f"_v_{n}").alias(f"_b_{n}") for n in mins],
        *[edge(F.when(F.col(f"_v_{n}").isNotNull(), F.struct(F.col(order), F.col(f"_v_{n}")))).getField(f"_v_{n}").alias(f"_b_{n}") for n in lasts])
    way = (lambda c: F.col(c).desc()) if descending else F.col
    ahead = Window.partitionBy(*keys).orderBy(way(block)).rowsBetween(Window.unboundedPreceding, -1)
    starts = per_block.select(
        *keys, block, *[F.sum(f"_b_{n}").over(ahead).alias(f"_v_{n}") for n in sums],
        *[F.min(f"_b_{n}").over(ahead).alias(f"_v_{n}") for n in mins],
        *[F.last(f"_b_{n}", ignorenulls=True).over(ahead).alias(f"_v_{n}") for n in lasts])
    starts = starts.where(F.coalesce(*[F.col(f"_v_{n}").cast("string") for n in sums | mins | lasts]).isNotNull())
    inside = Window.partitionBy(*keys, block).orderBy("_own", way(order))
    before, upto = inside.rowsBetween(Window.unboundedPreceding, -1), inside.rowsBetween(Window.unboundedPreceding, 0)
    out = rows.withColumn("_own", F.lit(True)).unionByName(starts.withColumn("_own", F.lit(False)), allowMissingColumns=True).withColumns(
        {n: F.coalesce(F.sum(f"_v_{n}").over(before), F.lit(0)) for n in sums}
        | {n: F.min(f"_v_{n}").over(upto) for n in mins}
        | {n: F.last(f"_v_{n}", ignorenulls=True).over(upto) for n in lasts})
    return out.where("_own").drop("_own", *[f"_v_{n}" for n in sums | lasts | mins])


def _of_several_blocks(rows: DataFrame, keys: list[str], block: str) -> DataFrame:
    """Rows of keys that have more than one block; the others have nothing to carry from block to block."""
    several = rows.groupBy(*keys).agg(F.min(block).alias("_lo"), F.max(block).alias("_hi")).where("_lo < _hi")
    several = materialize(several.select(*[F.col(k).alias(f"_k_{i}") for i, k in enumerate(keys)]))
    if several.isEmpty():
        return rows.limit(0)
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{i}"))
    return rows.join(several, same, "left_semi")
