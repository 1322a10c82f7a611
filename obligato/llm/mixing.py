"""Mixing sources to target weights along a time-varying curriculum. DataFrame functions only.

Each source's weight runs linearly from a start to an end value over training time
0..1. Its integral is the source's share of all words; its inverse turns the running
word count of the source's shuffled document stream into training positions, by
which the mix is range-sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

#: Words: runs of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Hex digits of the shuffle key that name a bucket; a source's running counts are
#: summed per bucket first, so no task sees a whole source (16**3 buckets a source).
BUCKET_DIGITS = 3


def word_count(text: Column) -> Column:
    """Number of words; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def with_schedules(sizes: DataFrame, slopes: list[tuple[float, float]]) -> DataFrame:
    """One-row-per-source ``sizes`` with w0 and w1: by code point, null last, the sources take the (start, end) weights in turn."""
    nth = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    pick = [F.element_at(F.array(*[F.lit(float(s[i])) for s in slopes]), (nth % len(slopes) + 1).cast("int")) for i in (0, 1)]
    return sizes.withColumns({"w0": pick[0], "w1": pick[1]})


def targets(sizes: DataFrame, max_epochs: int) -> DataFrame:
    """Words each source should give: shares of the total by integrated weight, at most ``max_epochs`` times its size.

    ``sizes`` has one row per source (source, source_size, w0, w1). Sources fill up in the order of
    limit per weight; what the full ones cannot take is shared among the rest by weight. The
    window runs over this one-row-per-source table only.
    """
    w = sizes.withColumns({"weight": (F.col("w0") + F.col("w1")) / 2, "limit": F.col("source_size") * max_epochs})
    order = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    earlier, everything = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    w = w.withColumns({
        "total": F.sum("source_size").over(everything), "weights": F.sum("weight").over(everything),
        "used": F.coalesce(F.sum("limit").over(earlier), F.lit(0)),
        "gone": F.coalesce(F.sum("weight").over(earlier), F.lit(0.0)),
    }).withColumn("full", F.col("limit") / F.col("weight") <= (F.col("total") - F.col("used")) / (F.col("weights") - F.col("gone")))
    w = w.withColumns({
        "rest": F.col("total") - F.sum(F.when(F.col("full"), F.col("limit")).otherwise(0)).over(everything),
        "free": F.sum(F.when(F.col("full"), 0.0).otherwise(F.col("weight"))).over(everything),
    })
    share = F.least(F.col("rest") * F.col("weight") / F.col("free"), F.col("limit").cast("double"))
    return w.select("source", "w0", "w1", "source_size",
                    F.when(F.col("full"), F.col("limit").cast("double")).otherwise(share).alias("target"))


def _position(words: Column) -> Column:
    """Training time at which the source's schedule has asked for so many of its words."""
    w0, slope = F.col("w0"), F.col("w1") - F.col("w0")
    done = F.least(words / F.col("target"), F.lit(1.0)) * ((F.col("w0") + F.col("w1")) / 2)
    return F.when(slope == 0, done / w0).otherwise((F.sqrt(w0 * w0 + 2 * slope * done) - w0) / slope)


def plan(rows: DataFrame, slopes: list[tuple[float, float]], max_epochs: int = 3, seed: str = "mix") -> DataFrame:
    """``rows`` (doc_id, source, size and any others) with source_size, target, copies, before, w0 and w1.

    Every source's rows stand in a fixed pseudo-random order (MD5 of ``seed`` and id; ties by id and
    size); ``before`` counts the source's words ahead of a row. A row is taken once for each whole
    time its source goes into the target, and once more if its middle word lies within the rest, so
    a source misses its target by half a document at most. Reruns agree. A null source is a source
    of its own; a source without words has target 0 and no copies; an empty table gives an empty plan.
    """
    narrow = written(rows.select("doc_id", "source", "size", _key(seed).alias("_key")), "mix-sizes")
    bucket = F.substring("_key", 1, BUCKET_DIGITS)
    buckets = narrow.groupBy("source", bucket.alias("_bucket")).agg(F.sum("size").alias("_words"))
    sizes = buckets.groupBy("source").agg(F.sum("_words").alias("source_size"))
    wanted = targets(with_schedules(sizes, slopes), max_epochs).withColumnRenamed("source", "_s2")
    ahead = Window.partitionBy("source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = buckets.select(F.col("source").alias("_s1"), F.col("_bucket").alias("_b"),
                            F.coalesce(F.sum("_words").over(ahead), F.lit(0)).alias("_start"))
    inside = (Window.partitionBy("source", "_bucket").orderBy("_key", "doc_id", "size")
              .rowsBetween(Window.unboundedPreceding, -1))
    out = (rows.withColumn("_key", _key(seed)).withColumn("_bucket", bucket)
           .withColumn("_inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
           .join(starts, F.col("source").eqNullSafe(F.col("_s1")) & (F.col("_bucket") == F.col("_b")))
           .join(wanted, F.col("source").eqNullSafe(F.col("_s2")))
           .withColumn("before", F.col("_start") + F.col("_inside")))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    out = out.withColumn("_whole", whole).withColumn("_rest", F.col("target") - F.col("_whole") * F.col("source_size"))
    more = (F.col("source_size") > 0) & (F.col("_whole") < max_epochs) & (F.col("before") + F.col("size") / 2 <= F.col("_rest"))
    return out.withColumn("copies", (F.col("_whole") + more.cast("int")).cast("int")).drop(
        "_key", "_bucket", "_inside", "_s1", "_b", "_start", "_s2", "_whole", "_rest")


def _key(seed: str) -> Column:
    return F.md5(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))


def first_positions(planned: DataFrame) -> DataFrame:
    """The plan with each row's first training position (null if it is not taken)."""
    middle = F.col("before") + F.col("size") / 2
    return planned.withColumn("first_position", F.when((F.col("copies") > 0) & (F.col("target") > 0), _position(middle)))


def mixed_documents(docs: DataFrame, slopes: list[tuple[float, float]], max_epochs: int = 3, seed: str = "mix") -> DataFrame:
    """The documents as training reads them: every copy a row, range-sorted by training position."""
    rows = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), F.struct("*").alias("_row"))
    planned = plan(rows, slopes, max_epochs, seed).where("copies > 0")
    copies = planned.withColumn("_epoch", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    words = F.col("_epoch") * F.col("source_size") + F.col("before") + F.col("size") / 2
    placed = copies.withColumn("position", F.when(F.col("target") > 0, _position(words)).otherwise(0.0))
    return (placed.repartitionByRange("position", "doc_id").sortWithinPartitions("position", "doc_id")
            .select("_row.*"))
