"""SimHash near-duplicate detection by multi-index hashing.

Every fingerprint is stored under each of its segments; a query enumerates the
small Hamming ball around each of its own segments, fetches what the tables hold
under those codes and verifies the whole distance. By the pigeonhole principle two
fingerprints that differ in r of 64 bits have, among m segments, one of the first
(r mod m) + 1 within floor(r/m) bits or one of the others within floor(r/m) - 1.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bound_batches, free_name, written
from .components import connected_components

BITS = 64
#: Shingles whose bits are counted at once.
BLOCK = 1 << 15


def fingerprint(text: str | None, shingle: int = 4, seed: int = 42) -> int:
    """Unsigned 64-bit SimHash of one text.

    Words are runs of bytes other than ASCII white space, A-Z lower-cased. Every
    ``shingle``-word sequence counts as often as it occurs; a shorter text is one
    shingle, a text without words (or null) has fingerprint zero.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    line, n = b" ".join(words), max(1, len(words) - shingle + 1)
    length = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(length + 1) - 1
    start, end = (end - length)[:n], end[-n:]
    ones = np.zeros(BITS, np.int64)
    for i in range(0, n, BLOCK):
        pieces = [line[a:b] for a, b in zip(start[i:i + BLOCK].tolist(), end[i:i + BLOCK].tolist(), strict=True)]
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, pieces, repeat(seed)), "<u8", len(pieces))
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4, seed: int = 42, id_col: str = "doc_id", text_col: str = "text",
                 id_type: str = "long") -> DataFrame:
    """(id, fp) with the fingerprint as a signed long, one row per input row."""
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t.as_py(), shingle, seed) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array(fps, "<u8").view("<i8"))], ["id", "fp"])

    return docs.select(F.col(id_col).cast(id_type).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {id_type}, fp long")


def segments_of(segments: int, max_distance: int) -> list[tuple[int, int, int]]:
    """(offset, width, radius) per segment; a radius below zero needs no probe."""
    widths = [BITS // segments + (i < BITS % segments) for i in range(segments)]
    near, exact = divmod(max_distance, segments)
    return [(sum(widths[:i]), w, near if i <= exact else near - 1) for i, w in enumerate(widths)]


def _code(number: int, offset: int, width: int):
    """Segment's value with the segment's number above it."""
    return F.shiftrightunsigned("fp", offset).bitwiseAND(F.lit((1 << width) - 1)) + F.lit(number << 56)


def _ball(code, masks: list[int]):
    return F.transform(F.array(*[F.lit(m) for m in masks]), lambda m: code.bitwiseXOR(m.cast("long")))


def links(fps: DataFrame, max_distance: int = 4, segments: int = 3) -> DataFrame:
    """(a, b) groups of all pairs of rows of ``fps`` (id, fp, group; distinct fp) of different groups that differ in at
    most ``max_distance`` bits.

    ``segments`` sets how long the stored codes are: 64/segments bits should be no
    less than log2 of the number of fingerprints, so that a code holds few by
    chance; fewer segments mean larger balls. The result is the same for any.
    """
    layout = [(i, *s) for i, s in enumerate(segments_of(segments, max_distance)) if s[2] >= 0]
    balls = []
    for number, offset, width, radius in layout:
        masks = [sum(1 << bit for bit in flip) for r in range(radius + 1) for flip in combinations(range(width), r)]
        balls.append(_ball(_code(number, offset, width), masks))
    probes = fps.select(F.col("group").alias("a"), "fp", F.explode(F.concat(*balls)).alias("code"))
    stored = fps.select(F.col("group").alias("b"), F.col("fp").alias("fp_b"),
                        F.explode(F.array(*[_code(i, o, w) for i, o, w, _ in layout])).alias("code"))
    near = ((F.col("a") != F.col("b")) & (F.col("fp") < F.col("fp_b"))
            & (F.bit_count(F.col("fp").bitwiseXOR(F.col("fp_b"))) <= max_distance))
    return probes.join(stored, (probes["code"] == stored["code"]) & near).select("a", "b")


def close_links(nodes: DataFrame) -> DataFrame:
    """Some links of at most two bits, two ends for each 64-bit code within one bit of several fingerprints.

    They gather the many fingerprints of a large group of near copies with a number of rows that grows
    with the fingerprints, not with their pairs; whatever they miss ``links`` finds.
    """
    masks = [0, *[1 << b for b in range(BITS - 1)], -(1 << (BITS - 1))]
    codes = nodes.select("id", F.explode(_ball(F.col("fp"), masks)).alias("code"))
    return (codes.groupBy("code").agg(F.min("id").alias("a"), F.max("id").alias("b")).where("a < b").select("a", "b").distinct())


def near_duplicates(docs: DataFrame, shingle: int = 4, max_distance: int = 4, seed: int = 42, segments: int = 3,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id), one row per input row.

    Equal fingerprints are one node (its smallest id), and fingerprints within two bits are gathered into
    groups first, so that neither copies nor near copies multiply links. Documents link at ``max_distance`` differing bits or fewer;
    component_id is the smallest id reachable. Null and empty texts have
    fingerprint zero and link like any other. A row whose id is null gets its
    fingerprint but links to nothing: its component_id is null. Repeated rows are
    copies. An empty table gives an empty result; further columns are ignored.
    """
    found = _with_components(fingerprints(docs, shingle, seed, id_col, text_col), max_distance, segments)
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _with_components(fps: DataFrame, max_distance: int, segments: int = 3) -> DataFrame:
    """``fps`` (id, fp) with component_id, the smallest id reachable; ids of any type that has an order."""
    fps = written(fps, "fingerprints")
    nodes = written(fps.where("id IS NOT NULL").groupBy("fp").agg(F.min("id").alias("id")), "nodes")
    if max_distance >= 2:
        close = connected_components(close_links(nodes))
        nodes = written(nodes.join(close, "id", "left").select("id", "fp", F.coalesce("component", "id").alias("group")), "groups")
    else:
        nodes = nodes.withColumn("group", F.col("id"))
    found = connected_components(links(nodes, max_distance, segments)).withColumnRenamed("id", "group")
    labels = (nodes.join(found, "group", "left")
              .select(F.col("fp").alias("label_fp"), F.coalesce("component", "group").alias("component_id")))
    return (fps.join(labels, F.col("fp") == F.col("label_fp"), "left")
            .select("id", "fp", F.when(F.col("id").isNotNull(), F.col("component_id")).alias("component_id")))


#: Type of a document's key: its doc_id, then KEY_BITS of its text's hash. It sorts by doc_id first.
KEY_TYPE, KEY_BITS = "decimal(38,0)", 62


def _key() -> Column:
    tag = F.xxhash64("text").bitwiseAND(F.lit((1 << KEY_BITS) - 1))
    return (F.col("doc_id").cast("long").cast("decimal(19,0)") * F.expr(f"{1 << KEY_BITS}BD") + tag).cast(KEY_TYPE)


def keep_representatives(docs: DataFrame, shingle: int = 4, max_distance: int = 4, seed: int = 42) -> DataFrame:
    """Rows of ``docs`` whose doc_id is the smallest of their texts' component, one row each.

    Rows that share a doc_id but not the text are documents of their own: of several in one component that with the
    smallest text hash stays. Of equal rows one stays, of those that differ in further columns the one with the
    smallest hash. Rows without a doc_id are kept: nothing can stand for them.
    """
    key, nth = free_name(docs, "key"), free_name(docs, "nth")
    keyed = docs.withColumn(key, _key())
    found = _with_components(fingerprints(keyed, shingle, seed, key, id_type=KEY_TYPE), max_distance)
    removed = found.where("component_id <> id").select(F.col("id").alias(key)).distinct()
    left = keyed.join(removed, key, "left_anti")
    plain = [c for c, kind in docs.dtypes if "map<" not in kind and kind != "variant"]
    once = Window.partitionBy(key, F.when(F.col("doc_id").isNull(), F.xxhash64("text"))).orderBy(F.xxhash64(*plain))
    numbered = left.withColumn(nth, F.row_number().over(once))
    return numbered.where((F.col(nth) == 1) | F.col("doc_id").isNull()).select(*docs.columns)
