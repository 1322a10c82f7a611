"""Exact removal of repeated byte strings by bucket-pointer refinement of sampled suffixes.

A suffix's first bucket is its 32-byte gram. Buckets are refined by the bucket identifiers of later
offsets, and the refined identifiers are used again for the next round: 32 bytes at i and i + 32 make 64,
64 at i and i + 36 make 100. Identifiers are hashes of the pair, so every task gives a bucket the same one
without a shared table, and sorting a bucket is grouping by the next identifier.

Not every suffix goes through the shuffle. Of the grams inside a 100-byte string the smallest one
is its anchor; equal strings have equal anchors at equal offsets. Consecutive starts with the same anchor are
one run, about one to 35 bytes of text:

1. runs whose anchor gram occurs once drop out (their buckets have one member);
2. the others are refined by the identifier of all their strings together. Members of such a class repeat its
   first member in full;
3. first members whose anchor has several classes share only some of their strings. They are cut into blocks of
   starts by the distance to the anchor. A block's core, the bytes that all its strings have, is the next
   bucket: one that no other block shares drops out, blocks with equal bytes again leave their first member;
4. first members of cores that still have several classes are refined start by start.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, discard, release, written
from .positions import numbered

LENGTH, GRAM = 100, 32
#: Grams inside a string.
WINDOW = LENGTH - GRAM + 1
#: Starts of a block: their distances to the anchor agree but for the last bits.
BLOCK_BITS = 3
BLOCK = 1 << BLOCK_BITS
#: Starts handled at once; a longer text goes in pieces.
PIECE = 1 << 20
_POSITION = np.uint64((1 << 21) - 1)
#: A row's place: start, number of starts, and the number of the text among those of its id.
START_BITS, COUNT_BITS, TAG_BITS = 30, 7, 26


def _mixed(x: np.ndarray) -> np.ndarray:
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    return x


def _pair(a: np.ndarray, b: np.ndarray, salt: int) -> np.ndarray:
    """Identifier of the bucket of pairs (a, b)."""
    return _mixed(a * np.uint64(0x9E3779B97F4A7C15) + (b ^ np.uint64(salt)) * np.uint64(0xC2B2AE3D27D4EB4F))


def grams(data: np.ndarray) -> np.ndarray:
    """Identifiers of the 32-byte buckets of every start in ``data`` (bytes): 1 byte, 2, 4 and so on by pairs."""
    ids, size = data.astype(np.uint64) + np.uint64(1), 1
    for factor in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xC2B2AE3D27D4EB4F, 0xFF51AFD7ED558CCD):
        pair = ids[:-size] * np.uint64(factor)
        pair += ids[size:]
        ids, size = pair, size * 2
    return _mixed(ids)


def doubles(gram: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Identifiers of the 64-byte buckets at ``at``, from those of the grams there and 32 later."""
    return _pair(gram[at], gram[at + GRAM], GRAM)


def wholes(gram: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Identifiers of the 100-byte buckets at ``at``, from the 64-byte ones there and 36 later."""
    return _pair(doubles(gram, at), doubles(gram, at + LENGTH - 2 * GRAM), LENGTH)


def pieces(data: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(offset, bytes) of parts that hold up to PIECE starts of 100-byte strings each."""
    for at in range(0, len(data) - LENGTH + 1, PIECE):
        yield at, data[at:at + PIECE + LENGTH - 1]


def anchors_of(gram: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, first start, number of starts) of the runs of starts that share an anchor: the smallest, then leftmost gram."""
    key = (gram & ~_POSITION) | np.arange(len(gram), dtype=np.uint64)
    size = 1
    while 2 * size <= WINDOW:
        key, size = np.minimum(key[:-size], key[size:]), size * 2
    key = np.minimum(key[:-(WINDOW - size)], key[WINDOW - size:])
    anchor = (key & _POSITION).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
    return anchor[first], first, np.diff(np.append(first, len(anchor)))


def runs_of(data: np.ndarray) -> tuple[np.ndarray, ...]:
    """(anchor's bucket, class, first start, number of starts) of all runs: the class tells all their bytes and their distance."""
    gram = grams(data)
    anchor, first, count = anchors_of(gram)
    span = count - 1 + LENGTH - 2 * GRAM
    ids = _pair(_pair(doubles(gram, first), doubles(gram, first + span // 2), 1), doubles(gram, first + span), 2)
    return gram[anchor], _pair(ids, ((anchor - first) << 8 | count).astype(np.uint64), 3), first, count


def blocks_of(data: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, ...]:
    """(core, class, first start, number of starts) of the blocks of the runs whose first starts are ``wanted``."""
    gram = grams(data)
    anchor, first, count = anchors_of(gram)
    here = np.isin(first, wanted)
    anchor, first, count = anchor[here], first[here], count[here]
    start = np.repeat(first, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    block = (np.repeat(anchor, count) - start) >> BLOCK_BITS
    of = np.repeat(np.arange(len(anchor)), count)
    cut = np.flatnonzero(np.concatenate(([True], (block[1:] != block[:-1]) | (of[1:] != of[:-1])))) if len(start) else np.zeros(0, int)
    size = np.diff(np.append(cut, len(start)))
    a, b, p, j = start[cut], start[cut] + size - 1, anchor[of[cut]], block[cut]
    at = p - j * BLOCK
    core = _pair(doubles(gram, at), doubles(gram, at + LENGTH - 2 * GRAM - BLOCK + 1), 4)
    core = _pair(core, gram[p] ^ j.astype(np.uint64), 5)
    ids = _pair(_pair(wholes(gram, a), wholes(gram, b), 6), ((p - a) << 8 | size).astype(np.uint64), 7)
    return core, ids, a, size


def starts_of(data: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, ...]:
    """(gram's bucket, whole string's bucket, start, 1) of single starts."""
    gram = grams(data)
    return gram[wanted], wholes(gram, wanted), wanted, np.ones(len(wanted), np.int64)


def _bytes(text: bytes | None) -> np.ndarray:
    return np.frombuffer(text or b"", np.uint8)


def _documents(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, tag, text); the tag numbers the different texts of one id, 0 where an id has one text.

    Texts are told apart by their 64-bit hash. Ids with several texts are numbered by sorted ranges, so that
    one id of many rows is no task of its own.
    """
    text = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.xxhash64(text).alias("hash"), text.alias("text"))
    texts = rows.where("doc IS NOT NULL").groupBy("doc", "hash").agg(F.count("*").alias("n")).drop("n")
    shared = texts.groupBy("doc").agg(F.count("*").alias("n")).where("n > 1").select("doc")
    numbers = written(numbered(texts.join(shared, "doc"), "doc", ["hash"]).select("doc", "hash", "position"), "texts-of-ids")
    most = numbers.agg(F.max("position")).first()[0]
    if (most or 0) >= 1 << TAG_BITS:
        raise ValueError(f"an id has {most + 1} different texts, more than {1 << TAG_BITS}")
    return rows.join(numbers, ["doc", "hash"], "left").select("doc", F.coalesce("position", F.lit(0)).alias("tag"), "text")


def _rows(doc: int, tag: int, at: int, found: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
    h, c, first, count = found
    return h, c, np.full(len(h), doc, np.int64), (((first + at) << COUNT_BITS | count) << TAG_BITS) | tag


def _batch(out: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    columns = [np.concatenate(x).view(np.int64) for x in zip(*out, strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["h", "c", "doc", "place"])


ROWS = "h long, c long, doc long, place long"


def _runs(docs: DataFrame) -> DataFrame:
    """(h, c, doc, place) of every run of starts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [_rows(doc, tag, at, runs_of(data)) for doc, tag, text in zip(*(c.to_pylist() for c in batch.columns), strict=True)
                   for at, data in pieces(_bytes(text))]
            if out:
                yield _batch(out)

    return docs.where("doc IS NOT NULL").mapInArrow(run, ROWS)


def _classes(rows: DataFrame) -> DataFrame:
    """(h, c, first_doc, first_place): the buckets' first members.

    The minimum of (doc, place) is taken of one number that sorts alike, which a hash aggregate can hold.
    """
    both = F.expr(f"CAST(doc AS DECIMAL(19, 0)) * {1 << 63}BD + place")
    least = rows.groupBy("h", "c").agg(F.min("doc").alias("first_doc"), F.min(both).alias("both"))
    return least.select("h", "c", "first_doc", F.expr(f"CAST(both - CAST(first_doc AS DECIMAL(19, 0)) * {1 << 63}BD AS BIGINT)").alias("first_place"))


def _per_document(rows: DataFrame) -> DataFrame:
    """(doc, tag, runs): flat (start, count) pairs of a document, each once; bounded by its length, however often the row stands."""
    place = F.col("place")
    start, count = F.shiftright(place, TAG_BITS + COUNT_BITS), F.shiftright(place, TAG_BITS).bitwiseAND(F.lit((1 << COUNT_BITS) - 1))
    return (rows.select(F.col("doc").alias("d"), place.bitwiseAND(F.lit((1 << TAG_BITS) - 1)).alias("t"),
                        (start * (1 << COUNT_BITS) + count).alias("run"))
            .groupBy("d", "t").agg(F.collect_set("run").alias("runs")))


def _attached(docs: DataFrame, runs: DataFrame, how: str) -> DataFrame:
    return docs.join(runs, (docs["doc"] == runs["d"]) & (docs["tag"] == runs["t"]), how).select("doc", "tag", "text", "runs")


def _parts(docs: DataFrame, rows: DataFrame, single: bool) -> DataFrame:
    """(h, c, doc, place) of the blocks, or of the single starts, that make up ``rows`` (doc, place)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, tag, text, runs in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                first, count = np.divmod(np.unique(np.array(runs, np.int64)), 1 << COUNT_BITS)
                if single:
                    first = np.repeat(first, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                for at, data in pieces(_bytes(text)):
                    here = first[(first >= at) & (first < at + len(data) - LENGTH + 1)] - at
                    if len(here):
                        out.append(_rows(doc, tag, at, (starts_of if single else blocks_of)(data, here)))
            if out:
                yield _batch(out)

    return _attached(docs, _per_document(rows), "inner").mapInArrow(run, ROWS)


def _refined(rows: DataFrame, name: str, last: bool = False) -> tuple[DataFrame, DataFrame | None]:
    """(doc, place) of the rows that repeat the first of their class, and, but for the last round, of first ones
    whose bucket h has several classes. ``rows`` is a written table; it is dropped once both results are written.
    """
    left = None
    classes = written(_classes(rows), f"{name}-classes")
    later = written(rows.join(classes, ["h", "c"]).where("doc > first_doc OR place > first_place").select("doc", "place"), f"{name}-repeats")
    release(rows.sparkSession)
    if not last:
        mixed = classes.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h")
        left = written(rows.join(classes.join(mixed, "h", "left_semi"), ["h", "c"]).where("doc = first_doc AND place = first_place")
                       .select("doc", "place").distinct(), f"{name}-left")
    discard(rows, classes)
    release(rows.sparkSession)
    return later, left


def repeated_starts(docs: DataFrame) -> DataFrame:
    """(doc, place) of all runs of starts whose 100-byte strings also start earlier. ``docs`` has doc, tag, text.

    Every round is written before the next one, which reads the texts again where it needs their bytes.
    """
    runs = written(_runs(docs), "runs")
    several = written(runs.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"), "repeated")
    release(docs.sparkSession)
    rows, repeats = written(runs.join(several, "h").select("h", "c", "doc", "place"), "repeated-runs"), []
    discard(runs, several)
    for before, name, single in (("runs", "blocks", False), ("blocks", "starts", True)):
        release(docs.sparkSession)
        later, left = _refined(rows, before)
        repeats.append(later)
        rows = written(_parts(docs, left, single), name)
        discard(left)
    release(docs.sparkSession)
    later, _ = _refined(rows, "starts", last=True)
    return repeats[0].unionByName(repeats[1]).unionByName(later)


def remove_repeats(docs: DataFrame, texts: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, kept bytes), one row per input row.

    Removed is every byte that a 100-byte string covers which also starts earlier: in a row with a smaller id, or in
    the same row. Texts are UTF-8 bytes; null is empty; shorter texts lose nothing. Rows that repeat both id and
    text are one document, and each gets its result; rows that share only the id come in order of start, then of their
    texts' hash (2**26 different texts of one id at most). A row
    whose id is null neither loses bytes nor takes them from others. An empty table gives an empty result.
    """
    bound_batches(docs.sparkSession)
    docs = _documents(docs, id_col, text_col)
    runs = _per_document(repeated_starts(docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, text, runs in zip(*(batch.column(c).to_pylist() for c in ("doc", "text", "runs")), strict=True):
                data = _bytes(text)
                keep = np.ones(len(data), bool)
                spans = 0
                if runs:
                    first, count = np.divmod(np.array(runs, np.int64), 1 << COUNT_BITS)
                    cover = np.zeros(len(data) + 1, np.int64)
                    np.add.at(cover, first, 1)
                    np.add.at(cover, first + count - 1 + LENGTH, -1)
                    keep = np.cumsum(cover[:-1]) == 0
                    spans = int(np.count_nonzero(~keep & np.concatenate(([True], keep[:-1]))))
                left = data[keep].tobytes()
                rows.append((doc, len(data), len(data) - len(left), spans, hashlib.sha256(left).hexdigest(), left if texts else None))
            types = [pa.int64()] * 4 + [pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)] if rows
                                             else [pa.array([], t) for t in types], names)

    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
    out = _attached(docs, runs, "left").mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    return out if texts else out.drop("kept")
