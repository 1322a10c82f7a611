"""Phrase collocations per language from exact n-gram counts.

The corpus is cut into chunks of about ``CHUNK`` words, each encoded with its own dictionary. Word counts are summed
over the chunks' dictionaries, frequent words are numbered, and every chunk gets the numbers of its own words back, so
no task holds the corpus's dictionary. Each chunk counts its n-grams in counting quotient filters, which are merged
across chunks in rounds: ``FAN`` chunks at a time, each round splitting the values by further leading bits, so that a
merge never reads more than about what one chunk holds.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import quotient_filter as qf
from .common import bound_batches, discard, written
from .positions import numbered

#: Words that a worker gathers before it writes the chunk of the language that has most of them, bytes of text split at
#: once, and leading bits a round splits by (2**8 chunks are merged at once).
CHUNK, SLICE, FAN_BITS = 2 << 20, 1 << 20, 8
#: Slices of a language's phrases that are ranked first, so that the last ranking gets a bounded number from all.
RANK_SLICES = 64
_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
_PLAIN = bytes.maketrans(_ENDS + b"\t", b"\n" * len(_ENDS) + b" ")
_CHUNK_SCHEMA = "lang string, chunk long, words array<string>, counts array<long>, codes binary"


class _Codes(dict):
    """Numbers words in the order of their first look-up; 0 is no word, 1 the end of a piece."""

    def __init__(self) -> None:
        super().__init__({b"": 0, b"\n": 1})

    def __missing__(self, word: bytes) -> int:
        self[word] = code = len(self)
        return code


def _slices(text: bytes) -> Iterator[bytes]:
    """The text, cut at ends of pieces."""
    at = 0
    while at < len(text):
        end = text.find(b"\n", at + SLICE)
        end = len(text) if end < 0 else end
        yield text[at:end]
        at = end


def _chunk_row(lang: str, number: int, words: _Codes, parts: list[np.ndarray]) -> pa.RecordBatch:
    codes = np.concatenate(parts)
    codes = codes[codes > 0] - 2
    counts = np.bincount(codes[codes >= 0], minlength=len(words) - 2)
    ends = pa.array([0, len(words) - 2], pa.int32())
    return pa.RecordBatch.from_arrays(
        [pa.array([lang], pa.string()), pa.array([number], pa.int64()), pa.ListArray.from_arrays(ends, pa.array(list(words)[2:], pa.binary()).cast(pa.string())),
         pa.ListArray.from_arrays(ends, pa.array(counts, pa.int64())), pa.array([codes.astype("<i4").tobytes()], pa.binary())],
        names=["lang", "chunk", "words", "counts", "codes"])


def _encoded(batches: Iterator[pa.RecordBatch], chunk: int) -> Iterator[pa.RecordBatch]:
    number, sizes, langs = TaskContext.get().partitionId() << 32, {}, {}
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
            for piece in _slices((text.as_py() or "").encode().lower().translate(_PLAIN)):
                words, parts = langs.setdefault(lang, (_Codes(), []))
                tokens = piece.replace(b"\n", b" \n ").split(b" ")
                parts += [np.fromiter(map(words.__getitem__, tokens), np.int32, len(tokens)), np.ones(1, np.int32)]
                sizes[lang] = sizes.get(lang, 0) + len(tokens)
                if sum(sizes.values()) >= chunk:
                    most = max(sizes, key=sizes.get)
                    yield _chunk_row(most, number, *langs.pop(most))
                    del sizes[most]
                    number += 1
    for lang, state in langs.items():
        yield _chunk_row(lang, number, *state)
        number += 1


def encode_chunks(docs: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(lang, chunk, words, counts, codes) of ``docs`` (lang, text): a chunk's number, dictionary, how often each word occurs, and
    the text as numbers of that dictionary, -1 at the ends of pieces. A piece is never cut; a null lang is ``und``."""
    return docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        lambda batches: _encoded(batches, chunk), _CHUNK_SCHEMA)


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True) if rows else [[]] * len(schema), schema, strict=True)], schema=schema)


_FILTERS = pa.schema([("lang", pa.string()), ("n", pa.int32()), ("shard", pa.int64()), ("batch", pa.int64()), ("filter", pa.binary())])
_FILTER_SCHEMA = "lang string, n int, shard long, batch long, filter binary"


def _chunk_filters(max_words: int, batches: int, fan_bits: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Filters of one chunk's n-grams by their first bits; n-grams with a word without number are not counted."""
    def filters(codes: pa.Table, numbers: pa.Table) -> pa.Table:
        rows = []
        if len(codes) and len(numbers):
            bits = max(1, (codes["total"][0].as_py() - 1).bit_length())
            local = np.frombuffer(codes["codes"][0].as_py(), "<i4")
            known = np.full(max(int(local.max(initial=0)), pc.max(numbers["local"]).as_py()) + 2, -1, np.int64)
            known[numbers["local"].to_numpy()] = numbers["id"].to_numpy()
            ids = known[local]  # -1 takes the last place, which has no number
            batch = (codes["chunk"][0].as_py() * 0x9E3779B97F4A7C15 % (1 << 64) >> 32) % batches
            for n in range(2, max_words + 1):
                whole = np.logical_and.reduce([ids[k:max(0, len(ids) - n + 1) + k] >= 0 for k in range(n)])
                at = np.flatnonzero(whole)
                values = qf.counted(*qf.permute(*qf.pack([ids[at + k] for k in range(n)], bits), n, bits))
                rows += [(codes["lang"][0].as_py(), n, lead, batch, data) for lead, data in qf.split(*values, n, bits, 0, fan_bits)]
        return _table(rows, _FILTERS)
    return filters


def _merged(fan_bits: int) -> Callable[[pa.Table], pa.Table]:
    """One merge of a round, split by further bits."""
    def merged(part: pa.Table) -> pa.Table:
        n, bits, prefix = qf.shape(part["filter"][0].as_py())
        lang, batch = part["lang"][0].as_py(), part["batch"][0].as_py() >> fan_bits
        return _table([(lang, n, lead, batch, data) for lead, data in qf.split(*qf.merge(part["filter"].to_pylist()), n, bits, prefix, fan_bits)], _FILTERS)
    return merged


def _frequent(min_count: int) -> Callable[[pa.Table], pa.Table]:
    """The last merge: n-grams of at least ``min_count`` as arrays of ids."""
    def frequent(part: pa.Table) -> pa.Table:
        n, bits, _ = qf.shape(part["filter"][0].as_py())
        high, low, counts = qf.merge(part["filter"].to_pylist())
        keep = counts >= min_count
        ids = np.stack(qf.unpack(*qf.permute(high[keep], low[keep], n, bits, back=True), n, bits), axis=1)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(ids) + 1) * n, pa.int32()), pa.array(ids.ravel(), pa.int64()))
        return pa.Table.from_arrays([pa.array([part["lang"][0].as_py()] * len(ids), pa.string()), lists, pa.array(counts[keep], pa.int64())],
                                    names=["lang", "ids", "a"])
    return frequent


def phrase_counts(chunks: DataFrame, vocabulary: DataFrame, max_words: int, min_count: int, fan_bits: int = FAN_BITS) -> DataFrame:
    """(lang, ids, a) of the n-grams of 2 to ``max_words`` words that occur ``min_count`` times or more, exactly."""
    words = chunks.select("lang", "chunk", F.posexplode("words").alias("local", "word"))
    numbers = words.join(vocabulary, ["lang", "word"]).select(F.col("chunk").alias("_chunk"), "local", "id")
    sizes = vocabulary.groupBy("lang").agg(F.count("*").alias("total"))
    most = chunks.groupBy("lang").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    batches = -(-most // (1 << fan_bits)) or 1
    filters = (chunks.select("lang", "chunk", "codes").join(sizes, "lang").groupBy("chunk").cogroup(numbers.groupBy("_chunk"))
               .applyInArrow(_chunk_filters(max_words, batches, fan_bits), _FILTER_SCHEMA))
    groups = ["lang", "n", "shard", "batch"]
    while batches > 1:
        filters = filters.groupBy(*groups).applyInArrow(_merged(fan_bits), _FILTER_SCHEMA)
        batches = (batches - 1 >> fan_bits) + 1
    return filters.groupBy(*groups).applyInArrow(_frequent(min_count), "lang string, ids array<long>, a long")


def best_cuts(phrases: DataFrame, words: DataFrame, scale: int = 1_000_000) -> DataFrame:
    """``phrases`` (lang, ids, a) with l, r and score of the cut that scores lowest, the shortest first part on ties.

    ``words`` has (lang, ids, a) of single words. The score is floor(scale * a * a / (l * r)) in decimals of 38 digits;
    counts up to 10**15 fit.
    """
    parts = phrases.unionByName(words)
    cuts = phrases.select("*", F.explode(F.expr("sequence(1, size(ids) - 1)")).alias("k"))
    for name, piece in (("l", "slice(ids, 1, k)"), ("r", "slice(ids, k + 1, size(ids) - k)")):
        part = parts.select("lang", F.col("ids").alias("_part"), F.col("a").alias(name))
        cuts = cuts.withColumn("_part", F.expr(piece)).join(part, ["lang", "_part"]).drop("_part")
    score = F.expr(f"(CAST(a AS decimal(38,0)) * a * {scale}) DIV (CAST(l AS decimal(38,0)) * r)")
    return (cuts.withColumn("score", score).groupBy("lang", "ids", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("_best"))
            .select("lang", "ids", "a", "_best.l", "_best.r", "_best.score"))


def covered(phrases: DataFrame, share: int = 50) -> DataFrame:
    """(lang, ids) of phrases whose words lie inside a longer phrase that occurs ``share`` percent as often or more."""
    inner = F.expr("flatten(transform(sequence(2, size(ids) - 1), n -> transform(sequence(1, size(ids) - n + 1), i -> slice(ids, i, n))))")
    longer = (phrases.where(F.size("ids") > 2).select("lang", F.explode(inner).alias("ids"), F.col("a").alias("_more"))
              .groupBy("lang", "ids").agg(F.max("_more").alias("_more")))
    return phrases.join(longer, ["lang", "ids"]).where(100 * F.col("_more") >= share * F.col("a")).select("lang", "ids")


def mine(docs: DataFrame, max_words: int = 3, min_count: int = 10, share: int = 50, top: int = 2000, chunk: int = CHUNK,
         fan_bits: int = FAN_BITS) -> DataFrame:
    """The ``top`` phrases of every lang: lang, rank, phrase, a, l, r, n, score; numbers are longs.

    ``docs`` has (lang, text); other columns are not read, repeated rows count each. Texts are lower-cased in A-Z and cut into
    pieces at ``.,;:!?`` and line ends, pieces into words at spaces and tabs. A null lang is ``und``, a null text empty; an empty table,
    or one without a phrase of ``min_count``, gives no rows. n counts all words of the lang, a the phrase, l and r its parts at the best cut.
    Phrases inside a longer one that occurs ``share`` percent as often go. Order: score, then a, descending, then phrase by code point.

    Only words of ``min_count`` are numbered: a phrase occurs at most as often as its rarest word. Texts of any length are
    split piece by piece; a worker holds one chunk and one piece.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    chunks = written(encode_chunks(docs, chunk), "chunks")
    frequency = (chunks.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("_w"))
                 .groupBy("lang", F.col("_w.words").alias("word")).agg(F.sum("_w.counts").alias("f")))
    frequency = written(frequency, "frequency")
    totals = frequency.groupBy("lang").agg(F.sum("f").alias("n"))
    vocabulary = written(numbered(frequency.where(F.col("f") >= min_count), "lang", ["word"]).withColumnRenamed("position", "id"), "vocabulary")
    phrases = written(phrase_counts(chunks, vocabulary.select("lang", "word", "id"), max_words, min_count, fan_bits), "phrases")
    discard(chunks)
    scored = best_cuts(phrases, vocabulary.select("lang", F.array("id").alias("ids"), F.col("f").alias("a")))
    order = [F.col("score").desc(), F.col("a").desc()]
    first = (scored.join(covered(phrases, share), ["lang", "ids"], "left_anti")
             .withColumn("_slice", F.pmod(F.xxhash64("ids"), F.lit(RANK_SLICES))))
    for by in (["lang", "_slice"], ["lang"]):
        first = first.withColumn("_place", F.rank().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("_place") <= top)
    named = (first.select("*", F.posexplode("ids").alias("_k", "id")).join(vocabulary.select("lang", "id", "word"), ["lang", "id"])
             .groupBy("lang", "ids", "a", "l", "r", "score").agg(F.sort_array(F.collect_list(F.struct("_k", "word"))).alias("_words"))
             .withColumn("phrase", F.array_join("_words.word", " ")))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order, "phrase"))
    return (named.withColumn("rank", rank.cast("long")).where(F.col("rank") <= top).join(totals, "lang")
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
