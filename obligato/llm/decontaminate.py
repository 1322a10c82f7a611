"""Benchmark decontamination: one FM-index per training shard, backward-searched for benchmark phrases."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, discard, words_of, written
from .fmindex import FMIndex

#: Benchmark text handled in one pass over the documents; a larger benchmark takes several.
BLOCK_BYTES = 16 << 20
#: Rows of occurrences located at once.
ROWS = 1 << 20
#: Symbols: 0 ends the shard, 1 stands for what cannot be part of a match, words follow.
GAP, FIRST_WORD = 1, 2


@dataclass
class Phrases:
    """Windows of a block of benchmark items, by length, and the items that hold them."""

    vocabulary: dict[bytes, int]
    windows: dict[int, np.ndarray]  #: length -> distinct windows, one a row
    holders: dict[int, list[list[int]]]  #: length -> per window the items' numbers
    items: list[str | None]

    @property
    def shortest(self) -> int:
        return min(self.windows, default=0)


def phrases(items: list[tuple[str | None, bytes | None]], window: int) -> Phrases:
    """The windows of ``window`` consecutive words; an item with fewer words is one window."""
    vocabulary: dict[bytes, int] = {}
    found: dict[int, dict[tuple[int, ...], list[int]]] = {}
    for number, (_, text) in enumerate(items):
        ids = [vocabulary.setdefault(w, len(vocabulary) + FIRST_WORD) for w in words_of(text)]
        length = min(window, len(ids))
        for i in range(len(ids) - length + 1 if ids else 0):
            holders = found.setdefault(length, {}).setdefault(tuple(ids[i:i + length]), [])
            if not holders or holders[-1] != number:
                holders.append(number)
    return Phrases(vocabulary, {n: np.array(list(w), np.int64) for n, w in found.items()},
                   {n: list(w.values()) for n, w in found.items()}, [i for i, _ in items])


def _shard(texts: list[bytes | None], p: Phrases):
    """The shard's sequence: runs of benchmark words long enough to hold a window, each with a gap before it.

    Words that no benchmark item has, and shorter runs, cannot be part of a match, so one gap
    symbol stands for them. Returns symbols, the document and the word number of each, and word counts.
    """
    symbols, owner, place, counts = [np.array([GAP])], [np.array([0])], [np.array([0])], []
    get = p.vocabulary.get
    for d, text in enumerate(texts):
        words = words_of(text)
        counts.append(len(words))
        ids = np.zeros(len(words) + 2, np.int64)
        ids[1:-1] = np.fromiter((get(w, 0) for w in words), np.int64, len(words))
        edge = np.flatnonzero(np.diff((ids > 0).astype(np.int8)))
        for a, b in zip(edge[::2], edge[1::2], strict=True):
            if p.shortest and b - a >= p.shortest:
                symbols.append(np.append(ids[a + 1:b + 1], GAP))
                owner.append(np.full(b - a + 1, d))
                place.append(np.arange(a, b + 1))
    return np.concatenate(symbols), np.concatenate(owner), np.concatenate(place), counts


def search_shard(texts: list[bytes | None], p: Phrases) -> tuple[list[int], list[list[int]], list[list[int]]]:
    """Per text: its number of words, merged hit spans (flat start, end word numbers) and the items found in it."""
    symbols, owner, place, counts = _shard(texts, p)
    spans: list[list[int]] = [[] for _ in texts]
    items: list[set[int]] = [set() for _ in texts]
    if len(symbols) > 1:
        index = FMIndex(symbols)
        cover = np.zeros(len(symbols) + 1, np.int64)
        for length, windows in p.windows.items():
            low, high = index.search(windows)
            hit = np.flatnonzero(high > low)
            ends = np.cumsum(high[hit] - low[hit])
            for start in range(0, int(ends[-1]) if len(ends) else 0, ROWS):
                nth = np.arange(start, min(start + ROWS, int(ends[-1])))
                which = np.searchsorted(ends, nth, side="right")
                rows = high[hit[which]] - (ends[which] - nth)
                at = index.locate(rows)
                np.add.at(cover, at, 1)
                np.add.at(cover, at + length, -1)
                for d, w in np.unique(np.stack([owner[at], hit[which]], axis=1), axis=0).tolist():
                    items[d].update(p.holders[length][w])
        covered = np.concatenate(([False], np.cumsum(cover[:-1]) > 0, [False]))
        edge = np.flatnonzero(np.diff(covered.astype(np.int8)))
        for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
            spans[owner[a]] += [int(place[a]), int(place[b - 1]) + 1]
    return counts, spans, [sorted(i) for i in items]


def _merged(spans: list[int]) -> list[int]:
    out: list[int] = []
    for a, b in sorted(zip(spans[::2], spans[1::2], strict=True)):
        if out and a <= out[-1]:
            out[-1] = max(out[-1], b)
        else:
            out += [a, b]
    return out


def _blocks(benchmark: DataFrame, item_col: str, text_col: str) -> Iterator[tuple[list[tuple[str | None, bytes | None]], bool]]:
    """The benchmark in blocks of about BLOCK_BYTES, the only part of it that the driver holds at a time, and whether more follow."""
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).cast("binary").alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // BLOCK_BYTES) or 1
    part = F.pmod(F.xxhash64("item", "text"), F.lit(n))
    for i in range(n):
        yield [(r.item, None if r.text is None else bytes(r.text)) for r in items.where(part == i).toLocalIterator()], i + 1 < n


def _searched(df: DataFrame, block: list[tuple[str | None, bytes | None]], window: int) -> DataFrame:
    """``df`` with one block's hits added."""
    p = phrases(block, window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, spans, found = search_shard(batch.column("text").to_pylist(), p)
            spans = [_merged(a + b) for a, b in zip(batch.column("spans").to_pylist(), spans, strict=True)]
            names = [sorted({*a, *(p.items[i] for i in b if p.items[i] is not None)})
                     for a, b in zip(batch.column("items").to_pylist(), found, strict=True)]
            new = {"n_words": pa.array(counts, pa.int64()), "spans": pa.array(spans, pa.list_(pa.int32())),
                   "n_hit": pa.array([sum(s[1::2]) - sum(s[::2]) for s in spans], pa.int64()),
                   "items": pa.array(names, pa.list_(pa.string()))}
            yield pa.RecordBatch.from_arrays([new.get(c, batch.column(c)) for c in batch.schema.names], batch.schema.names)

    return df.mapInArrow(run, df.schema)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10, keep: tuple[str, ...] = (),
                  id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_hit, spans, items, *keep), one row per row of ``docs``.

    ``spans`` are the maximal runs of hit words (start, end word numbers, flat), ``items`` the
    sorted ids (as strings) of the items that occur. A shard is one Arrow batch; it is indexed once per
    benchmark block; the table is written after each block but the last, so blocks follow each other without a shuffle. Null and empty texts have no
    words and no hits. Items without words are ignored; repeated items count once; the hits of an
    item whose id is null count, but it is in no list. Repeated documents each get their row; an empty
    benchmark gives rows without hits, an empty table none.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    kept = [f"keep_{i}" for i in range(len(keep))]
    df = docs.select(F.col(id_col).alias("doc_id"), F.lit(0).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_hit"),
                     F.array().cast("array<int>").alias("spans"), F.array().cast("array<string>").alias("items"),
                     F.col(text_col).cast("binary").alias("text"), *[F.col(c).alias(k) for c, k in zip(keep, kept, strict=True)])
    earlier = None
    for block, more in _blocks(benchmark, item_col, item_text):
        df = _searched(df, block, window)
        del block
        if more:  # written, so that neither plan nor tasks hold a block besides the next one
            df = written(df, "searched")
            if earlier is not None:
                discard(earlier)
            earlier = df
    return df.select("doc_id", "n_words", "n_hit", "spans", "items", *[F.col(k).alias(c) for c, k in zip(keep, kept, strict=True)])


def clean_documents(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """The rows of ``docs`` in which no benchmark window occurs; all columns."""
    found = contamination(docs.select(F.col("doc_id").alias("_id"), F.struct("*").alias("_row")).select("_id", "_row", F.col("_row.text").alias("_text")),
                          benchmark, window, keep=("_row",), id_col="_id", text_col="_text")
    return found.where("n_hit = 0").select("_row.*")
