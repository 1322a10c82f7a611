"""Approximate nearest neighbours on robust-pruned directed graphs, one per shard of the vectors.

Points are inserted in random order and growing batches: a greedy search on the graph so far
proposes neighbours, pruning with a relaxed distance keeps those in different directions, and the reverse
edges are pruned alike. Every query is answered by a beam search in every shard; the best of
all shards are ranked by their exact similarity.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bound_batches

#: Vectors of a shard, on average: what one task holds, builds and searches.
SHARD = 8192
#: Different vector lengths up to which the table of their shards is broadcast.
LENGTHS = 10_000
#: Out-degree, beam while building, beam of a query, and the factor by which a kept neighbour must be nearer to hide another.
DEGREE, BUILD_BEAM, BEAM, ALPHA = 32, 64, 128, 1.2
#: Beam entries expanded at once, and points or queries handled at once.
EXPAND, BLOCK = 4, 256


@dataclass
class Graph:
    points: np.ndarray  #: unit vectors
    edges: np.ndarray  #: neighbours of each point, -1 where it has fewer
    entry: int

    def beam(self, queries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(points, squared distances) of the ``width`` nearest found for each query, nearest first; -1 where there are fewer."""
        n = len(queries)
        ids = np.full((n, width), -1)
        dist = np.full((n, width), np.inf, np.float32)
        done = np.ones((n, width), bool)
        seen = np.zeros((n, len(self.points) + 1), bool)  # the last column stands for -1
        ids[:, 0], done[:, 0] = self.entry, False
        dist[:, 0] = 2 - 2 * queries @ self.points[self.entry]
        seen[:, [self.entry, -1]] = True
        while not done.all():
            active = np.flatnonzero(~done.all(axis=1))
            at = np.argsort(np.where(done[active], np.inf, dist[active]), axis=1, kind="stable")[:, :EXPAND]
            fresh = ~np.take_along_axis(done[active], at, 1)
            done[active[:, None], at] = True
            near = np.where(fresh[:, :, None], self.edges[np.take_along_axis(ids[active], at, 1)], -1).reshape(len(active), -1)
            near.sort(axis=1)
            near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
            near[seen[active[:, None], near]] = -1
            seen[active[:, None], near] = True
            d = 2 - 2 * np.einsum("bkd,bd->bk", self.points[near], queries[active], optimize=True)
            d[near < 0] = np.inf
            all_ids, all_d = np.hstack([ids[active], near]), np.hstack([dist[active], d])
            all_done = np.hstack([done[active], near < 0])
            best = np.argsort(all_d, axis=1, kind="stable")[:, :width]
            ids[active], dist[active] = np.take_along_axis(all_ids, best, 1), np.take_along_axis(all_d, best, 1)
            done[active] = np.take_along_axis(all_done, best, 1) | np.isinf(dist[active])
        return ids, dist

    def prune(self, at: np.ndarray, candidates: np.ndarray) -> None:
        """Choose the neighbours of the points ``at`` among ``candidates`` (a row each, -1 for none)."""
        x = self.points
        candidates = np.sort(np.where(candidates == at[:, None], -1, candidates), axis=1)
        candidates[:, 1:][candidates[:, 1:] == candidates[:, :-1]] = -1
        d = 2 - 2 * np.einsum("bkd,bd->bk", x[candidates], x[at], optimize=True)
        d[candidates < 0] = np.inf
        order = np.argsort(d, axis=1, kind="stable")
        candidates, d = np.take_along_axis(candidates, order, 1), np.take_along_axis(d, order, 1)
        vectors = x[candidates]
        between = 2 - 2 * np.matmul(vectors, vectors.transpose(0, 2, 1))
        alive, rows = np.isfinite(d), np.arange(len(at))
        chosen = np.full((len(at), DEGREE), -1)
        for k in range(DEGREE):
            some = alive.any(axis=1)
            if not some.any():
                break
            pick = alive.argmax(axis=1)
            chosen[some, k] = candidates[rows, pick][some]
            alive &= ALPHA ** 2 * between[rows, pick] > d
            alive[rows, pick] = False
        self.edges[at] = chosen

    def add_reverse(self, at: np.ndarray) -> None:
        """Point the new neighbours of ``at`` back; where a point has no room left, prune."""
        target, source = self.edges[at].ravel(), np.repeat(at, DEGREE)
        source, target = source[target >= 0], target[target >= 0]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        points, first, count = np.unique(target, return_index=True, return_counts=True)
        for i in range(0, len(points), BLOCK):
            p, width = points[i:i + BLOCK], int(count[i:i + BLOCK].max())
            slot = first[i:i + BLOCK, None] + np.arange(width)
            new = np.where(np.arange(width) < count[i:i + BLOCK, None], source[np.minimum(slot, len(source) - 1)], -1)
            joined = np.hstack([self.edges[p], new])
            full = (joined >= 0).sum(axis=1) > DEGREE
            packed = -np.sort(-joined[~full], axis=1)[:, :DEGREE]
            self.edges[p[~full], :packed.shape[1]] = packed
            if full.any():
                self.prune(p[full], joined[full])


def build(points: np.ndarray, seed: int = 7) -> Graph:
    """The graph of distinct unit vectors."""
    n = len(points)
    order = np.random.default_rng(seed).permutation(n)
    entry = int(np.argmax(points @ points.mean(axis=0)))
    graph = Graph(points, np.full((n, DEGREE), -1), entry)
    order = order[order != entry]
    done, size = 0, 1
    while done < len(order):
        batch = order[done:done + size]
        ids, _ = graph.beam(points[batch], BUILD_BEAM)
        graph.prune(batch, ids)
        graph.add_reverse(batch)
        done += len(batch)
        size = min(2 * size, BLOCK, max(1, done // 4))
    return graph


class Shard:
    """A shard's index: the graph of its distinct vectors, and the rows that have each."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.lexsort((ids, *vectors.T[::-1]))
        ids, vectors = ids[order], vectors[order]
        self.first = np.flatnonzero(np.concatenate(([True], (vectors[1:] != vectors[:-1]).any(axis=1))))
        self.count = np.diff(np.append(self.first, len(ids)))
        self.ids, self.vectors = ids, vectors[self.first].astype(np.float64)
        self.norms = np.sqrt((self.vectors ** 2).sum(axis=1))
        self.graph = build((self.vectors / self.norms[:, None]).astype(np.float32))

    def search(self, ids: np.ndarray, queries: np.ndarray, k: int) -> list[tuple[int, int, float]]:
        """(query, id, cosine) of each query's best ``k`` rows found, its own not among them."""
        out: list[tuple[int, int, float]] = []
        for i in range(0, len(ids), BLOCK):
            q = queries[i:i + BLOCK].astype(np.float64)
            norms = np.sqrt((q ** 2).sum(axis=1))
            found, _ = self.graph.beam((q / norms[:, None]).astype(np.float32), BEAM)
            for own, v, norm, near in zip(ids[i:i + BLOCK].tolist(), q, norms, found, strict=True):
                near = near[near >= 0]
                cosine = (self.vectors[near] @ v) / (self.norms[near] * norm)
                rows = [(-c, r) for c, p in zip(cosine.tolist(), near.tolist(), strict=True)
                        for r in self.ids[self.first[p]:self.first[p] + min(self.count[p], k + 1)].tolist() if r != own]
                out += [(own, r, -c) for c, r in sorted(rows)[:k]]
        return out


def usable(vector: Column) -> Column:
    """Whether a vector is not null, not zero and has only finite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5, shard: int = SHARD, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` nearest rows of ``vectors`` found for each row of ``queries``.

    Nearness is the cosine in double precision on the vectors as given, ties go to the smaller id; candidates
    are all rows but those with the query's id. Vectors that are null, zero or hold null or non-finite
    components take no part, and vectors meet only others of their length. Equal vectors are one point of the
    graph. Rows that repeat an id count once. Empty tables give no rows.

    Shards are dealt at random and hold ``shard`` rows on average whatever the number of rows, so every task
    is bounded; queries stream through each shard's task in batches behind its vectors.
    """
    spark = vectors.sparkSession
    bound_batches(spark)

    def clean(df: DataFrame) -> DataFrame:
        v = F.col(vector_col).cast("array<double>")
        return df.where(usable(v) & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), v.alias("v"), F.size(v).alias("dim"))

    points = clean(vectors)
    shards = points.groupBy("dim").agg(F.ceil(F.count("*") / shard).cast("int").alias("shards"))
    number, lengths = shards.agg(F.coalesce(F.sum("shards"), F.lit(1)), F.count("*")).first()
    if lengths <= LENGTHS:  # one small row a length, so vectors are not dealt by their length
        shards = F.broadcast(shards)
    stored = points.join(shards, "dim").select("dim", F.pmod(F.xxhash64("id"), "shards").cast("int").alias("shard"), F.lit(0).alias("kind"), "id", "v")
    asked = (clean(queries).join(shards, "dim")
             .select("dim", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"), F.lit(1).alias("kind"), "id", "v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, index, ids, parts = None, None, [], []
        for batch in batches:
            of = np.stack([batch.column(c).to_numpy() for c in range(3)], axis=1)
            cuts = [0, *(np.flatnonzero((of[1:] != of[:-1]).any(axis=1)) + 1).tolist(), len(of)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if a == b:
                    continue
                if (of[a, 0], of[a, 1]) != key:
                    key, index, ids, parts = (of[a, 0], of[a, 1]), None, [], []
                own, matrix = batch.column(3)[a:b].to_numpy(), _matrix(batch.column(4)[a:b])
                if of[a, 2] == 0:
                    ids.append(own)
                    parts.append(matrix)
                elif ids or index:
                    if index is None:
                        index, ids, parts = Shard(np.concatenate(ids), np.concatenate(parts)), [], []
                    rows = index.search(own, matrix, k)
                    if rows:
                        q, r, s = zip(*rows, strict=True)
                        yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(r, pa.int64()), pa.array(s, pa.float64())],
                                                         ["query_id", "vec_id", "score"])

    # several partitions a shard, so that hashing seldom puts two shards into one
    found = (stored.unionByName(asked).repartition(4 * number, "dim", "shard").sortWithinPartitions("dim", "shard", "kind", "id")
             .mapInArrow(run, "query_id long, vec_id long, score double"))
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
