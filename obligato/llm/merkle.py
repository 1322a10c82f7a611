"""Merkle manifest of a table: one ternary hash tree per source, one tree over the sources' roots.

A tree is stored as blocks: aligned subtrees of ``height`` levels above their leaves, each a row that holds its nodes in
van Emde Boas order (the tree is split at half its height, the top part stored first, then every lower part, each in
the same order again). Node addresses are computed, not stored; building and the retrieval of siblings use the same
arithmetic. The roots of a tier's blocks are the leaves of the next tier, until a tree has one block.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, written
from .positions import numbered

#: Children of a node, bytes of a digest, levels of a block above its leaves (3**6 leaves).
ARITY, DIGEST, HEIGHT = 3, 32, 6


def tree_size(levels: int) -> int:
    """Nodes of a complete tree."""
    return (ARITY**levels - 1) // (ARITY - 1)


def address(levels: int, depth: int, index: np.ndarray) -> np.ndarray:
    """Places of the nodes ``index`` at ``depth`` (the root is 0) of a complete tree in van Emde Boas order."""
    if levels == 1:
        return np.zeros_like(index)
    top = levels // 2
    if depth < top:
        return address(top, depth, index)
    below, width = levels - top, ARITY ** (depth - top)
    return tree_size(top) + index // width * tree_size(below) + address(below, depth - top, index % width)


@functools.cache
def _level(levels: int, depth: int) -> np.ndarray:
    return address(levels, depth, np.arange(ARITY**depth, dtype=np.int64))


def height_of(leaves: int) -> int:
    """Levels above the leaves until one node remains."""
    height = 0
    while ARITY**height < leaves:
        height += 1
    return height


def parent(children: list[bytes]) -> bytes:
    """Digest of the children's digests as concatenated hex text."""
    return sha256(b"".join(children).hex().encode()).digest()


def build_block(leaves: list[bytes], height: int) -> bytes:
    """The nodes of the subtree over ``leaves`` in van Emde Boas order; places without a node are zero."""
    store = np.zeros((tree_size(height + 1), DIGEST), np.uint8)
    level = leaves
    for depth in range(height, -1, -1):
        store[_level(height + 1, depth)[:len(level)]] = np.frombuffer(b"".join(level), np.uint8).reshape(-1, DIGEST)
        level = [parent(level[i:i + ARITY]) for i in range(0, len(level), ARITY)] if depth else level
    return store.tobytes()


def block_paths(store: bytes, height: int, leaves: int) -> list[bytes]:
    """For every leaf the steps from it to the block's root: its place in the run, number of siblings, siblings."""
    nodes = np.frombuffer(store, np.uint8).reshape(-1, DIGEST)
    paths, index, count = [b""] * leaves, list(range(leaves)), leaves
    for depth in range(height, 0, -1):
        level = nodes[_level(height + 1, depth)[:count]].tobytes()
        steps = []
        for i in range(count):
            start = i - i % ARITY
            end = min(start + ARITY, count)
            steps.append(bytes((i - start, end - start - 1)) + level[start * DIGEST:i * DIGEST] + level[(i + 1) * DIGEST:end * DIGEST])
        paths = [p + steps[i] for p, i in zip(paths, index, strict=True)]
        index, count = [i // ARITY for i in index], -(-count // ARITY)
    return paths


def steps_of(path: bytes) -> Iterator[tuple[int, list[bytes]]]:
    at = 0
    while at < len(path):
        place, n = path[at], path[at + 1]
        yield place, [path[at + 2 + DIGEST * k:at + 2 + DIGEST * (k + 1)] for k in range(n)]
        at += 2 + DIGEST * n


def fold(leaf: bytes, path: bytes) -> bytes:
    """The root that a leaf and its path give."""
    for place, siblings in steps_of(path):
        leaf = parent([*siblings[:place], leaf, *siblings[place:]])
    return leaf


def proof(path: bytes) -> bytes:
    """Digest of the path's siblings as concatenated hex text."""
    return sha256(b"".join(s for _, siblings in steps_of(path) for s in siblings).hex().encode()).digest()


def _lists(column: pa.ListArray) -> tuple[np.ndarray, pa.StructArray]:
    return column.offsets.to_numpy() - column.offsets[0].as_py(), column.flatten()


def _built(per: int, batches: Iterator[pa.RecordBatch], items: pa.DataType) -> Iterator[pa.RecordBatch]:
    height = height_of(per)
    for batch in batches:
        offsets, leaves = _lists(batch.column("leaves"))
        digests = leaves.field("digest").to_pylist()
        heights, stores, roots = [], [], []
        for total, a, b in zip(batch.column("total").to_pylist(), offsets, offsets[1:], strict=False):
            heights.append(height if total > per else height_of(total))
            stores.append(build_block(digests[a:b], heights[-1]))
            roots.append(stores[-1][:DIGEST])
        kept = pa.StructArray.from_arrays([leaves.field(f.name).cast(f.type) for f in items], names=[f.name for f in items])
        yield pa.RecordBatch.from_arrays(
            [batch.column("tree"), batch.column("block"), batch.column("total"), pa.array(heights, pa.int32()),
             pa.array(stores, pa.binary()), pa.array(roots, pa.binary()), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), kept)],
            names=["tree", "block", "total", "height", "nodes", "root", "items"])


def build_tiers(nodes: DataFrame, height: int = HEIGHT) -> list[DataFrame]:
    """Written tables of blocks, lowest tier first, of the trees over ``nodes`` (tree, position, total, digest, item).

    A block is (tree, block, total, height, nodes, root, items): total is the tree's number of nodes at the tier's
    leaves, items the leaves' ``item`` structs in order. A group of the aggregate is one block's leaves.
    """
    bound_batches(nodes.sparkSession)
    per, tiers = ARITY**height, []
    while True:
        item_type = nodes.schema["item"].dataType
        arrow = pa.struct([(f.name, {"bigint": pa.int64(), "binary": pa.binary()}.get(f.dataType.simpleString(), pa.string())) for f in item_type])
        blocks = (nodes.groupBy("tree", "total", F.expr(f"position DIV {per}").alias("block"))
                  .agg(F.sort_array(F.collect_list(F.struct("position", "digest", *[F.col(f"item.{f.name}") for f in item_type]))).alias("leaves"))
                  .mapInArrow(lambda batches, a=arrow: _built(per, batches, a),
                              f"tree string, block long, total long, height int, nodes binary, root binary, items array<{item_type.simpleString()}>"))
        tiers.append(written(blocks, "merkle"))
        most = tiers[-1].agg(F.max("total")).first()[0]
        if (most or 0) <= per:
            return tiers
        nodes = (tiers[-1].where(F.col("total") > per)
                 .select("tree", F.col("block").alias("position"), F.expr(f"(total + {per - 1}) DIV {per}").alias("total"),
                         F.col("root").alias("digest"), F.struct(F.col("block").alias("child")).alias("item")))


def _expanded(batches: Iterator[pa.RecordBatch], carry: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        offsets, items = _lists(batch.column("items"))
        counts = np.diff(offsets)
        paths = []
        for store, h, n, above in zip(*(batch.column(c).to_pylist() for c in ("nodes", "height")), counts.tolist(),
                                      batch.column("path").to_pylist(), strict=True):
            paths += [p + above for p in block_paths(store, h, n)]
        rows = pa.array(np.repeat(np.arange(len(counts)), counts))
        yield pa.RecordBatch.from_arrays([items, pa.array(paths, pa.binary()), *[batch.column(c).take(rows) for c in carry]],
                                         names=["item", "path", *carry])


def expand(blocks: DataFrame, carry: list[str]) -> DataFrame:
    """(item, path, *carry) of every leaf of ``blocks`` joined with their own path upwards."""
    item = blocks.schema["items"].dataType.elementType.simpleString()
    carried = "".join(f", {c} {blocks.schema[c].dataType.simpleString()}" for c in carry)
    return (blocks.select("nodes", "height", "items", "path", *carry)
            .mapInArrow(lambda batches: _expanded(batches, carry), f"item {item}, path binary{carried}"))


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        offsets, items = _lists(batch.column("items"))
        ids, given = items.field("doc_id"), items.field("given").to_pylist()
        out = {"leaf": [], "subroot": [], "root": [], "proof_sha256": [], "folded_root": []}
        for k, row in enumerate(batch.select(["nodes", "height", "path", "subroot", "root"]).to_pylist()):
            n, above = int(offsets[k + 1] - offsets[k]), functools.cache(lambda digest, path=row["path"]: fold(digest, path))
            level = np.frombuffer(row["nodes"], np.uint8).reshape(-1, DIGEST)[_level(row["height"] + 1, row["height"])[:n]]
            paths = block_paths(row["nodes"], row["height"], n)
            for i, leaf in enumerate(map(bytes, level)):
                changed = given[offsets[k] + i]
                out["leaf"].append(leaf.hex())
                out["proof_sha256"].append(proof(paths[i] + row["path"]).hex())
                out["folded_root"].append(above(fold(leaf if changed is None else changed, paths[i])).hex())
            out["subroot"] += [row["subroot"].hex()] * n
            out["root"] += [row["root"].hex()] * n
        yield pa.RecordBatch.from_arrays([ids, *[pa.array(v, pa.string()) for v in out.values()]], names=["doc_id", *out])


def _field(c: Column) -> Column:
    text = c.cast("string")
    return F.when(c.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(*values: Column) -> Column:
    """SHA-256 (binary) of the values, each as ``-`` or byte count, colon and text."""
    return F.unhex(F.sha2(F.concat(*map(_field, values)), 256))


def without_line_feeds(docs: DataFrame) -> Column:
    """The query's tampering: in documents whose id has an even CRC-32, the line feeds go. Null where nothing changes."""
    touched = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0) & F.contains("text", F.lit("\n"))
    return F.when(touched, F.replace("text", F.lit("\n"), F.lit("")))


def manifest(docs: DataFrame, tampered: Column | None = None, height: int = HEIGHT) -> DataFrame:
    """Leaf, subroot, root, proof digest and recomputed root of every row of ``docs`` (doc_id, source, lang, n_chars, text).

    ``tampered`` gives the text that a row is verified with, null for its own; the trees are always built of the original
    rows. Leaves of a source stand by doc_id, null first, rows of one id by their digest; equal rows are leaves each.
    A null source is a source of its own, before all others. An empty table gives no rows; other columns are not read.
    Every row's place comes from prefix counts of sorted ranges, every block is one bounded group, and a leaf's path
    above its block is made once per block, top down, so a source with most of the rows is spread like any other.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    changed = F.lit(None).cast("string") if tampered is None else tampered
    rows = docs.select(F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("tree"), F.col("doc_id").cast("long").alias("doc_id"),
                       leaf_digest(*fields, F.col("text")).alias("digest"), *fields[1:], changed.alias("_text"), F.col("doc_id").alias("_id"))
    rows = rows.select("tree", "doc_id", "digest", F.when(F.col("_text").isNotNull(), leaf_digest(F.col("_id"), *fields[1:], F.col("_text"))).alias("given"))
    leaves = numbered(rows, "tree", ["doc_id", "digest"]).withColumn("item", F.struct("doc_id", "given"))
    tiers = build_tiers(leaves, height)
    per = ARITY**height
    roots = [t.where(F.col("total") <= per).select(F.col("tree").alias("name"), F.col("root").alias("digest"), F.lit(k).alias("tier"))
             for k, t in enumerate(tiers)]
    roots = functools.reduce(DataFrame.unionByName, roots).withColumn("tree", F.lit("top"))
    over = build_tiers(numbered(roots, "tree", ["name"]).withColumn("item", F.struct("name", F.col("digest").alias("subroot"), F.col("tier").cast("long").alias("tier"))), height)
    above = over[-1].select("tree", "block", F.lit(b"").alias("path"), F.col("root").alias("_root"))
    for k in range(len(over) - 1, -1, -1):
        down = expand(over[k].drop("root").join(above, ["tree", "block"]).withColumnRenamed("_root", "root"), ["tree", "root"])
        above = down.select("tree", F.col("item.child").alias("block"), "path", F.col("root").alias("_root")) if k else down
    tops = above.select(F.col("item.name").alias("tree"), F.lit(0).cast("long").alias("block"), "path", "item.subroot", "root", "item.tier")
    paths = None
    for k in range(len(tiers) - 1, -1, -1):
        mine = tops.where(F.col("tier") == k).drop("tier")
        paths = mine if paths is None else mine.unionByName(paths)
        blocks = tiers[k].drop("root").join(paths, ["tree", "block"])
        if k:
            paths = expand(blocks, ["tree", "subroot", "root"]).select("tree", F.col("item.child").alias("block"), "path", "subroot", "root")
    out = blocks.select("nodes", "height", "items", "path", "subroot", "root").mapInArrow(
        _verified, "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string")
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
