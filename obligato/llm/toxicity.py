"""Toxicity by a classifier chain of linear models over words.

Each category has a logistic model over the presence of words and word beginnings and over the probabilities of the
categories before it. Later models are trained with out-of-fold probabilities of the earlier ones, so
that they meet the errors those make on new texts; at prediction the chain runs through in order.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, free_name, words_of, written

#: Labelled documents that the chain is fitted on at most: those with the smallest hashes of their ids.
SAMPLE = 12_000
#: Bytes of a longer word's beginning, which tells families of inflected or compounded words.
BEGINNING = 4
#: Words and beginnings that the models look at: those that tell most about any category, by chi-square, if in so many of the sample's
#: documents and above CHI, so that a mislabelled document's rare words do not count as signs. A category's
#: model takes those that tell about it.
FEATURES, LEAST, CHI = 224, 8, 30.0
FOLDS, RIDGE, STEPS = 5, 0.1, 25


@dataclass
class Model:
    """weights: words, then earlier categories; threshold: the probability from which the category holds."""

    name: str
    weights: np.ndarray
    bias: float
    threshold: float


@dataclass
class Chain:
    signs: dict[bytes, int]
    models: list[Model]

    def probabilities(self, found: list[np.ndarray]) -> np.ndarray:
        """(texts, categories) from the feature numbers of each text."""
        out = np.zeros((len(found), len(self.models)))
        n = len(self.signs)
        text = np.repeat(np.arange(len(found)), [len(f) for f in found])
        every = np.concatenate([*found, np.zeros(0, np.int64)]).astype(np.int64)
        for k, m in enumerate(self.models):
            score = m.bias + np.bincount(text, m.weights[every], len(found)) + out[:, :k] @ m.weights[n:]
            out[:, k] = _sigmoid(score)
        return out

    def features(self, text: bytes | None) -> np.ndarray:
        return np.array(sorted(map(self.signs.__getitem__, signs_of(text).intersection(self.signs.keys()))), np.int64)


def signs_of(text: bytes | None) -> set[bytes]:
    """The different words of a text, and the beginnings of its longer ones (marked with a tilde, which no word has)."""
    words = set(words_of(text))
    return words | {w[:BEGINNING] + b"~" for w in words if len(w) > BEGINNING}


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def _fit(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Ridge logistic regression by Newton steps; the bias has next to no penalty."""
    x = np.column_stack([x, np.ones(len(x))])
    penalty = np.append(np.full(x.shape[1] - 1, RIDGE), 1e-3)
    w = np.zeros(x.shape[1])
    for _ in range(STEPS):
        p = _sigmoid(x @ w)
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + np.diag(penalty), x.T @ (y - p) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


def _threshold(p: np.ndarray, y: np.ndarray) -> float:
    """Halfway between 0.5 and the cut between two out-of-fold probabilities that has the best F1."""
    if y.min() == y.max():
        return 0.5
    order = np.argsort(-p, kind="stable")
    p, hits = p[order], np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, len(y) + 1) + hits[-1])
    f1[:-1][p[:-1] == p[1:]] = -1  # no cut within a tie
    best = int(np.argmax(f1))
    cut = (p[best] + (p[best + 1] if best + 1 < len(p) else 0)) / 2
    return float((cut + 0.5) / 2)


def fit_models(x: np.ndarray, labels: np.ndarray, fold: np.ndarray, names: list[str], own: np.ndarray | None = None) -> list[Model]:
    """The chain's models in order: ``labels`` has a column per category, ``fold`` the fold of each row, ``own`` tells
    which features each category uses (all, if None)."""
    models, earlier = [], np.zeros((len(x), 0))
    for k, (name, y) in enumerate(zip(names, labels.T, strict=True)):
        used = np.ones(x.shape[1], bool) if own is None else own[k]
        inputs, held_out = np.column_stack([x[:, used], earlier]), np.zeros(len(x))
        for f in np.unique(fold):
            w, b = _fit(inputs[fold != f], y[fold != f])
            held_out[fold == f] = _sigmoid(inputs[fold == f] @ w + b)
        w, bias = _fit(inputs, y)
        weights = np.zeros(x.shape[1] + k)
        weights[np.append(used, np.ones(k, bool))] = w
        models.append(Model(name, weights, bias, _threshold(held_out, y)))
        earlier = np.column_stack([earlier, held_out])
    return models


def fit_chain(docs: DataFrame, labels: DataFrame, categories: dict[str, str], sample: int = SAMPLE,
              id_col: str = "doc_id", text_col: str = "text") -> Chain:
    """Fit the chain on a bounded sample of labelled documents.

    ``categories`` maps names, in chain order, to SQL conditions on columns of ``labels``. Labels where a
    condition is null are not used; of repeated labels any that holds counts. Word counts for choosing the
    features are made by Spark; the driver gets ``sample`` short lists of feature numbers at most.
    Without labelled documents every probability is 0.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    names = list(categories)
    known = (labels.select(F.col(id_col).cast("long").alias("id"), *[F.expr(c).cast("int").alias(f"y{i}") for i, c in enumerate(categories.values())])
             .dropna().groupBy("id").agg(*[F.max(f"y{i}").alias(f"y{i}") for i in range(len(names))])
             .orderBy(F.xxhash64("id"), "id").limit(sample))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    # broadcast: ``sample`` rows of integers at most
    chosen = texts.join(F.broadcast(known), "id").dropDuplicates(["id"])

    @F.arrow_udf("array<binary>")
    def signs(text: pa.Array) -> pa.Array:
        return pa.array([sorted(signs_of(t)) for t in text.to_pylist()], pa.list_(pa.binary()))

    ys = [f"y{i}" for i in range(len(names))]
    rows = written(chosen.select("id", *ys, signs("text").alias("signs")), "toxicity-sample")
    totals = rows.agg(F.count("*").alias("n"), *[F.coalesce(F.sum(y), F.lit(0)).alias(y) for y in ys]).first()
    counts = rows.select(*ys, F.explode("signs").alias("sign")).groupBy("sign").agg(F.count("*").alias("n"), *[F.sum(y).alias(y) for y in ys])
    scores = [_chi_square(F.col(y), F.col("n"), totals[y], totals["n"]).alias(f"chi_{y}") for y in ys]
    chi = F.greatest(*[f"chi_{y}" for y in ys], F.lit(0.0))
    best = (counts.where(F.col("n") >= LEAST).select("sign", *scores).withColumn("chi", chi).where(F.col("chi") >= CHI)
            .orderBy(F.desc("chi"), "sign").limit(FEATURES).collect()) if totals["n"] else []
    index = {bytes(r["sign"]): i for i, r in enumerate(best)}
    wanted = F.array(*[F.lit(w) for w in index]) if index else F.array().cast("array<binary>")
    vectors = rows.select("id", *ys, F.array_intersect("signs", wanted).alias("signs")).orderBy("id").collect()
    x = np.zeros((len(vectors), len(index)))
    for i, r in enumerate(vectors):
        x[i, [index[bytes(w)] for w in r.signs]] = 1
    y = np.array([[r[c] for c in ys] for r in vectors], float).reshape(-1, len(names))
    fold = np.array([zlib.crc32(str(r.id).encode()) % FOLDS for r in vectors])
    if not len(vectors):
        return Chain({}, [Model(n, np.zeros(i), -35.0, 0.5) for i, n in enumerate(names)])
    own = np.array([[r[f"chi_{c}"] >= CHI for r in best] for c in ys], bool).reshape(len(ys), len(best))
    return Chain(index, fit_models(x, y, fold, names, own))


def _chi_square(hits: Column, n: Column, positives: int, total: int) -> Column:
    """Of the two-by-two table of a word's presence and a category."""
    expected = n * positives / F.lit(float(total or 1))
    spread = expected * F.lit(1 - positives / (total or 1)) * (1 - n / F.lit(float(total or 1)))
    return F.when(spread > 0, (hits - expected) ** 2 / spread).otherwise(0.0)


def probabilities(chain: Chain, text: Column) -> Column:
    """Array of the categories' probabilities for a text; null and empty texts have those of a text without words."""
    @F.arrow_udf("array<double>")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array(list(chain.probabilities([chain.features(t) for t in texts.to_pylist()])), pa.list_(pa.float64()))

    return run(text.cast("binary"))


def score(docs: DataFrame, chain: Chain, text_col: str = "text") -> DataFrame:
    """``docs`` with p_<category> and is_<category> of every category (replacing columns of those names), one row per row."""
    bound_batches(docs.sparkSession)
    p = free_name(docs, "p")
    scored = docs.withColumn(p, probabilities(chain, F.col(text_col)))
    for i, m in enumerate(chain.models):
        scored = scored.withColumn(f"p_{m.name}", F.col(p)[i]).withColumn(f"is_{m.name}", F.col(p)[i] >= m.threshold)
    return scored.drop(p)


def clean_documents(docs: DataFrame, chain: Chain, category: str = "toxic") -> DataFrame:
    """The rows of ``docs`` that the chain doesn't put into ``category``; all columns."""
    bound_batches(docs.sparkSession)
    i = [m.name for m in chain.models].index(category)
    return docs.where(probabilities(chain, F.col("text"))[i] < chain.models[i].threshold)
