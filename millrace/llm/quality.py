"""Quality classifier: hashed word n-grams, logistic regression by follow-the-regularised-leader.

Features of a text are its words, its runs of marks and its neighbouring pairs, hashed into
``2**bits`` slots; a word followed by itself is one feature whatever the word.  The value of
a feature is its share of all features of the text, so length does not matter.

Training takes all labelled rows (about ``rows`` of them, where a caller gives a number), splits
them over shards of bounded size, runs the per-coordinate proximal updates for ``epochs`` passes
in each and averages the shards' weights.  Scoring is one sparse dot product per text, in Arrow
batches, with no shuffle; the model is a vector of ``2**bits`` floats.

Edge cases: null and empty texts have no feature and score the bias; null ids, null labels
and labels without a document teach nothing; several labels of one id count as their
maximum; repeated rows are scored alike.  With no label at all every score is 0.5.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm import terms
from millrace.llm.common import bounded_sample, held_out, written

SHARD_ROWS, SHARD_BYTES = 5_000, 32 << 20
_PAIR, _AGAIN, _BIAS = np.uint64(3), np.uint64(0x5EED), 0.3


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float

    def logits(self, texts: pa.Array) -> np.ndarray:
        data, offsets = terms.buffer_of(texts)
        out = np.full(len(texts), self.bias * _BIAS)
        for a, b in terms.slices(offsets):
            row, feature = features(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], len(self.weights))
            total = np.bincount(row, self.weights[feature], b - a)
            out[a:b] += total / np.maximum(1, np.bincount(row, minlength=b - a))
        return out


def features(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, slot) of every word and neighbouring pair."""
    row, h, _ = terms.words(data, offsets, marks=True, lower=False)
    near = row[1:] == row[:-1]
    pair = np.where(h[1:] == h[:-1], _AGAIN, terms.mix(h[:-1] * _PAIR + h[1:]))[near]
    slots = np.concatenate([h, pair]) & np.uint64(size - 1)
    return np.concatenate([row, row[:-1][near]]), slots.astype(np.int64)


def _follow_leader(shard: pd.DataFrame, size: int, alpha: float, beta: float, l1: float, l2: float, epochs: int) -> pd.DataFrame:
    """Weights after ``epochs`` passes over one shard, as (slot, weight) rows; slot ``size`` is the bias, the next one counts the shard."""
    shard = shard.sort_values(["text", "label"], kind="stable")
    labels = shard["label"].to_numpy(float)
    data, offsets = terms.buffer_of(pa.array(shard["text"], pa.large_string()))
    del shard
    slots, counts, ends = [], [], np.zeros(len(labels) + 1, np.int64)
    for a, b in terms.slices(offsets, 1 << 17):
        row, slot = features(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], size)
        both, times = np.unique(row * size + slot, return_counts=True)
        ends[a + 1 : b + 1] = ends[a] + np.searchsorted(both, np.arange(1, b - a + 1) * size)
        slots.append((both % size).astype(np.int32))
        counts.append(times.astype(np.int32))
    del data, offsets
    slots, counts = (np.concatenate([np.zeros(0, np.int32), *x]) for x in (slots, counts))

    def inputs(i: int) -> tuple[np.ndarray, np.ndarray]:
        times = counts[ends[i] : ends[i + 1]]
        return np.append(slots[ends[i] : ends[i + 1]], size), np.append(times / max(1, times.sum()), _BIAS)

    z, n = np.zeros(size + 1), np.zeros(size + 1)

    def weights(at) -> np.ndarray:
        zs = z[at]
        return np.where(np.abs(zs) <= l1, 0, (np.sign(zs) * l1 - zs) / ((beta + np.sqrt(n[at])) / alpha + l2))

    for epoch in range(epochs):
        for i in np.random.default_rng(epoch).permutation(len(labels)):
            at, x = inputs(i)
            w = weights(at)
            g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - labels[i]) * x
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha * w
            n[at] += g * g
    w = weights(slice(None))
    at = np.flatnonzero(w)
    return pd.DataFrame({"slot": np.append(at, size + 1), "weight": np.append(w[at], 1.0)})


def fit(
    docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int | None = None, shards: int = 4, bits: int = 18,
    alpha: float = 10.0, beta: float = 0.1, l1: float = 0.001, l2: float = 0.0, epochs: int = 3,
) -> Model:
    """Learn from all labelled documents outside the held-out fold, or from about ``rows`` of them.

    Only the text is an input.  Repeated rows of an id count once, also where ids have many
    texts.  There are ``shards`` shards, and more where one would hold over ``SHARD_ROWS`` rows
    or ``SHARD_BYTES`` bytes; the driver gets the weights, summed over the shards, ``2**bits + 2`` rows at most.
    """
    size = 1 << bits
    known = (
        labels.where(F.col(label).isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max(label).cast("double").alias("label"))
    )
    if rows is not None:
        known = bounded_sample(known, rows, F.col("doc_id"))
    pairs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(known, "doc_id").distinct()
    pairs = written(pairs, "labelled")
    if rows is not None:
        pairs = bounded_sample(pairs, rows, F.col("doc_id"), F.col("text"))
    held = pairs.agg(F.count("*").alias("rows"), F.sum(F.octet_length("text")).alias("bytes")).first()
    shards = max(shards, -(-held["rows"] // SHARD_ROWS), -(-(held["bytes"] or 0) // SHARD_BYTES))
    shard = F.pmod(F.xxhash64("doc_id", "text"), F.lit(shards)).alias("shard")
    learnt = pairs.select(shard, "text", "label").groupBy("shard").applyInPandas(
        lambda pdf: _follow_leader(pdf, size, alpha, beta, l1, l2, epochs), "slot long, weight double"
    )
    found = learnt.groupBy("slot").agg(F.sum("weight").alias("weight")).toArrow()
    weights = np.zeros(size + 2)
    weights[found["slot"].to_numpy()] = found["weight"].to_numpy()
    weights /= max(1, weights[size + 1])
    return Model(weights[:size].astype(np.float32), float(weights[size]))


def score(model: Model, text: Column) -> Column:
    """Probability of label 1, from the whole text."""

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        return pa.array(1 / (1 + np.exp(-np.clip(model.logits(texts), -35, 35))), pa.float64())

    return scored(text)


def classify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score and predicted (1 from a score of 0.5 on) of every row."""
    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score(model, F.col("text")).alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int")
    )


def keep_good(docs: DataFrame, model: Model) -> DataFrame:
    """Rows the model does not reject, with their columns."""
    return docs.where(score(model, F.col("text")) >= 0.5)
