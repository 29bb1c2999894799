"""Toxicity by FTRL-proximal logistic regression (operator 10).

Features are the hashed words, word pairs, skip pairs (one word between) and word
beginnings (five bytes, for inflected words not seen before) of the lower-cased text,
each counted once per document. FTRL-proximal learns with a rate per
coordinate; its L1 term leaves most weights at zero, so the model is a short list of
``(feature, weight)`` that every task can hold.

The model is fitted on a bounded sample of labelled rows: at most ``SAMPLE_TOXIC`` toxic
and ``SAMPLE_CLEAN`` clean ones, the first by a hash of their id. Features are made
where the documents are; one task reads the sample's features and returns the weights.
Scoring reads every text whole and shuffles nothing.

Cases: a null or empty text has no features and scores the bias. Rows without a label
are scored only. Labels that are null are ignored; of several labels of one id the
largest counts, and of several rows of one id the model is fitted on the smallest text. Without labelled rows of both kinds every score is
about 0.01. Repeated rows are scored as often as they come. A very long text is read whole; its
features are a set of hashes below a fixed number. An empty table gives an empty table.
"""

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

BITS = 20
SAMPLE_TOXIC = 6_000
SAMPLE_CLEAN = 12_000
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 4.0, 1.0
REJECT_AT = 0.3
# The bias where there is nothing to learn from: a score of about 0.01.
UNTAUGHT = -4.6

_BLANKS = bytes(c if chr(c).isalnum() or c >= 128 else 32 for c in range(256))
# Odd 64-bit multipliers that keep the kinds of feature apart.
_WORD, _FIRST, _SECOND, _SKIP, _START = (
    np.uint64(m)
    for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
)


def features(text: str | None, bits=BITS) -> np.ndarray:
    """Feature of every word, pair, skip pair and beginning in the whole text, repeats included."""
    words = (text or "").lower().encode("utf-8", "replace").translate(_BLANKS).split()
    h = np.fromiter(map(zlib.crc32, words), np.uint64, len(words)) + np.uint64(1)
    starts = np.fromiter(map(zlib.crc32, [word[:5] for word in words]), np.uint64, len(words)) + np.uint64(1)
    mixed = [h * _WORD, h[:-1] * _FIRST + h[1:] * _SECOND, h[:-2] * _SKIP + h[2:] * _FIRST, starts * _START]
    raw = np.concatenate(mixed)
    raw ^= raw >> np.uint64(29)
    return ((raw * _WORD) >> np.uint64(64 - bits)).astype(np.int32)


@dataclass
class Model:
    """Weights of the features that have one, and the bias."""

    index: np.ndarray
    weight: np.ndarray
    bias: float
    bits: int = BITS

    def dense(self) -> np.ndarray:
        weights = np.zeros(1 << self.bits, np.float32)
        weights[self.index] = self.weight
        return weights


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


class Ftrl:
    """FTRL-proximal (McMahan et al., "Ad Click Prediction"): one weight per feature and a bias."""

    def __init__(self, bits=BITS, alpha=ALPHA, beta=BETA, l1=L1, l2=L2):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)
        self.bias = 1 << bits

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        # The bias carries no L1 penalty.
        l1 = np.where(at == self.bias, 0.0, self.l1)
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2))

    def learn(self, index: np.ndarray, label: int) -> None:
        at = np.append(index, self.bias)
        w = self.weights(at)
        p = 1 / (1 + np.exp(-np.clip(w.sum(), -30, 30)))
        g = p - label
        sigma = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / self.alpha
        self.z[at] += g - sigma * w
        self.n[at] += g * g


def training_rows(docs: DataFrame, labels: DataFrame, bits=BITS) -> DataFrame:
    """``(order, toxic, feature array)`` of the bounded sample, made where the documents are."""
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
        .withColumn("pick", F.xxhash64("id"))
        # Another hash than the one that picks: the two kinds must stay mixed to the last row.
        .withColumn("order", F.xxhash64(F.lit("order"), "id"))
    )
    parts = [
        known.where(F.col("toxic") == toxic).orderBy("pick", "id").limit(size)
        for toxic, size in ((1, SAMPLE_TOXIC), (0, SAMPLE_CLEAN))
    ]
    # At most 18,000 ids: small enough to be sent to every task.
    sample = F.broadcast(parts[0].union(parts[1]))
    # One text an id, so that the sample is bounded in rows; equal rows meet in their tasks first.
    rows = (
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).join(sample, F.col("doc_id") == F.col("id"))
        .groupBy("id", "order", "toxic").agg(F.min("text").alias("text"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                found = [np.unique(features(text.as_py(), bits)) for text in part.column(2)]
                yield pa.record_batch(
                    [part.column(0), part.column(1), pa.array(found, pa.list_(pa.int32()))],
                    names=["order", "toxic", "features"],
                )

    return rows.select("order", "toxic", "text").mapInArrow(
        run, "order long, toxic int, features array<int>"
    )


def fit(docs: DataFrame, labels: DataFrame, bits=BITS, epochs=EPOCHS) -> Model:
    """The model; its weights are bounded by ``2 ** bits`` and reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            for toxic, found in zip(batch.column(1).to_pylist(), batch.column(2), strict=True):
                rows.append((toxic, np.asarray(found.values.to_numpy(zero_copy_only=False))))
        if len({toxic for toxic, _ in rows}) < 2:
            return
        model = Ftrl(bits)
        for _ in range(epochs):
            for toxic, index in rows:
                model.learn(index, toxic)
        every = np.arange((1 << bits) + 1)
        weights = model.weights(every)
        at = np.flatnonzero((weights != 0) | (every == model.bias))
        yield pa.record_batch({"feature": pa.array(at), "weight": pa.array(weights[at])})

    rows = training_rows(docs, labels, bits).repartition(1).sortWithinPartitions("order")
    found = rows.mapInArrow(run, "feature long, weight double").collect()
    bias = next((row["weight"] for row in found if row["feature"] == 1 << bits), UNTAUGHT)
    rest = [row for row in found if row["feature"] < 1 << bits]
    return Model(
        np.array([row["feature"] for row in rest], np.int64), np.array([row["weight"] for row in rest], np.float32), bias, bits
    )


def document_score(text: str | None, weights: np.ndarray, bias: float, bits: int) -> float:
    index = features(text, bits)
    hit = np.unique(index[weights[index] != 0])
    return float(1 / (1 + np.exp(-np.clip(bias + weights[hit].sum(dtype=np.float64), -30, 30))))


def scored(docs: DataFrame, model: Model, text="text", score="score") -> DataFrame:
    """``docs`` with the column ``score`` added (in place of one of that name)."""
    docs = docs.drop(score)
    arrow_types = docs.withColumn(score, F.lit(0.0)).schema
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = model.dense()
        for batch in batches:
            found = [document_score(value.as_py(), weights, model.bias, model.bits) for value in batch.column(at)]
            yield pa.record_batch([*batch.columns, pa.array(found, pa.float64())], names=[*batch.schema.names, score])

    return docs.mapInArrow(run, arrow_types)


def toxicity_scores(docs: DataFrame, labels: DataFrame, reject_at=REJECT_AT) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every row of ``docs``."""
    model = fit(docs, labels)
    found = scored(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), model)
    return found.select(
        "doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= reject_at).cast("int").alias("predicted"),
    )
