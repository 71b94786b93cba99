"""Toxicity scores by FTRL-proximal logistic regression over hashed word grams (operator 2).

Features of a text: its distinct words, pairs of neighbours and pairs with one
or two words between them, hashed to a fixed number of coordinates. The model
is fitted on a bounded sample of labelled rows; L1 leaves few weights, which
go to the tasks as two small arrays.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locastar.llm.common import chunks, texts_of
from locastar.llm.words import LETTERS, joined, mix, word_hashes

#: Coordinates: 2**BITS.
BITS = 20
#: Labelled documents that the fit reads at most, and coordinates of one of them: the
#: bounds of the sample (a longer text's are drawn at random, so the driver holds
#: SAMPLE * EXAMPLE_GRAMS * 4 bytes at most).
SAMPLE = 10_000
EXAMPLE_GRAMS = 8192
GAPS = (1, 2, 3)


@dataclass(frozen=True)
class Settings:
    """``l1`` above half the epochs: a gram of one or two texts never gets a weight."""
    alpha: float = 2.0
    beta: float = 1.0
    l1: float = 6.0
    l2: float = 0.1
    epochs: int = 10


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(text number, coordinate) of every gram, repeats included."""
    h, bounds = word_hashes(texts, LETTERS)
    doc = np.repeat(np.arange(len(texts)), np.diff(bounds))
    docs, ids = [doc], [mix(h)]
    for gap in GAPS:
        same = doc[gap:] == doc[:-gap]
        docs.append(doc[gap:][same])
        ids.append(joined(h[:-gap][same] + np.uint64(gap), h[gap:][same]))
    return np.concatenate(docs), (np.concatenate(ids) >> np.uint64(64 - BITS)).astype(np.int64)


def distinct(docs: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    key = np.unique((docs.astype(np.int64) << BITS) | ids)
    return key >> BITS, key & ((1 << BITS) - 1)


@dataclass(frozen=True)
class Model:
    """Coordinates other than 0, their weights, and the bias."""
    ids: np.ndarray
    weights: np.ndarray
    bias: float

    def dense(self) -> np.ndarray:
        out = np.zeros(1 << BITS, np.float32)
        out[self.ids] = self.weights
        return out


def fit(examples: list[np.ndarray], labels: np.ndarray, s: Settings = Settings()) -> Model:
    """FTRL-proximal, one example at a time in the given order.

    examples: each one's distinct coordinates. Without examples all scores are
    one half; with one class alone the bias says so.
    """
    z, n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)
    bias = 1 << BITS

    def weight(at):
        zs = z[at]
        w = -(zs - np.sign(zs) * s.l1) / ((s.beta + np.sqrt(n[at])) / s.alpha + s.l2)
        return np.where(np.abs(zs) <= s.l1, 0.0, w)

    for _ in range(s.epochs):
        for ids, y in zip(examples, labels):
            at = np.append(ids, bias)
            w = weight(at)
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - y
            step = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / s.alpha
            z[at] += g - step * w
            n[at] += g * g
    w = weight(np.arange(len(z)))
    kept = np.flatnonzero(w[:-1])
    return Model(kept, w[kept].astype(np.float32), float(w[-1]))


def score_texts(texts: list[str], dense: np.ndarray, bias: float) -> np.ndarray:
    docs, ids = grams(texts)
    w = dense[ids]
    hit = np.flatnonzero(w)
    d, i = distinct(docs[hit], ids[hit])
    total = np.bincount(d, dense[i], minlength=len(texts)) + bias
    return 1 / (1 + np.exp(-np.clip(total, -35, 35)))


def sample(docs: DataFrame, labels: DataFrame, label: str, fold: int, held: int, rows: int) -> DataFrame:
    """(doc_id, y, text) of at most ``rows`` labelled documents outside the held-out fold.

    The smallest hashes of doc_id are taken, so the sample is the same in
    every run. Rows without doc_id or label are no examples; of repeated
    labels the largest counts, and of the texts of one id the last in order.
    """
    drawn = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()) \
        .where(fold_of("doc_id", fold) != held) \
        .groupBy("doc_id").agg(F.max(label).cast("int").alias("y")) \
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    return texts_of(docs).join(F.broadcast(drawn), "doc_id") \
        .groupBy("doc_id").agg(F.max("y").alias("y"), F.max("text").alias("text"))


def fold_of(doc_id: str, fold: int):
    return F.crc32(F.col(doc_id).cast("string")) % fold


def drawn_from(coordinates: np.ndarray, doc_id: int) -> np.ndarray:
    """At most EXAMPLE_GRAMS of an example's coordinates, the same in every run."""
    if len(coordinates) <= EXAMPLE_GRAMS:
        return coordinates
    return np.sort(np.random.default_rng(doc_id % (1 << 63)).choice(coordinates, EXAMPLE_GRAMS, replace=False))


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", fold: int = 3, held: int = 1,
          rows: int = SAMPLE, settings: Settings = Settings()) -> Model:
    """Fit on the sample: tasks make the coordinates, the driver gets at most ``rows`` arrays."""

    def run(batches):
        for batch in batches:
            ids, y, texts = (batch.column(k).to_pylist() for k in range(3))
            found: list[bytes] = []
            for a, b in chunks(texts):
                d, i = distinct(*grams(texts[a:b]))
                cuts = np.searchsorted(d, np.arange(b - a + 1))
                found += [drawn_from(i[cuts[k]:cuts[k + 1]], ids[a + k]).astype(np.int32).tobytes() for k in range(b - a)]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(y, pa.int32()), pa.array(found, pa.binary())],
                                             ["doc_id", "y", "ids"])

    got = sample(docs, labels, label, fold, held, rows).select("doc_id", "y", "text") \
        .mapInArrow(run, "doc_id long, y int, ids binary").toPandas()
    got = got.iloc[np.argsort(mix(got["doc_id"].to_numpy(np.int64).astype(np.uint64)), kind="stable")]
    return fit([np.frombuffer(b, np.int32) for b in got["ids"]], got["y"].to_numpy(), settings)


def toxicity(docs: DataFrame, model: Model, threshold: float = 0.7, fold: int = 3, held: int = 1) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row.

    A null text is the empty text, whose score is the bias's. A null doc_id is
    scored and never held out. Repeated rows are scored each.
    """

    def run(batches):
        dense = model.dense()
        for batch in batches:
            texts = batch.column(1).to_pylist()
            parts = [score_texts(texts[a:b], dense, model.bias) for a, b in chunks(texts)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(np.concatenate(parts) if parts else [], pa.float64())], ["doc_id", "score"])

    scored = texts_of(docs).mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", F.coalesce(fold_of("doc_id", fold) == held, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
