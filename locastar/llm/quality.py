"""Quality scores by histogram gradient-boosted trees over document statistics (operator 5).

Statistics are computed for many texts at once in numpy. Trees are grown on
binned values of a bounded labelled sample and flattened into arrays of one
shape, so a batch of texts walks all trees level by level without a loop over
texts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locastar.llm.common import chunks, texts_of
from locastar.llm.toxicity import fold_of, sample
from locastar.llm.words import LETTERS, SPACED, byte_table, joined, word_hashes

#: Labelled rows that the fit reads at most: the bound of the sample.
SAMPLE = 20_000
BINS = 64

LINES = byte_table([0x0A])
#: Classes of bytes whose shares are statistics; together they hold every byte.
CLASSES = {"lower": range(97, 123), "upper": range(65, 91), "digit": range(48, 58), "space": [32, 9], "line_end": [10, 13],
           "stop": b".?", "bang": b"!", "comma": b",;:", "bar": b"|", "quote": b"\"'()[]{}<>", "mark": b"#$%&*+-/=@\\^_`~",
           "beyond_ascii": range(128, 256)}
CLASS_OF = np.full(256, len(CLASSES), np.int64)
for _k, _bytes in enumerate(CLASSES.values()):
    CLASS_OF[list(_bytes)] = _k
STATISTICS = [f"share_{c}" for c in CLASSES] + [
    "share_other", "log_bytes", "log_words", "log_lines", "bytes_in_word", "words_in_line", "distinct_words", "distinct_pairs",
    "distinct_lines", "top_line_share"]


def per_text(bounds: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct hashes, most frequent hash's count) of each text."""
    n = len(bounds) - 1
    doc = np.repeat(np.arange(n), np.diff(bounds))
    order = np.lexsort((hashes, doc))
    d, h = doc[order], hashes[order]
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] != d[:-1]) | (h[1:] != h[:-1])
    at = np.flatnonzero(new)
    runs = np.diff(np.append(at, len(d)))
    top = np.zeros(n)
    np.maximum.at(top, d[at], runs)
    return np.bincount(d[at], minlength=n), top


def statistics(texts: list[str]) -> np.ndarray:
    """One row of STATISTICS for each text; an empty text's are all 0."""
    n = len(texts)
    coded = [t.encode("utf-8") for t in texts]
    sizes = np.array([len(c) for c in coded])
    blob = np.frombuffer(b"".join(coded), np.uint8)
    kinds = len(CLASSES) + 1
    doc = np.repeat(np.arange(n), sizes)
    counts = np.bincount(doc * kinds + CLASS_OF[blob], minlength=n * kinds).reshape(n, kinds)
    words, wb = word_hashes(texts, LETTERS)
    spaced, sb = word_hashes(texts, SPACED)
    lines, lb = word_hashes(texts, LINES)
    n_words, n_spaced, n_lines = np.diff(wb), np.diff(sb), np.diff(lb)
    wd = np.repeat(np.arange(n), n_words)
    same = wd[1:] == wd[:-1]
    pairs = joined(words[:-1], words[1:])[same] if len(words) > 1 else words[:0]
    n_pairs = np.maximum(n_words - 1, 0)
    pb = np.concatenate([[0], np.cumsum(n_pairs)])
    over = lambda a, b: a / np.maximum(b, 1)
    line_kinds, line_top = per_text(lb, lines)
    return np.column_stack([
        over(counts, sizes[:, None]), np.log1p(sizes), np.log1p(n_spaced), np.log1p(n_lines), over(sizes, n_spaced),
        over(n_spaced, n_lines), over(per_text(wb, words)[0], n_words), over(per_text(pb, pairs)[0], n_pairs),
        over(line_kinds, n_lines), over(line_top, n_lines)]).astype(np.float64)


@dataclass(frozen=True)
class Forest:
    """Complete trees of one depth as arrays (tree, node): a text goes right where its statistic exceeds the threshold."""
    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray
    bias: float

    def score(self, x: np.ndarray) -> np.ndarray:
        trees = np.arange(len(self.feature))
        node = np.zeros((len(x), len(trees)), np.int64)
        rows = np.arange(len(x))[:, None]
        for _ in range(int(np.log2(self.leaf.shape[1]))):
            node = 2 * node + 1 + (x[rows, self.feature[trees, node]] > self.threshold[trees, node])
        total = self.leaf[trees, node - self.feature.shape[1]].sum(axis=1) + self.bias
        return 1 / (1 + np.exp(-np.clip(total, -35, 35)))


@dataclass(frozen=True)
class Settings:
    trees: int = 80
    depth: int = 4
    rate: float = 0.15
    l2: float = 2.0
    least_hessian: float = 1.0
    least_gain: float = 1e-3


def fit(x: np.ndarray, y: np.ndarray, s: Settings = Settings()) -> Forest:
    """Second-order boosting of the logistic loss on histograms. Without rows all scores are one half."""
    inner = (1 << s.depth) - 1
    feature, threshold, leaf = (np.zeros((s.trees, k)) for k in (inner, inner, inner + 1))
    share = (y.sum() + 0.5) / (len(y) + 1)
    bias = float(np.log(share / (1 - share)))
    if not len(y):
        return Forest(feature.astype(np.int64), threshold, leaf, bias)
    n_features = x.shape[1]
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(n_features)]
    binned = np.column_stack([np.searchsorted(cuts[f], x[:, f], side="left") for f in range(n_features)])
    total = np.full(len(y), bias)
    for t in range(s.trees):
        p = 1 / (1 + np.exp(-total))
        g, h = p - y, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        feature_t, bin_t = np.zeros(inner, np.int64), np.full(inner, BINS)
        for level in range(s.depth):
            first, width = (1 << level) - 1, 1 << level
            at = (node - first) * BINS
            gain = np.full((width, n_features, BINS), -np.inf)
            for f in range(n_features):
                gs = np.bincount(at + binned[:, f], g, width * BINS).reshape(width, BINS).cumsum(1)
                hs = np.bincount(at + binned[:, f], h, width * BINS).reshape(width, BINS).cumsum(1)
                ga, ha = gs[:, -1:], hs[:, -1:]
                better = gs ** 2 / (hs + s.l2) + (ga - gs) ** 2 / (ha - hs + s.l2) - ga ** 2 / (ha + s.l2)
                better[(hs < s.least_hessian) | (ha - hs < s.least_hessian)] = -np.inf
                gain[:, f] = better
            flat = gain.reshape(width, -1)
            best = flat.argmax(1)
            split = flat[np.arange(width), best] > s.least_gain
            f_best, b_best = best // BINS, best % BINS
            feature_t[first:first + width] = np.where(split, f_best, 0)
            bin_t[first:first + width] = np.where(split, b_best, BINS)  # no split: all go left
            node = 2 * node + 1 + (binned[np.arange(len(y)), feature_t[node]] > bin_t[node])
        at = node - inner
        leaf[t] = -s.rate * np.bincount(at, g, inner + 1) / (np.bincount(at, h, inner + 1) + s.l2)
        total += leaf[t][at]
        feature[t] = feature_t
        threshold[t] = [cuts[f][b] if b < len(cuts[f]) else np.inf for f, b in zip(feature_t, bin_t)]
    return Forest(feature.astype(np.int64), threshold, leaf, bias)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", fold: int = 5, held: int = 0,
          rows: int = SAMPLE, settings: Settings = Settings()) -> Forest:
    """Fit on at most ``rows`` labelled rows outside the held-out fold: tasks make the
    statistics, the driver gets one short row for each."""

    def run(batches):
        for batch in batches:
            ids, y, texts = (batch.column(k).to_pylist() for k in range(3))
            x = [row for a, b in chunks(texts) for row in statistics(texts[a:b]).tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(y, pa.int32()), pa.array(x, pa.list_(pa.float64()))],
                                             ["doc_id", "y", "x"])

    got = sample(docs, labels, label, fold, held, rows).select("doc_id", "y", "text") \
        .mapInArrow(run, "doc_id long, y int, x array<double>").toPandas().sort_values("doc_id")
    x = np.stack(got["x"].to_list()) if len(got) else np.zeros((0, len(STATISTICS)))
    return fit(x, got["y"].to_numpy(np.float64), settings)


def scores(texts: list[str], forest: Forest) -> np.ndarray:
    parts = [forest.score(statistics(texts[a:b])) for a, b in chunks(texts)]
    return np.concatenate(parts) if parts else np.zeros(0)


def quality(docs: DataFrame, forest: Forest, threshold: float = 0.3, fold: int = 5, held: int = 0) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row.

    A null text is the empty text, whose statistics are all 0. A null doc_id is
    scored and never held out. Repeated rows are scored each.
    """

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(scores(batch.column(1).to_pylist(), forest), pa.float64())], ["doc_id", "score"])

    scored = texts_of(docs).mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", F.coalesce(fold_of("doc_id", fold) == held, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, forest: Forest, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``, all columns as they are, in one pass."""
    at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column(at).to_pylist()]
            yield batch.filter(pa.array(scores(texts, forest) >= threshold))

    return docs.mapInArrow(run, docs.schema)
