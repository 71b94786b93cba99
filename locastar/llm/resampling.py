"""Importance resampling towards a target's word distribution (operator 12).

The ``tokenizers`` library parts ASCII-lowered texts with an untrained Regex
Split; the offsets of the words, singly and in windows of neighbours, give
the bytes whose CRC-32 picks a bucket. Histograms of the buckets of the corpus
and of the target give each bucket a gain; a document's weight is its mean
gain, and Gumbel noise from its id draws documents without replacement.
Texts are parted once: their bucket numbers are written and read again.
"""

from __future__ import annotations

import zlib
from functools import lru_cache
from itertools import chain
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from locastar.llm.common import chunks, texts_of, written
from locastar.llm.tokens import library

#: Words are runs of anything but these: ASCII without letters and digits.
PARTS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS = 10_000
RUN = 2
#: Characters that the library parts at once; a window ends before a space.
WINDOW = 1024
#: Longer words go through zlib one by one.
LONG_WORD = 64

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


@lru_cache(maxsize=1)
def crc_table() -> np.ndarray:
    out = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        out = np.where(out & 1, (out >> np.uint32(1)) ^ np.uint32(0xEDB88320), out >> np.uint32(1))
    return out


def crc_on(crc: np.ndarray, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The CRC-32 of what ``crc`` stands for followed by each span of ``data``."""
    table, order = crc_table(), np.argsort(-sizes, kind="stable")
    state, at, falling = ~crc[order], starts[order], -sizes[order]
    for k in range(int(min(sizes.max(initial=0), LONG_WORD))):
        n = int(np.searchsorted(falling, -k))  # spans of more than k bytes
        state[:n] = table[(state[:n] ^ data[at[:n] + k]) & np.uint32(0xFF)] ^ (state[:n] >> np.uint32(8))
    out = np.empty_like(state)
    out[order] = ~state
    for i in np.flatnonzero(sizes > LONG_WORD):
        out[i] = zlib.crc32(data[starts[i]:starts[i] + sizes[i]].tobytes(), int(crc[i]))
    return out


@lru_cache(maxsize=1)
def splitter():
    t = library()
    return t.pre_tokenizers.Split(t.Regex(PARTS), behavior="removed", invert=True).pre_tokenize_str


def windows(text: str):
    """Parts of a text that meet at a space, which no word holds."""
    start = 0
    while start < len(text):
        stop = start + WINDOW
        if stop < len(text):
            cut = text.rfind(" ", start, stop)
            cut = cut if cut > start else text.find(" ", stop)
            stop = cut if cut > 0 else len(text)
        yield text[start:stop]
        start = stop


def words_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, start and size of each word in them, first word of each text and the total)."""
    split, spans, parts, at, first = splitter(), [], [], 0, [0]
    words = 0
    for text in texts:
        low = text.encode("utf-8").translate(_LOWER).decode("utf-8")
        for part in windows(low):
            found = np.fromiter(chain.from_iterable(map(itemgetter(1), split(part))), np.int64).reshape(-1, 2)
            coded = part.encode("utf-8")
            if len(coded) != len(part):  # offsets count characters
                begins = np.flatnonzero((np.frombuffer(coded, np.uint8) & 0xC0) != 0x80)
                found = np.append(begins, len(coded))[found]
            spans.append(found + at)
            parts.append(coded)
            at += len(coded)
            words += len(found)
        first.append(words)
    where = np.concatenate(spans) if spans else np.zeros((0, 2), np.int64)
    return np.frombuffer(b"".join(parts) or b"\0", np.uint8), where[:, 0], where[:, 1] - where[:, 0], np.array(first)


def bucket_runs(texts: list[str], buckets: int = BUCKETS, run: int = RUN) -> tuple[list[np.ndarray], np.ndarray]:
    """(buckets of each text's runs of 1 to ``run`` words, number of words of each text)."""
    data, starts, sizes, first = words_of(texts)
    doc = np.repeat(np.arange(len(texts)), np.diff(first))
    crc = crc_on(np.zeros(len(starts), np.uint32), data, starts, sizes)
    docs, found = [doc], [crc % buckets]
    space = np.frombuffer(b" ", np.uint8)
    for n in range(1, run):  # runs of n + 1 words that begin at each word
        crc = crc[:-1] if len(crc) else crc
        crc = crc_on(crc, space, np.zeros(len(crc), np.int64), np.ones(len(crc), np.int64))
        crc = crc_on(crc, data, starts[n:], sizes[n:])
        inside = doc[n:] == doc[:len(doc) - n] if len(doc) > n else np.zeros(0, bool)
        docs.append(doc[:len(crc)][inside])
        found.append(crc[inside] % buckets)
    order = np.argsort(np.concatenate(docs), kind="stable")
    held = np.concatenate(found)[order].astype(np.uint16 if buckets <= 1 << 16 else np.uint32)
    n_features = np.bincount(np.concatenate(docs), minlength=len(texts))
    return np.split(held, np.cumsum(n_features)[:-1]) if len(texts) else [], np.diff(first)


def features(docs: DataFrame, buckets: int = BUCKETS, run: int = RUN) -> DataFrame:
    """(doc_id, n_words, n_features, buckets binary) of every row; a null text has no words."""

    def work(batches):
        for batch in batches:
            texts, held, words = batch.column(1).to_pylist(), [], []
            for a, b in chunks(texts):
                found, n = bucket_runs(texts[a:b], buckets, run)
                held += found
                words += n.tolist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(words, pa.int64()), pa.array(map(len, held), pa.int64()),
                 pa.array([h.tobytes() for h in held], pa.binary())], ["doc_id", "n_words", "n_features", "buckets"])

    return texts_of(docs).mapInArrow(work, "doc_id long, n_words long, n_features long, buckets binary")


def counts(held: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features in each bucket: every task adds up its own, the driver gets ``buckets`` sums at most."""
    kind = np.uint16 if buckets <= 1 << 16 else np.uint32

    def work(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            total += np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), kind), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for bucket, n in held.select("buckets").mapInArrow(work, "bucket int, n long").groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln) of how much likelier a bucket is in the target, with one added to each count."""
    s, t, n = corpus.astype(float), target.astype(float), len(corpus)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + n) / ((s + 1) * (t.sum() + n)))).astype(np.int64)


def weigh(held: DataFrame, gain: np.ndarray) -> DataFrame:
    """(doc_id, n_words, n_features, weight): the floored mean gain, 0 without features."""
    kind = np.uint16 if len(gain) <= 1 << 16 else np.uint32

    def work(batches):
        for batch in batches:
            sums = [int(gain[np.frombuffer(b, kind)].sum()) for b in batch.column(3).to_pylist()]
            weights = [total // n if n else 0 for total, n in zip(sums, batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(weights, pa.int64())], ["doc_id", "n_words", "n_features", "weight"])

    return held.select("doc_id", "n_words", "n_features", "buckets").mapInArrow(work, "doc_id long, n_words long, n_features long, weight long")


def ranked(df: DataFrame, *order) -> DataFrame:
    """``df`` with ``rank``, 1 for the first: ranges of the order are numbered each, and offset by the rows before them."""
    dealt = written(df.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "ranges")
    sizes = dealt.groupBy("part").agg(F.count("*").alias("rows"))
    # one row for each range: as many as there are partitions
    before = sizes.withColumn("before", F.sum("rows").over(Window.orderBy("part")) - F.col("rows")).drop("rows")
    numbered = dealt.withColumn("rank", F.row_number().over(Window.partitionBy("part").orderBy(*order)))
    return numbered.join(F.broadcast(before), "part").withColumn("rank", F.col("rank") + F.col("before")).drop("part", "before")


def resample(docs: DataFrame, target: DataFrame, percent: int = 25, least_words: int = 20, seed: int = 7,
             buckets: int = BUCKETS, run: int = RUN) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every row; ``rank`` is null where a document is not drawn.

    ``target`` has a column ``text``; an empty one has no features. Of the N
    documents with an id and ``least_words`` words the ``percent`` * N / 100 highest scores are
    drawn, ties to the smaller id. Rows without doc_id have a weight but no
    score. Repeated rows are drawn each, as documents of their own.
    """
    held = written(features(docs, buckets, run), "features")
    goal = features(target.select(F.lit(None).cast("long").alias("doc_id"), "text"), buckets, run)
    weighed = weigh(held, gains(counts(held, buckets), counts(goal, buckets)))
    hashed = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("doc_id").cast("string")), 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(-1000.0 * F.log(-F.log((hashed + F.lit(0.5)) / F.lit(4294967296.0))))
    scored = written(weighed.withColumn("score", F.col("weight") + noise), "scores")
    may = F.col("doc_id").isNotNull() & (F.col("n_words") >= least_words)
    eligible = scored.where(may)
    quota = percent * eligible.count() // 100
    drawn = ranked(eligible, F.desc("score"), F.asc("doc_id")) \
        .withColumn("rank", F.when(F.col("rank") <= quota, F.col("rank")).cast("long"))
    rest = scored.where(~may).withColumn("rank", F.lit(None).cast("long"))
    return drawn.unionByName(rest).select("doc_id", "n_features", "weight", "score", "rank")
