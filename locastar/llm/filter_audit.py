"""Filter interaction audit (operator 11): what each quality filter removes in every order of filters.

One pass of a finite-state machine over the UTF-8 bytes of the texts counts
words, capitals, code points and symbols and emits the spans of words; the
spans go into an open-addressing table whose hits are verified byte by byte,
which counts a text's distinct words. All figures follow from one small
histogram of (part, set of failed filters, labels): a step depends on the set
of filters before it, not on their order.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from locastar.llm.common import CHUNK_CHARS, fresh
from locastar.llm.words import mix

#: Bytes that the machine reads at once; a longer text takes several blocks.
BLOCK = 1 << 20
#: Bytes of a word that are hashed and compared in lanes; the rest of a longer one goes through zlib and bytes.
LANE_BYTES = 256

# Classes of bytes, and what a byte emits.
SEPARATOR, CAPITAL, PLAIN, SYMBOL, CONTINUATION = range(5)
START, IS_CAPITAL, IS_POINT, IS_SYMBOL = 1, 2, 4, 8


def byte_classes() -> np.ndarray:
    out = np.full(256, PLAIN, np.uint8)
    out[[0x20, *range(0x09, 0x0E)]] = SEPARATOR
    out[ord("A"):ord("Z") + 1] = CAPITAL
    out[[ord(c) for c in "#$%&*|"]] = SYMBOL
    out[0x80:0xC0] = CONTINUATION
    return out


def emissions() -> np.ndarray:
    """(state, class) -> flags; state 1 is inside a word. The machine is definite:
    the class of the last byte alone is its state, so a block needs no carry
    but the byte before it."""
    out = np.zeros((2, 5), np.uint8)
    out[:, [SEPARATOR, CAPITAL, PLAIN, SYMBOL]] |= IS_POINT
    out[:, CAPITAL] |= IS_CAPITAL
    out[:, SYMBOL] |= IS_SYMBOL
    out[0, [CAPITAL, PLAIN, SYMBOL, CONTINUATION]] |= START
    return out


CLASSES, EMITS = byte_classes(), emissions()


class SpanTable:
    """Distinct (owner, bytes) among spans of one blob, by open addressing with verified hits.

    ``blob`` ends with eight bytes beyond the last span.
    """

    def __init__(self, blob: np.ndarray, bits: int = 12):
        self.blob = blob
        self.lanes = np.ndarray(max(len(blob) - 7, 0), "<u8", blob, strides=(1,))
        self.slots = np.full(1 << bits, -1, np.int64)
        self.hashes = np.zeros(0, np.uint64)
        self.starts = self.sizes = self.owners = np.zeros(0, np.int64)

    def lane(self, starts: np.ndarray, sizes: np.ndarray, k: int) -> np.ndarray:
        """Bytes 8k to 8k + 8 of each span, zeros beyond its end."""
        left = np.minimum(sizes - 8 * k, 8).astype(np.uint64)
        return self.lanes[starts + 8 * k] & (np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(64) - left * np.uint64(8)))

    def tail(self, start: int, size: int) -> bytes:
        return self.blob[start + LANE_BYTES:start + size].tobytes()

    def hash(self, starts: np.ndarray, sizes: np.ndarray, owners: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            h = mix(owners.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + sizes.astype(np.uint64))
            h = mix(h ^ self.lane(starts, sizes, 0))
            for k in range(1, LANE_BYTES // 8):
                at = np.flatnonzero(sizes > 8 * k)
                if not len(at):
                    break
                h[at] = mix(h[at] ^ self.lane(starts[at], sizes[at], k))
            for i in np.flatnonzero(sizes > LANE_BYTES):
                h[i] ^= np.uint64(zlib.crc32(self.tail(starts[i], sizes[i])))
        return h

    def equal(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the spans ``a`` and ``b`` (numbers) hold the same bytes of the same owner."""
        same = (self.hashes[a] == self.hashes[b]) & (self.sizes[a] == self.sizes[b]) & (self.owners[a] == self.owners[b])
        open_ = np.flatnonzero(same)
        sizes = self.sizes[a[open_]]
        for k in range(LANE_BYTES // 8):
            more = sizes > 8 * k
            open_, sizes = open_[more], sizes[more]
            if not len(open_):
                return same
            differs = self.lane(self.starts[a[open_]], sizes, k) != self.lane(self.starts[b[open_]], sizes, k)
            same[open_[differs]] = False
            open_, sizes = open_[~differs], sizes[~differs]
        for i in open_[sizes > LANE_BYTES]:
            same[i] = self.tail(self.starts[a[i]], self.sizes[a[i]]) == self.tail(self.starts[b[i]], self.sizes[b[i]])
        return same

    def insert(self, starts: np.ndarray, sizes: np.ndarray, owners: np.ndarray) -> np.ndarray:
        """For each span whether it is the one kept of its kind, all spans before it counted."""
        held = len(self.starts)
        self.starts, self.sizes, self.owners = (np.concatenate([x, y]) for x, y in ((self.starts, starts), (self.sizes, sizes), (self.owners, owners)))
        self.hashes = np.concatenate([self.hashes, self.hash(starts, sizes, owners)])
        if 2 * len(self.starts) > len(self.slots):
            self.slots = np.full(1 << int(2 * len(self.starts)).bit_length(), -1, np.int64)
            self._place(np.arange(held))
        kept = self._place(np.arange(held, len(self.starts)))
        # the table holds the kept spans alone
        stay = np.concatenate([np.ones(held, bool), kept])
        renumbered = np.cumsum(stay) - 1
        full = self.slots >= 0
        self.slots[full] = renumbered[self.slots[full]]
        self.starts, self.sizes, self.owners, self.hashes = (x[stay] for x in (self.starts, self.sizes, self.owners, self.hashes))
        return kept

    def _place(self, spans: np.ndarray) -> np.ndarray:
        mask = np.uint64(len(self.slots) - 1)
        kept = np.zeros(len(spans), bool)
        waiting = np.arange(len(spans))
        slot = self.hashes[spans] & mask
        step = (self.hashes[spans] >> np.uint64(32)) | np.uint64(1)
        while len(waiting):
            at = slot.astype(np.int64)
            free = self.slots[at] < 0
            self.slots[at[free]] = spans[waiting[free]]
            found, own = self.slots[at], spans[waiting]
            won = found == own
            kept[waiting[won]] = True
            on = ~won
            on[on] = ~self.equal(found[on], own[on])
            with np.errstate(over="ignore"):
                waiting, slot, step = waiting[on], (slot[on] + step[on]) & mask, step[on]
        return kept


def blocks(blob: np.ndarray, start: int, stop: int) -> Iterator[tuple[int, int]]:
    """Parts [a, b) of a text that end after a separator: no word lies in two."""
    while start < stop:
        end = start + BLOCK
        while end < stop and not len(seen := np.flatnonzero(CLASSES[blob[start:end]] == SEPARATOR)):
            end += BLOCK
        end = stop if end >= stop else start + int(seen[-1]) + 1
        yield start, end
        start = end


def count_texts(blob: np.ndarray, bounds: np.ndarray) -> dict[str, np.ndarray]:
    """Counts of each text ``blob[bounds[i]:bounds[i + 1]]``; eight bytes follow the last."""
    n = len(bounds) - 1
    out = {c: np.zeros(n, np.int64) for c in ("words", "distinct_words", "capitals", "code_points", "symbols")}
    for first, last in text_groups(bounds):
        table = SpanTable(blob)
        cuts = bounds[first:last + 1]
        for start, stop in blocks(blob, int(cuts[0]), int(cuts[-1])):
            classes = CLASSES[blob[start:stop]]
            inside = np.zeros(stop - start + 2, np.uint8)
            inside[1:-1] = classes != SEPARATOR
            here = np.clip(cuts, start, stop) - start
            before, after = inside[:-2].copy(), inside[2:].copy()
            before[here[here < len(before)]] = 0  # a text begins and ends between words
            after[here[here > 0] - 1] = 0
            emits = EMITS[before, classes]
            starts = np.flatnonzero(emits & START)
            ends = np.flatnonzero(inside[1:-1] > after) + 1
            per_text = np.searchsorted(starts, here)
            out["words"][first:last] += np.diff(per_text)
            for column, flag in (("capitals", IS_CAPITAL), ("code_points", IS_POINT), ("symbols", IS_SYMBOL)):
                out[column][first:last] += np.diff(np.searchsorted(np.flatnonzero(emits & flag), here))
            owner = np.repeat(np.arange(first, last), np.diff(per_text))
            kept = table.insert(starts + start, ends - starts, owner)
            out["distinct_words"] += np.bincount(owner[kept], minlength=n)
    return out


def text_groups(bounds: np.ndarray) -> Iterator[tuple[int, int]]:
    """Numbers [a, b) of neighbouring texts of about CHUNK_CHARS bytes together; one at least."""
    a, n = 0, len(bounds) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(bounds, bounds[a] + CHUNK_CHARS, side="right")) - 1)
        yield a, min(b, n)
        a = b


def string_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts and eight zeros, bounds): a null is an empty text."""
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    bounds = np.frombuffer(column.buffers()[1], np.int64, n + 1, column.offset * 8) if n else np.zeros(1, np.int64)
    data = column.buffers()[2]
    blob = np.zeros(int(bounds[-1] - bounds[0]) + 8, np.uint8)
    if data is not None:
        blob[:-8] = np.frombuffer(data, np.uint8)[bounds[0]:bounds[-1]]
    return blob, bounds - bounds[0]


COUNTS = ("words", "distinct_words", "capitals", "code_points", "symbols")


def measure(docs: DataFrame, *more: str) -> DataFrame:
    """(doc_id, text_sha256, words, distinct_words, capitals, code_points, symbols, *more) of every row.

    A null text is the empty text: all counts are 0. Repeated rows and rows
    without doc_id are measured each.
    """
    sha, text = fresh(docs.select(*more), "text_sha256"), F.coalesce(F.col("text"), F.lit(""))
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.sha2(text, 256).alias(sha), text.alias("text"), *more)
    out = read.drop("text").schema
    for c in COUNTS:
        out = out.add(c, "long")

    def run(batches):
        for batch in batches:
            counts = count_texts(*string_bytes(batch.column(2)))
            columns = [batch.column(k) for k in range(batch.num_columns) if k != 2]
            yield pa.RecordBatch.from_arrays([*columns, *(pa.array(counts[c], pa.int64()) for c in COUNTS)], out.names)

    return read.mapInArrow(run, out)


@dataclass(frozen=True)
class Limits:
    """Of the filters A to D; E, a copy of a smaller id's text, has none."""
    least_words: int = 200
    distinct_percent: int = 50
    capital_percent: int = 3


def failures(limits: Limits) -> dict[str, Column]:
    """Letter -> condition under which a measured row fails; E needs the whole table."""
    c = F.col
    return {"A": c("words") < limits.least_words,
            "B": 100 * c("distinct_words") < limits.distinct_percent * c("words"),
            "C": 100 * c("capitals") > limits.capital_percent * c("code_points"),
            "D": c("symbols") > 0}


def histogram(docs: DataFrame, labels: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """(part, mask, good, toxic, documents): the documents of each part by failed filters (bits) and labels.

    Rows without doc_id are no copies of any other and have no labels; of
    repeated labels the largest counts. Rows of one id and text are counted each.
    """
    bits = failures(limits)
    copy = 1 << len(bits)
    mask = sum((F.when(cond, F.lit(1 << k)).otherwise(F.lit(0)) for k, cond in enumerate(bits.values())), F.lit(0))
    measured = measure(docs.select("doc_id", "text", F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part")), "part")
    # a key of its own for rows without doc_id: they spread by their texts and meet no label
    one = measured.select("doc_id", F.unhex("text_sha256").alias("sha"), "part", mask.alias("mask"),
                          F.coalesce(F.col("doc_id"), F.xxhash64("text_sha256")).alias("key"), F.col("doc_id").isNotNull().alias("named")) \
        .groupBy("doc_id", "sha", "part", "mask", "key", "named").agg(F.count("*").alias("n"))
    known = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("l_id")) \
        .agg(F.max((F.col("quality") == 1).cast("int")).alias("q"), F.max((F.col("toxic") == 1).cast("int")).alias("t"))
    flag = lambda c: F.coalesce(F.col(c) == 1, F.lit(False))
    labelled = one.join(known, (F.col("key") == F.col("l_id")) & F.col("named"), "left") \
        .select("doc_id", "sha", "part", "mask", flag("q").alias("good"), flag("t").alias("toxic"), "n")
    # one row per text, part and labels: a group of copies shrinks before the shuffle
    texts = labelled.groupBy("sha", "part", "mask", "good", "toxic").agg(
        F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))).alias("least"),
        F.sum("n").alias("all"), F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("unnamed"))
    least = F.min("least.doc_id").over(Window.partitionBy("sha"))
    firsts = F.col("unnamed") + F.when(F.col("least.doc_id") == F.col("smallest"), F.col("least.n")).otherwise(0)
    parted = texts.withColumn("smallest", least).select(
        "part", "mask", "good", "toxic", F.explode(F.array(
            F.struct(F.lit(0).alias("bit"), firsts.alias("n")),
            F.struct(F.lit(copy).alias("bit"), (F.col("all") - firsts).alias("n")))).alias("e"))
    return parted.where("e.n > 0").groupBy("part", (F.col("mask") + F.col("e.bit")).alias("mask"), "good", "toxic") \
        .agg(F.sum("e.n").alias("documents"))


def steps(names: str) -> list[tuple[str, int, int, int]]:
    """(order, step, bits of the filters before it, its bit) of every step of every order."""
    bit = {c: 1 << k for k, c in enumerate(names)}
    return [("".join(order), k + 1, sum(bit[c] for c in order[:k]), bit[order[k]])
            for order in permutations(names) for k in range(len(order))]


def audit(docs: DataFrame, labels: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley).

    A part is a value of ``lang``, a null one the empty string; an empty table
    has no parts and no rows. ``shapley`` is the documents that the step's
    filter removes, summed over all orders: of the orders of a document's
    failed filters each filter leads an equal share.
    """
    spark = docs.sparkSession
    names = "".join(failures(limits)) + "E"
    orders = factorial(len(names))
    table = steps(names)
    found = histogram(docs, labels, limits)
    stages = sorted({(before, bit) for _, _, before, bit in table})
    each = found.withColumn("s", F.explode(F.array(*(F.struct(F.lit(a).alias("before"), F.lit(b).alias("bit")) for a, b in stages)))) \
        .select("*", "s.before", "s.bit")
    fails, gone = F.col("mask").bitwiseAND(F.col("bit")) > 0, F.col("mask").bitwiseAND(F.col("before")) > 0
    count = lambda cond, of=F.col("documents"): F.sum(F.when(cond, of).otherwise(F.lit(0))).cast("long")
    share = F.col("documents") * (F.lit(orders) / F.bit_count("mask")).cast("long")
    sums = each.groupBy("part", "before", "bit").agg(
        count(~fails & ~gone).alias("kept"), count(fails & ~gone).alias("removed"), count(fails & gone).alias("redundant"),
        count(F.col("mask") == F.col("bit")).alias("unique_fails"), count(fails & ~gone & F.col("good")).alias("good_lost"),
        count(fails & ~gone & F.col("toxic")).alias("toxic_lost"), count(fails, share).alias("shapley"))
    named = spark.createDataFrame(table, "filter_order string, step int, before int, bit int")
    return sums.join(F.broadcast(named), ["before", "bit"]).select(  # one row for each step of each order, whatever the data
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
