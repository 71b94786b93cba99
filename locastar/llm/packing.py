"""Packing by cutting-stock column generation (operator 9).

Documents are cut into full sequences and one remainder. The histogram of
remainders by length class is bounded by the sequence size, so the linear
program over packing patterns runs on the driver whatever the corpus size;
its columns are priced by a knapsack over the classes. The rounded patterns
are given to ranked pieces in Spark.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from locastar.llm.common import texts_of, written
from locastar.llm.tokens import rest, word_encoder

#: Tokens in one length class.
GRAIN = 8
#: Pieces ranked together in one group.
RANKED = 50_000
#: The program stops this close to its lower bound.
GAP = 1e-3

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def cut(docs: DataFrame, path: str, size: int, end_id: int) -> DataFrame:
    """Pieces of every row's ids and ``end_id``: full sequences, then the remainder.

    Null and empty texts are the end id alone; repeated rows are cut each.
    """
    tail = end_id.to_bytes(4, "little")

    def run(batches):
        coder = word_encoder(path)
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = coder.encode(text) + tail
                n = len(ids) // 4
                out += [(doc_id, a, min(size, n - a), zlib.crc32(ids[4 * a:4 * (a + size)]), n) for a in range(0, n, size)]
            columns = list(zip(*out)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns],
                                             [f.split()[0] for f in PIECES.split(", ")])
        rest(coder.words, coder.pieces)

    return texts_of(docs).mapInArrow(run, PIECES)


def price(value: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """The most valuable pattern that fits: an unbounded knapsack by dynamic programming.

    value[w - 1] is a piece's of width w, below 0 where there is no such piece.
    """
    best, took = np.zeros(room + 1), np.zeros(room + 1, np.int64)
    for w in range(1, room + 1):
        gain = best[w - 1::-1] + value[:w]
        k = int(gain.argmax())
        best[w] = best[w - 1]
        if gain[k] > best[w] + 1e-12:
            best[w], took[w] = gain[k], k + 1
    pattern, w = np.zeros(room), room
    while w > 0:
        if took[w]:
            pattern[took[w] - 1] += 1
            w -= took[w]
        else:
            w -= 1
    return best[room], pattern


def patterns_for(width: np.ndarray, demand: np.ndarray, room: int, rounds: int = 5000) -> tuple[np.ndarray, np.ndarray]:
    """(patterns as columns, how often each is used) of the linear program: fewest
    sequences that hold ``demand[k]`` pieces of ``width[k]`` (ascending).

    Revised simplex: the inverse of the basis follows each exchange of one
    column. Rounding errors cost a little padding at most, since the plan
    counts pieces itself.
    """
    basis = np.diag((room // width).astype(float))
    inverse = np.diag(1 / np.diag(basis))
    use = demand / np.diag(basis)
    value = np.full(room, -1.0)
    for _ in range(rounds):
        value[width - 1] = np.maximum(inverse.sum(axis=0), 0)
        worth, pattern = price(value, room)
        if worth <= 1 + GAP:
            break
        column = pattern[width - 1]
        step = (inverse * column).sum(axis=1)  # in plain numpy: threads of a linear algebra library compete with the JVM's
        able = step > 1e-9
        ratio = np.full(len(use), np.inf)
        ratio[able] = use[able] / step[able]
        out = int(ratio.argmin())
        theta = ratio[out]
        use = np.maximum(use - theta * step, 0)
        use[out] = theta
        basis[:, out] = column
        row = inverse[out] / step[out]
        step[out] -= 1
        inverse -= step[:, None] * row[None, :]
        inverse[out] = row
    return basis, use


@dataclass
class Plan:
    """Slots of each class in rank order: from ``first[k]`` on, ``each[k]`` in a row go to
    each of the sequences from ``base[k]`` on."""
    first: dict[int, np.ndarray]
    each: dict[int, np.ndarray]
    base: dict[int, np.ndarray]
    sequences: int


def plan(histogram: dict[int, int], size: int) -> Plan:
    """From class -> number of pieces. Fractions are rounded down; the pieces left
    over (a few for each pattern) are placed first fit, longest first."""
    room = -(-size // GRAIN)
    width = np.array(sorted(histogram), dtype=np.int64)
    if not len(width):
        return Plan({}, {}, {}, 0)
    demand = np.array([histogram[int(w)] for w in width], dtype=np.int64)
    basis, use = patterns_for(width, demand.astype(float), room)
    left, rows = demand.copy(), []
    for k in np.argsort(-use):
        pattern = np.minimum(basis[:, k].astype(np.int64), left)
        times = int(use[k] + 1e-6)
        full = pattern > 0
        if times and full.any():
            times = min(times, int((left[full] // pattern[full]).min()))
            rows.append((times, pattern))
            left -= times * pattern
    gaps: list[tuple[int, np.ndarray]] = []
    for k in range(len(width) - 1, -1, -1):
        for free, pattern in gaps_in(gaps, int(width[k])):
            n = min(int(left[k]), free // int(width[k]))
            pattern[k] += n
            left[k] -= n
        per = room // int(width[k])
        if left[k] // per:
            whole = np.zeros(len(width), np.int64)
            whole[k] = per
            rows.append((int(left[k] // per), whole))
            left[k] %= per
        if left[k]:
            last = np.zeros(len(width), np.int64)
            last[k], left[k] = left[k], 0
            gaps.append((room, last))
        gaps = [(room - int((p * width).sum()), p) for _, p in gaps]
    rows += [(1, p) for _, p in gaps]
    first, each, base, at, used = {}, {}, {}, np.zeros(len(width), np.int64), 0
    for times, pattern in rows:
        for k in np.flatnonzero(pattern):
            c = int(width[k])
            first.setdefault(c, []).append(int(at[k]))
            each.setdefault(c, []).append(int(pattern[k]))
            base.setdefault(c, []).append(used)
            at[k] += times * pattern[k]
        used += times
    arrays = lambda d: {c: np.array(v, np.int64) for c, v in d.items()}
    return Plan(arrays(first), arrays(each), arrays(base), used)


def gaps_in(gaps, width: int):
    return [(free, pattern) for free, pattern in gaps if free >= width]


def pack(docs: DataFrame, path: str, size: int = 2048, end_id: int = 1) -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Every row of ``docs`` is packed, repeated rows and rows without an id or
    text too. Empty input gives no pieces.
    """
    pieces = written(cut(docs, path, size, end_id), "pieces") \
        .withColumn("class", F.ceil(F.col("length") / GRAIN).cast("long"))
    counts = {r[0]: r[1] for r in pieces.groupBy("class").count().collect()}  # at most size / GRAIN rows
    ranked = rank(pieces, {c: -(-n // RANKED) for c, n in counts.items()})
    made = plan(counts, size)

    def place(batches):
        for batch in batches:
            cls, rank_ = (batch.column(batch.schema.get_field_index(n)).to_numpy() for n in ("class", "rank"))
            seq, slot = np.zeros(len(cls), np.int64), np.zeros(len(cls), np.int64)
            for c in np.unique(cls):
                at = np.flatnonzero(cls == c)
                c = int(c)
                k = np.searchsorted(made.first[c], rank_[at], side="right") - 1
                over = rank_[at] - made.first[c][k]
                seq[at] = made.base[c][k] + over // made.each[c][k]
                slot[at] = over % made.each[c][k] - c * (size + 1)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(5)), pa.array(seq), pa.array(slot)],
                [f.split()[0] for f in PIECES.split(", ")] + ["sequence_id", "slot"])

    placed = ranked.mapInArrow(place, PIECES + ", sequence_id long, slot long")
    before = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long")).drop("slot")


def rank(pieces: DataFrame, blocks: dict[int, int]) -> DataFrame:
    """Ranks from 0 inside each class. A class that holds many pieces is ranked in
    blocks by hash, so that no group grows with the corpus."""
    if not blocks:
        return pieces.withColumn("rank", F.lit(0).cast("long"))
    n_blocks = F.element_at(F.create_map(*[F.lit(x).cast("long") for kv in blocks.items() for x in kv]), F.col("class"))
    dealt = pieces.withColumn("block", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), n_blocks))
    earlier = Window.partitionBy("class").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    bases = dealt.groupBy("class", "block").count() \
        .select("class", "block", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("base"))
    inside = Window.partitionBy("class", "block").orderBy("doc_id", "start", "ids_crc32")
    return dealt.join(bases, ["class", "block"]) \
        .withColumn("rank", (F.col("base") + F.row_number().over(inside) - 1).cast("long")) \
        .select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "class", "rank")
