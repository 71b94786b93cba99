"""Near duplicates by a signature-coordinate inverted join (operator 8).

A document's set of word shingles gets a signature of COORDINATES minima.
Documents are posted under (coordinate, value). Two documents whose sets share
80 % agree in about 51 of 64 coordinates, and in fewer than 34 with
probability below MISSED; ``matches_for`` gives that number for any share. So
only pairs with that many matches matter, and two rules keep the lists short:

* prefix: a pair with m collisions meets in the COORDINATES - m + 1
  rarest values of each of its documents. Values that many documents share, as
  from a common passage, are posted only by documents that have little else.
* skip: a pair is counted in one list alone, that of its first common prefix
  coordinate, and not checked when its documents are already linked there.

Documents with one set are one class. Pairs are told apart inside the tasks
and verified on the full sets; what leaves a task are at most as many links as
hold the documents of a list together. A long list is dealt out in blocks.
"""

from __future__ import annotations

import hashlib
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locastar.llm.common import chunks, small_batches, texts_of, written
from locastar.llm.components import components
from locastar.llm.words import SPACED, joined, mix, word_hashes

COORDINATES = 64
#: Probability that a pair of just the wanted share is missed, at most.
MISSED = 4e-7
#: Documents and shingles of a list that one task compares with another such block.
BLOCK_ROWS = 1024
BLOCK_SHINGLES = 2_000_000
#: Pairs compared at once.
PAIRS = 32_000

_MULTIPLIERS = mix(np.arange(1, COORDINATES + 1, dtype=np.uint64)) | np.uint64(1)


def matches_for(percent: int) -> int:
    """The collisions that a pair of this share has with probability 1 - MISSED.

    Each coordinate collides with the share's probability. A share so low that
    such a pair may have none can not be told by these signatures.
    """
    share, below, m = percent / 100, 0.0, 0
    while m < COORDINATES and (below := below + comb(COORDINATES, m) * share ** m * (1 - share) ** (COORDINATES - m)) <= MISSED:
        m += 1
    if not m:
        raise ValueError(f"{percent} % is too low for {COORDINATES} coordinates")
    return m


def shingle_sets(texts: list[str], words: int) -> list[np.ndarray]:
    """The sorted distinct 64-bit hashes of each text's shingles of ``words`` words.

    A-Z count as a-z. A text with fewer words has its whole sequence as one
    shingle, a text without words the empty set.
    """
    h, bounds = word_hashes(texts, SPACED)
    wide = joined(*(h[k:len(h) - words + 1 + k] for k in range(words))) if len(h) >= words else h[:0]
    out = []
    for a, b in zip(bounds[:-1], bounds[1:]):
        if b - a >= words:
            out.append(np.unique(wide[a:b - words + 1]))
        else:
            out.append(joined(*(h[k:k + 1] for k in range(a, b))) if b > a else h[:0])
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """(len(sets), COORDINATES) 32-bit minima; an empty set's are the largest value."""
    out = np.full((len(sets), COORDINATES), 0xFFFFFFFF, np.uint32)
    some = [k for k, s in enumerate(sets) if len(s)]
    if not some:
        return out
    flat = np.concatenate([sets[k] for k in some])
    starts = np.concatenate([[0], np.cumsum([len(sets[k]) for k in some])[:-1]])
    with np.errstate(over="ignore"):
        for c in range(COORDINATES):
            out[some, c] = np.minimum.reduceat(((flat * _MULTIPLIERS[c]) >> np.uint64(32)).astype(np.uint32), starts)
    return out


def set_key(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def signed(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, n_shingles, set_key, sig): key and signature are null for an empty set."""

    def run(batches):
        for batch in batches:
            texts = batch.column(1).to_pylist()
            n, keys, sigs = [], [], []
            for a, b in chunks(texts):
                sets = shingle_sets(texts[a:b], words)
                n += [len(s) for s in sets]
                keys += [set_key(s) if len(s) else None for s in sets]
                sigs += [row.tobytes() if len(s) else None for s, row in zip(sets, signatures(sets))]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(n, pa.int64()), pa.array(keys, pa.binary()),
                                              pa.array(sigs, pa.binary())], ["doc_id", "n_shingles", "set_key", "sig"])

    return texts_of(docs.where("doc_id is not null")).mapInArrow(run, "doc_id long, n_shingles long, set_key binary, sig binary")


def posted(classes: DataFrame) -> DataFrame:
    """(rep, token): one row for each coordinate; the token is coordinate * 2**32 + value."""

    def run(batches):
        places = (np.arange(COORDINATES, dtype=np.int64) << 32)[None, :]
        for batch in batches:
            rep = batch.column(0).to_numpy()
            sig = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint32).reshape(-1, COORDINATES)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(rep, COORDINATES)), pa.array((sig.astype(np.int64) | places).ravel())],
                                             ["rep", "token"])

    return classes.select("rep", "sig").mapInArrow(run, "rep long, token long")


def prefixes(classes: DataFrame, matches: int) -> DataFrame:
    """(rep, prefix, mask) of the classes that can reach ``matches`` collisions.

    prefix: the tokens that a partner must meet; mask: their coordinates as bits.
    """
    tokens = posted(classes)
    common = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    own = tokens.join(common, "token").groupBy("rep").agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("all")) \
        .where(F.size("all") >= matches)
    prefix = F.transform(F.slice("all", F.lit(1), F.size("all") - (matches - 1)), lambda x: x["token"])
    return own.select("rep", prefix.alias("prefix")).withColumn("mask", F.expr(
        "aggregate(prefix, 0L, (m, t) -> m | shiftleft(1L, cast(shiftright(t, 32) as int)))"))


LISTED = "token long, low int, high int, side int, rep long, n_shingles long, mask long, set_key binary, sig binary"
KEY = ["token", "low", "high"]


def lists(classes: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows of each list by blocks: (token, low, high) holds block low (side 0) and block high (side 1)."""
    rows = kept.join(classes, "rep").select("rep", "n_shingles", "mask", "set_key", "sig", F.explode("prefix").alias("token"))
    sizes = kept.join(classes.select("rep", "n_shingles"), "rep").select("n_shingles", F.explode("prefix").alias("token")) \
        .groupBy("token").agg(F.count(F.lit(1)).alias("c"), F.sum("n_shingles").alias("s")).where("c > 1") \
        .select("token", F.greatest(F.ceil(F.col("c") / BLOCK_ROWS), F.ceil(F.col("s") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    dealt = rows.join(sizes, "token").withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return dealt.select("token", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
                        (F.col("block") > F.col("other")).cast("int").alias("side"), "rep", "n_shingles", "mask", "set_key", "sig")


def whole_groups(batches):
    """Tables that hold whole (token, low, high) groups of the sorted rows, with the groups' bounds."""
    held = None
    for batch in batches:
        part = pa.Table.from_batches([batch])
        held = part if held is None else pa.concat_tables([held, part])
        bounds = group_bounds(held)
        if len(bounds) > 2 and (held.num_rows >= 1000 or held.nbytes > 8 << 20):
            yield held.slice(0, bounds[-2]), bounds[:-1]
            held = held.slice(bounds[-2])
    if held is not None and held.num_rows:
        yield held, group_bounds(held)


def group_bounds(rows: pa.Table) -> np.ndarray:
    keys = [rows.column(k).to_numpy() for k in KEY]
    new = np.ones(rows.num_rows, bool)
    if rows.num_rows > 1:
        new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    return np.append(np.flatnonzero(new), rows.num_rows)


def matching_pairs(rows: pa.Table, bounds: np.ndarray, percent: int):
    """(left, right, matches) row numbers of the pairs inside the groups that
    collide in ``matches_for(percent)`` coordinates, may be alike by size, and are told in this list."""
    column, matches = lambda n: rows.column(n).to_numpy(), matches_for(percent)
    token, low, high, side, size = (column(n) for n in ("token", "low", "high", "side", "n_shingles"))
    mask = column("mask").view(np.uint64)
    sig = np.frombuffer(b"".join(rows.column("sig").to_pylist()), np.uint32).reshape(-1, COORDINATES)
    place = np.uint64(1) << (token >> 32).astype(np.uint64)
    end = np.repeat(bounds[1:], np.diff(bounds))
    later = end - np.arange(len(end)) - 1
    total = np.concatenate([[0], np.cumsum(later)])
    at = 0
    while at < total[-1]:
        first = int(np.searchsorted(total, at, side="right")) - 1
        last = min(max(int(np.searchsorted(total, at + PAIRS, side="right")) - 1, first + 1), len(later))
        left = np.repeat(np.arange(first, last), later[first:last])
        right = left + 1 + np.arange(total[first], total[last]) - total[left]
        at = total[last]
        ok = ((low[left] == high[left]) | (side[left] != side[right])) & \
            (100 * np.minimum(size[left], size[right]) >= percent * np.maximum(size[left], size[right]))
        left, right = left[ok], right[ok]
        bits = np.packbits(sig[left] == sig[right], axis=1, bitorder="little").view(np.uint64).ravel()
        common = bits & mask[left] & mask[right]
        with np.errstate(over="ignore"):
            told = (common & (~common + np.uint64(1))) == place[left]
        n = np.bitwise_count(bits)
        ok = told & (n >= matches)
        if ok.any():
            yield left[ok], right[ok], n[ok]


def involved(rows: DataFrame, percent: int) -> DataFrame:
    """The rows of the lists that have a matching pair there."""

    def run(batches):
        for table, bounds in whole_groups(batches):
            hit = np.zeros(table.num_rows, bool)
            for left, right, _ in matching_pairs(table, bounds, percent):
                hit[left] = hit[right] = True
            if hit.any():
                yield from table.filter(pa.array(hit)).combine_chunks().to_batches()

    return rows.repartition(*KEY).sortWithinPartitions(*KEY).mapInArrow(run, LISTED)


def with_sets(docs: DataFrame, rows: DataFrame, words: int) -> DataFrame:
    """``rows`` with the full set of each class, made anew from the text of its representative."""

    def run(batches):
        for batch in batches:
            rep, key, texts = (batch.column(k).to_pylist() for k in range(3))
            for a, b in chunks(texts):
                sets = shingle_sets(texts[a:b], words)
                # a doc_id may repeat with another text: only the class's own set counts
                good = [k for k, s in enumerate(sets) if set_key(s) == key[a + k]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([rep[a + k] for k in good], pa.int64()), pa.array([sets[k].tobytes() for k in good], pa.binary())],
                    ["rep", "shingles"])

    need = rows.select(F.col("rep").alias("doc_id"), "set_key").distinct()
    texts = texts_of(docs).join(need, "doc_id").select(F.col("doc_id").alias("rep"), "set_key", "text")
    sets = texts.mapInArrow(run, "rep long, shingles binary")
    return rows.join(sets, "rep")


def linked(rows: DataFrame, percent: int) -> DataFrame:
    """(a, b): verified links, in each list as many as connect its classes."""

    def run(batches):
        for table, bounds in whole_groups(batches):
            rep = table.column("rep").to_numpy()
            sets = [np.frombuffer(s, np.uint64) for s in table.column("shingles").to_pylist()]
            root = np.arange(len(rep))

            def find(k):
                while root[k] != k:
                    root[k] = root[root[k]]
                    k = root[k]
                return k

            out: list[tuple[int, int]] = []
            for left, right, n in matching_pairs(table, bounds, percent):
                order = np.argsort(-n.astype(np.int64), kind="stable")
                left, right = left[order], right[order]
                by = np.argsort(left, kind="stable")
                cuts = np.flatnonzero(np.diff(left[by], prepend=-1))
                for at, to in zip(cuts, np.append(cuts[1:], len(by))):
                    a = int(left[by[at]])
                    others = [int(b) for b in right[by[at:to]] if find(b) != find(a)]
                    for some in (others[k:k + 256] for k in range(0, len(others), 256)):
                        flat = np.concatenate([sets[b] for b in some])
                        lens = np.array([len(sets[b]) for b in some])
                        pos = np.minimum(np.searchsorted(sets[a], flat), len(sets[a]) - 1)
                        both = np.add.reduceat((sets[a][pos] == flat).astype(np.int64), np.concatenate([[0], np.cumsum(lens)[:-1]]))
                        for b, hit in zip(some, 100 * both >= percent * (lens + len(sets[a]) - both)):
                            if hit and find(a) != find(b):
                                root[find(a)] = find(b)
                                out.append((int(rep[a]), int(rep[b])))
            if out:
                a, b = zip(*out)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return rows.repartition(*KEY).sortWithinPartitions(*KEY).mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Documents are linked when their shingle sets share at least ``percent`` of
    their union; component_id is the smallest doc_id reached over links,
    itself included, and that document is kept. A null or empty text has no
    shingles, no links, and is kept. Rows without a doc_id are left out. Rows
    that repeat a doc_id are one document, whose text is the one of the least
    (set key). No rows give no rows.
    """
    matches = matches_for(percent)
    small_batches(docs.sparkSession)
    marked = signed(docs, words)
    marked = written(marked.groupBy("doc_id").agg(F.min(F.struct("set_key", "n_shingles", "sig")).alias("m"))
                     .select("doc_id", "m.set_key", "m.n_shingles", "m.sig"), "signed")
    some = marked.where("set_key is not null")
    ids = some.groupBy("set_key").agg(F.min("doc_id").alias("rep"))
    classes = written(some.join(ids.withColumnRenamed("rep", "doc_id"), ["set_key", "doc_id"])
                      .select(F.col("doc_id").alias("rep"), "n_shingles", "set_key", "sig"), "classes")
    kept = written(prefixes(classes, matches), "prefixes")
    found = written(involved(lists(classes, kept), percent), "involved")
    links = linked(with_sets(docs, found, words), percent)
    groups = components(links, "near")
    members = marked.drop("sig").join(ids, "set_key", "left").select(
        "doc_id", "n_shingles", F.coalesce("rep", "doc_id").alias("rep"))
    named = members.join(groups.withColumnRenamed("node", "rep"), "rep", "left")
    return named.select("doc_id", "n_shingles", F.coalesce("component", "rep").alias("component_id")) \
        .withColumn("kept", F.col("doc_id") == F.col("component_id"))
