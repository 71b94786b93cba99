"""Language identification by hyperdimensional profiles (operator 13).

Every letter has a random vector of +1 and -1. An n-gram of letters binds
(multiplies) its letters' vectors, each rotated by its place; a text bundles
(adds) the vectors of its n-grams, and a language bundles its texts. A text's
language is the prototype of the largest cosine. Bundling is linear, so a
task adds up n-grams of one language before it binds them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locastar.llm.common import chunks, texts_of
from locastar.llm.words import mix

#: Coordinates of a vector; letters in an n-gram; seed of the letters' vectors.
SIZE = 1024
GRAM = 3
SEED = 13
#: Characters whose n-grams are bound at once.
GROUP_CHARS = 128 << 10
#: Distinct n-grams bound at once: their vectors take SIZE * 4 bytes each.
BOUND_GRAMS = 8192
#: Values below this are numbered by a table, others by sorting.
DENSE = 1 << 21
#: Code point that stands for any run of other characters between letters.
GAP = 0


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """Code point -> its lower case where it is a letter, else GAP."""
    out = np.zeros(0x110000, np.uint32)
    for c in range(0x110000):
        if not 0xD800 <= c < 0xE000 and (s := chr(c)).isalpha():
            low = s.lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


def letter_vectors(codes: np.ndarray, size: int, seed: int) -> np.ndarray:
    """(code, coordinate) -> +1 or -1, the bits of hashes of code, place and seed."""
    with np.errstate(over="ignore"):
        key = mix(codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))
        words = mix(key[:, None] ^ (np.arange(1, size // 64 + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
    bits = np.unpackbits(words.view(np.uint8), axis=1)
    return (bits.astype(np.int8) << 1) - 1


def numbered(values: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct values in order, number of each value among them), of values below ``limit``."""
    if limit > DENSE:
        return np.unique(values, return_inverse=True)
    seen = np.zeros(limit, bool)
    seen[values] = True
    kinds = np.flatnonzero(seen)
    place = np.empty(limit, np.int32)
    place[kinds] = np.arange(len(kinds), dtype=np.int32)
    return kinds, place[values]


def grams(texts: list[str], gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes of each distinct n-gram, text of each occurrence, its n-gram); runs without letters are one gap.

    A text begins and ends with a gap; one without letters has no n-grams.
    """
    coded = np.frombuffer(("\0" + "\0".join(texts) + "\0").encode("utf-32-le"), np.uint32)
    low = letters()[coded]
    bounds = np.cumsum([1] + [len(t) + 1 for t in texts])[:-1]
    doc = np.zeros(len(low), np.int64)
    doc[bounds[1:]] = 1
    doc = np.cumsum(doc)  # the gap before a text belongs to the one before it
    keep = (low != GAP) | np.append(True, low[:-1] != GAP)
    low, doc = low[keep], doc[keep]
    alphabet, small = numbered(low, 0x110000)
    n = len(low) - gram + 1
    if n <= 0:
        return np.zeros((0, gram), np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)
    key = np.zeros(n, np.int64)
    for k in range(gram):
        key = key * len(alphabet) + small[k:n + k]
    # an n-gram belongs to the text of its letters; a gap inside it must not part two texts
    first = np.where(low == GAP, -1, doc)
    owner = first[:n].copy()
    for k in range(1, gram):
        owner = np.maximum(owner, first[k:n + k])
    whole = owner >= 0
    for k in range(gram):
        here = first[k:n + k]
        whole &= (here < 0) | (here == owner)
    key, owner = key[whole], owner[whole]
    kinds, which = numbered(key, len(alphabet) ** gram)
    codes = np.empty((len(kinds), gram), np.uint32)
    left = kinds
    for k in range(gram - 1, -1, -1):
        codes[:, k] = alphabet[left % len(alphabet)]
        left = left // len(alphabet)
    return codes, owner, which


def bind(codes: np.ndarray, size: int = SIZE, seed: int = SEED) -> np.ndarray:
    """The vector of each n-gram: the product of its letters' vectors, the last unrotated."""
    alphabet, small = numbered(codes.reshape(-1), 0x110000)
    vectors, small = letter_vectors(alphabet, size, seed), small.reshape(codes.shape)
    out = None
    for k in range(codes.shape[1]):
        rotated = np.roll(vectors, codes.shape[1] - 1 - k, axis=1)[small[:, k]]
        out = rotated if out is None else np.multiply(out, rotated, out=out)
    return out


def bundle(rows: np.ndarray, which: np.ndarray, n: int, codes: np.ndarray, size: int = SIZE, seed: int = SEED) -> np.ndarray:
    """(row, coordinate): the sum of the vectors of each row's n-grams, BOUND_GRAMS distinct ones at a time."""
    out = np.zeros((n, size), np.float32)
    for a in range(0, len(codes), BOUND_GRAMS):
        b = min(a + BOUND_GRAMS, len(codes))
        here = (which >= a) & (which < b)
        times = np.bincount(rows[here] * (b - a) + which[here] - a, minlength=n * (b - a)).reshape(n, b - a)
        out += times.astype(np.float32) @ bind(codes[a:b], size, seed).astype(np.float32)
    return out


@dataclass(frozen=True)
class Profiles:
    """Languages in order and the unit vector of each one's prototype."""
    langs: list[str]
    vectors: np.ndarray
    gram: int
    seed: int


def fold_of(doc_id: str, fold: int):
    return F.crc32(F.col(doc_id).cast("string")) % fold


def train(docs: DataFrame, fold: int = 4, held: int = 2, size: int = SIZE, gram: int = GRAM, seed: int = SEED) -> Profiles:
    """Prototypes from all rows with an id outside the held-out fold, a text and a language.

    ``gram`` is 3 at most, so that a single letter between gaps makes one.
    Each task adds up its own rows: one row for each language and coordinate
    leaves it, and the driver gets ``size`` numbers for each language.
    """

    if not 1 <= gram <= 3:
        raise ValueError("gram must be 1, 2 or 3")

    def run(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in chunks(texts):
                names = sorted(set(langs[a:b]))
                number = {name: k for k, name in enumerate(names)}
                codes, owner, which = grams(texts[a:b], gram)
                of = np.array([number[x] for x in langs[a:b]], np.int64)
                found = bundle(of[owner], which, len(names), codes, size, seed)
                for k, name in enumerate(names):
                    # whole numbers: the order of tasks can not change a sum
                    sums[name] = sums.get(name, 0) + np.rint(found[k]).astype(np.int64)
        for name, total in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([name] * size, pa.string()), pa.array(range(size), pa.int32()), pa.array(total)], ["lang", "at", "n"])

    known = texts_of(docs, F.col("lang").cast("string").alias("lang")).where("lang is not null and text <> ''").where(fold_of("doc_id", fold) != held)
    rows = known.select("lang", "text").mapInArrow(run, "lang string, at int, n long").groupBy("lang", "at").agg(F.sum("n").alias("n")).collect()
    langs = sorted({r["lang"] for r in rows})
    vectors = np.zeros((len(langs), size))
    place = {name: k for k, name in enumerate(langs)}
    for r in rows:
        vectors[place[r["lang"]], r["at"]] = r["n"]
    norm = np.linalg.norm(vectors, axis=1, keepdims=True)
    some = norm[:, 0] > 0  # a language without letters has no prototype
    return Profiles([x for x, s in zip(langs, some) if s], (vectors[some] / norm[some]).astype(np.float32), gram, seed)


def cosines(texts: list[str], p: Profiles) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(whether a text has letters, its cosine with each prototype), group by group."""
    size = p.vectors.shape[1]
    for a, b in chunks(texts, GROUP_CHARS):
        codes, owner, which = grams(texts[a:b], p.gram)
        found = bundle(owner, which, b - a, codes, size, p.seed)
        norm = np.linalg.norm(found, axis=1)
        some = np.bincount(owner, minlength=b - a) > 0
        yield some, (found @ p.vectors.T) / np.maximum(norm, 1)[:, None]


def identify(docs: DataFrame, profiles: Profiles, fold: int = 4, held: int = 2) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row; ``score`` is the cosine, 0 at least.

    Texts that are null or have no letter are ``und`` with score 0, as are all
    without any learned language. A row without doc_id is never held out; of
    equal cosines the first language counts.
    """

    def run(batches):
        for batch in batches:
            texts, langs, scores = batch.column(1).to_pylist(), [], []
            if profiles.langs:
                for some, cos in cosines(texts, profiles):
                    best = cos.argmax(axis=1)
                    langs += [profiles.langs[k] if s else "und" for k, s in zip(best, some)]
                    scores += np.where(some, np.clip(cos.max(axis=1), 0, 1), 0).tolist()
            else:
                langs, scores = ["und"] * len(texts), [0.0] * len(texts)
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                                             ["doc_id", "lang_pred", "score"])

    scored = texts_of(docs).mapInArrow(run, "doc_id long, lang_pred string, score double")
    return scored.select("doc_id", F.coalesce(fold_of("doc_id", fold) == held, F.lit(False)).alias("held_out"), "lang_pred", "score")
