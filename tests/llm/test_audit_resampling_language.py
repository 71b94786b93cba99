"""Operators 11 to 13 against brute force and held-out labels; odd inputs."""

import hashlib
import math
import os
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from locastar.llm import filter_audit, language_id, registry, resampling

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")

LONG = "lorem ipsum dolor sit amet " * 30_000
#: Null and empty texts, a very long one, ties, a repeated row, null ids, null parts and clashing extra columns.
ODD = [(1, "a b c d e f", "x"), (2, None, "x"), (3, "", None), (4, "a b c d e f", None), (4, "a b c d e f", None),
       (None, "a b c d e f", "y"), (None, None, "y"), (6, LONG, "x"), (7, "É'S don't ½²x 漢字 İ ΑΣ 12 3 x\x1c y\x85z\r\n a\tb 🙂 | $", ""),
       (8, "word " * 250 + "ABC DEF GHI JKL", "x"), (9, " ".join(f"w{i}" for i in range(300)), "x"), (10, "x" * 900 + " " + "x" * 900 + " " + "x" * 899 + "y", "x"),
       (5, "word " * 250 + "ABC DEF GHI JKL", "x"), (11, " ".join(f"w{i}" for i in range(300)), None), (12, "?! 12 ..", "x")]
LABELS = [(1, 1, 0), (1, None, 1), (4, 1, 1), (6, 1, None), (None, 1, 1), (8, 0, 1), (99, 1, 1)]
COLUMNS = "doc_id long, text string, lang string, part string, mask string, n string, words string, weight string, score string, buckets string, `rank` string"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t, e, *["z"] * 8) for i, t, e in ODD], COLUMNS)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")


def read(spark, name, *columns):
    return [tuple(r) for r in spark.read.parquet(f"{SF}/{name}.parquet").select(*columns).collect()]


def fuzz(letters, n, size=50):
    r = random.Random(3)
    return ["".join(r.choice(letters) for _ in range(r.randint(0, size))) for _ in range(n)]


# ---------------------------------------------------------------- 11 filter audit

def plain_audit(rows, labels):
    q, t = defaultdict(bool), defaultdict(bool)
    for i, a, b in labels:
        q[i] |= i is not None and a == 1
        t[i] |= i is not None and b == 1
    out = defaultdict(lambda: [0] * 7)
    for i, text, lang in rows:
        text = text or ""
        w = re.findall("[^\x20\x09-\x0D]+", text)
        failed = {"A"} if len(w) < 200 else set()
        failed |= {"B"} if 100 * len(set(w)) < 50 * len(w) else set()
        failed |= {"C"} if 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text) else set()
        failed |= {"D"} if re.search(r"[#$%&*|]", text) else set()
        failed |= {"E"} if i is not None and any(j is not None and j < i and (u or "") == text for j, u, _ in rows) else set()
        first = Counter(next(c for c in order if c in failed) for order in permutations("ABCDE")) if failed else {}
        for order in permutations("ABCDE"):
            gone = False
            for k, c in enumerate(order):
                cell = out[(lang or "", "".join(order), k + 1)]
                now = c in failed
                cell[0] += not gone and not now
                cell[1] += now and not gone
                cell[2] += now and gone
                cell[3] += failed == {c}
                cell[4] += now and not gone and q[i]
                cell[5] += now and not gone and t[i]
                cell[6] += first.get(c, 0) if now else 0
                gone |= now
    return {(*k, *v) for k, v in out.items()}


def test_audit_equals_brute_force_on_odd_rows(spark, odd, labels):
    got = [tuple(r) for r in filter_audit.audit(odd, labels).collect()]
    assert len(got) == len(set(got)) and set(got) == plain_audit(ODD, LABELS)


def test_audit_query_equals_brute_force(spark):
    got = {tuple(r) for r in registry.QUERIES["op11_filter_audit"](spark, SF).collect()}
    assert got == plain_audit(read(spark, "documents", "doc_id", "text", "lang"), read(spark, "labels", "doc_id", "quality", "toxic"))


def test_audit_of_empty_tables(spark, odd, labels):
    assert filter_audit.audit(odd.where("false"), labels).collect() == []
    got = {tuple(r) for r in filter_audit.audit(odd, labels.where("false")).collect()}
    assert got == plain_audit(ODD, [])


@pytest.mark.parametrize("block,chunk", [(7, 512 << 10), (1 << 20, 64), (61, 200)])
def test_byte_machine_in_blocks(monkeypatch, block, chunk):
    monkeypatch.setattr(filter_audit, "BLOCK", block)
    monkeypatch.setattr(filter_audit, "CHUNK_CHARS", chunk)
    texts = [t for _, t, _ in ODD if t != LONG] + fuzz("ab \n\x00é漢|A🙂", 400)
    c = filter_audit.count_texts(*filter_audit.string_bytes(pa.array(texts, pa.string())))
    for k, t in enumerate(texts):
        w = re.findall("[^\x20\x09-\x0D]+", t or "")
        assert [int(c[x][k]) for x in filter_audit.COUNTS] == [
            len(w), len(set(w)), sum("A" <= x <= "Z" for x in t or ""), len(t or ""), sum(x in "#$%&*|" for x in t or "")]


def test_table_verifies_equal_hashes(monkeypatch):
    """With all hashes equal the bytes alone tell words apart."""
    monkeypatch.setattr(filter_audit.SpanTable, "hash", lambda self, s, z, o: np.zeros(len(s), np.uint64))
    texts = ["aa ab aa ba ab", "aa", "", "x" * 700 + " " + "x" * 699 + "y " + "x" * 700]
    c = filter_audit.count_texts(*filter_audit.string_bytes(pa.array(texts, pa.string())))
    assert c["distinct_words"].tolist() == [3, 1, 0, 2]


def test_sliced_arrow_columns():
    column = pa.array(["a b", None, "c C c", ""]).slice(1, 2)
    c = filter_audit.count_texts(*filter_audit.string_bytes(column))
    assert c["words"].tolist() == [0, 3] and c["distinct_words"].tolist() == [0, 2]


# ---------------------------------------------------------------- 12 resampling

def plain_features(text):
    w = [x.encode() for x in re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))]
    return len(w), [zlib.crc32(x) % 10000 for x in w] + [zlib.crc32(x + b" " + y) % 10000 for x, y in zip(w, w[1:])]


def plain_resample(rows, target):
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(plain_features(text)[1])
    for text in target:
        t.update(plain_features(text)[1])
    S, T = sum(s.values()), sum(t.values())
    out = []
    for i, text in rows:
        n, f = plain_features(text)
        gain = [math.floor(1000 * math.log((t[b] + 1) * (S + 10000) / ((s[b] + 1) * (T + 10000)))) for b in f]
        weight = sum(gain) // len(f) if f else 0
        score = None
        if i is not None:
            h = int(hashlib.sha256(f"7:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(f), weight, score, None, n])
    may = sorted((r for r in out if r[0] is not None and r[5] >= 20), key=lambda r: (-r[3], r[0]))
    for k, r in enumerate(may[:25 * len(may) // 100]):
        r[4] = k + 1
    return sorted(map(repr, (tuple(r[:5]) for r in out)))


def test_resampling_equals_brute_force(spark):
    got = sorted(repr(tuple(r)) for r in registry.QUERIES["op12_resampling"](spark, SF).collect())
    assert got == plain_resample(read(spark, "documents", "doc_id", "text"), [t for t, in read(spark, "benchmark", "text")])


def test_resampling_of_odd_rows(spark, odd):
    target = odd.where("doc_id in (1, 2, 9)").select("text", "n")
    got = sorted(repr(tuple(r)) for r in resampling.resample(odd, target).collect())
    assert got == plain_resample([r[:2] for r in ODD], [t for i, t, _ in ODD if i in (1, 2, 9)])
    assert resampling.resample(odd.where("false"), target).collect() == []
    got = sorted(repr(tuple(r)) for r in resampling.resample(odd, target.where("false")).collect())
    assert got == plain_resample([r[:2] for r in ODD], [])


def test_ranks_count_over_all_ranges(spark):
    df = spark.range(5000).selectExpr("id", "id % 7 as score")
    got = resampling.ranked(df.repartition(5), F.desc("score"), F.asc("id")).orderBy("rank").collect()
    want = sorted(((k % 7, k) for k in range(5000)), key=lambda x: (-x[0], x[1]))
    assert [(r["score"], r["id"]) for r in got] == want and [r["rank"] for r in got] == list(range(1, 5001))


@pytest.mark.parametrize("window", [5, 64, 1024])
def test_features_in_windows(monkeypatch, window):
    monkeypatch.setattr(resampling, "WINDOW", window)
    texts = [t or "" for _, t, _ in ODD if t != LONG] + fuzz("ab \n\x00é漢|A1", 300)
    found, words = resampling.bucket_runs(texts)
    for t, f, n in zip(texts, found, words):
        assert (n, Counter(f.tolist())) == (plain_features(t)[0], Counter(plain_features(t)[1]))


# ---------------------------------------------------------------- 13 language identification

def plain_vector(text, size, seed):
    """Bound and bundled letter by letter, without tables."""
    low = ["\0"]
    for c in text:
        c = c.lower() if len(c.lower()) == 1 else c
        if c.isalpha():
            low.append(c)
        elif low[-1] != "\0":
            low.append("\0")
    if low[-1] != "\0":
        low.append("\0")
    v = {c: language_id.letter_vectors(np.array([ord(c)]), size, seed)[0].astype(int) for c in set(low)}
    out = np.zeros(size, int)
    for a, b, c in zip(low, low[1:], low[2:]):
        out += np.roll(v[a], 2) * np.roll(v[b], 1) * v[c]
    return out


def test_bundles_equal_plain_vectors():
    texts = ["", "a", "Ab, cd!  Éa", "12", "漢字x", "a\0b", " x "] + fuzz("ab é漢1", 40, 12)
    codes, owner, which = language_id.grams(texts)
    got = language_id.bundle(owner, which, len(texts), codes, 256, 5)
    for t, v in zip(texts, got):
        assert v.astype(int).tolist() == plain_vector(t, 256, 5).tolist()


def test_sorting_and_blocks_change_nothing(monkeypatch):
    texts = fuzz("abcdefg hijé漢", 30)
    codes, owner, which = language_id.grams(texts)
    whole = language_id.bundle(owner, which, len(texts), codes, 128)
    monkeypatch.setattr(language_id, "DENSE", 1)
    monkeypatch.setattr(language_id, "BOUND_GRAMS", 7)
    codes, owner, which = language_id.grams(texts)
    assert (language_id.bundle(owner, which, len(texts), codes, 128) == whole).all()


def test_language_query_on_held_out_documents(spark):
    docs = {i: (t, lang) for i, t, lang in read(spark, "documents", "doc_id", "text", "lang")}
    got = registry.QUERIES["op13_language_id"](spark, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == docs[r.doc_id][1] for r in held) >= 0.98 * len(held)
    # prototypes and cosines by brute force
    size, total = language_id.SIZE, defaultdict(int)
    for i, (t, lang) in docs.items():
        if zlib.crc32(str(i).encode()) % 4 != 2:
            total[lang] = total[lang] + plain_vector(t[:0] or t, size, language_id.SEED)
    for r in held[:10]:
        v = plain_vector(docs[r.doc_id][0], size, language_id.SEED)
        cos = {k: v @ p / np.linalg.norm(v) / np.linalg.norm(p) for k, p in total.items()}
        assert r.lang_pred == max(sorted(cos), key=cos.get) and abs(r.score - max(cos.values())) < 1e-4


def test_language_of_odd_rows(spark, odd):
    known = odd.unionByName(odd.limit(0))
    profiles = language_id.train(known)
    assert set(profiles.langs) <= {"x", "y", ""}
    got = language_id.identify(odd, profiles).collect()
    assert len(got) == len(ODD)
    by = defaultdict(set)
    for r in got:
        by[r.doc_id].add((r.held_out, r.lang_pred, r.score))
    assert {p for i in (2, 3, 12) for _, p, _ in by[i]} == {"und"} and {s for i in (2, 3, 12) for *_, s in by[i]} == {0.0}
    assert all(p in profiles.langs for i in (1, 4, 6, 7, 8) for _, p, _ in by[i]) and len(by[4]) == 1
    assert not any(h for h, *_ in by[None])
    nothing = language_id.train(odd.where("false"))
    assert nothing.langs == [] and {r.lang_pred for r in language_id.identify(odd, nothing).collect()} == {"und"}
    assert language_id.identify(odd.where("false"), profiles).collect() == []
    with pytest.raises(ValueError):
        language_id.train(odd, gram=4)
