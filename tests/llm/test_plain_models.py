"""The two classifiers against plain loops: grams and FTRL of operator 2, statistics and trees of operator 5."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from locastar.llm import quality, toxicity, words

TEXTS = ["", " ", "One two, three! two two", "a\nb\n\nA\nb", "É'S don't ½²x ǅ İstanbul\t漢字 🙂 12", "| a | b | $x$ (y)\r\nline\n", "UPPER lower 1.2.3", "\n\n"]


def texts(n=150):
    r = random.Random(5)
    return TEXTS + ["".join(r.choice("abAB \n.é漢|,1") for _ in range(r.randint(0, 60))) for _ in range(n)]


def letter_words(text):
    return re.findall(rb"[0-9a-z\x80-\xff]+", text.encode().lower())


def test_grams_are_words_pairs_and_skip_pairs():
    all_texts = texts()
    docs, ids = toxicity.grams(all_texts)
    one = lambda w: words.word_hashes([w.decode("utf-8")], words.LETTERS)[0]
    for k, t in enumerate(all_texts):
        h = [one(w) for w in letter_words(t)]
        want = [words.mix(x) for x in h]
        want += [words.joined(h[i] + np.uint64(gap), h[i + gap]) for gap in (1, 2, 3) for i in range(len(h) - gap)]
        assert Counter(ids[docs == k].tolist()) == Counter(int(w[0] >> np.uint64(64 - toxicity.BITS)) for w in want), t


def plain_ftrl(examples, labels, s):
    z, n = Counter(), Counter()

    def weight(i):
        if abs(z[i]) <= s.l1:
            return 0.0
        return -(z[i] - math.copysign(s.l1, z[i])) / ((s.beta + math.sqrt(n[i])) / s.alpha + s.l2)
    for _ in range(s.epochs):
        for ids, y in zip(examples, labels):
            at = [*ids, "bias"]
            w = {i: weight(i) for i in at}
            g = 1 / (1 + math.exp(-max(-35, min(35, sum(w.values()))))) - y
            for i in at:
                z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / s.alpha * w[i]
                n[i] += g * g
    return {i: weight(i) for i in z}


@pytest.mark.parametrize("l1", [0.0, 0.5, 3.0])
def test_ftrl_equals_a_loop_over_coordinates(l1):
    r = random.Random(2)
    examples = [np.array(sorted(r.sample(range(200), r.randint(0, 25))), np.int64) for _ in range(120)]
    labels = np.array([int(3 in e or 7 in e) for e in examples])
    s = toxicity.Settings(l1=l1, epochs=4)
    model, want = toxicity.fit(examples, labels, s), plain_ftrl([e.tolist() for e in examples], labels.tolist(), s)
    assert abs(model.bias - want.pop("bias")) < 1e-9
    got = dict(zip(model.ids.tolist(), model.weights.tolist()))
    assert set(got) == {i for i, w in want.items() if w} and all(abs(got[i] - want[i]) < 1e-5 for i in got)


def test_statistics_equal_plain_counts():
    all_texts = texts()
    got = quality.statistics(all_texts)
    for row, t in zip(got, all_texts):
        raw, low = t.encode(), t.encode().lower()
        over = lambda a, b: a / max(b, 1)
        kinds = [over(sum(b in set(c) for b in raw), len(raw)) for c in quality.CLASSES.values()]
        w, spaced, lines = letter_words(t), re.findall(rb"[^ \t-\r]+", low), re.findall(rb"[^\n]+", low)
        pairs = list(zip(w, w[1:]))
        want = [*kinds, over(len(raw), len(raw)) - sum(kinds) if raw else 0, math.log1p(len(raw)), math.log1p(len(spaced)), math.log1p(len(lines)),
                over(len(raw), len(spaced)), over(len(spaced), len(lines)), over(len(set(w)), len(w)), over(len(set(pairs)), len(pairs)),
                over(len(set(lines)), len(lines)), over(max(Counter(lines).values(), default=0), len(lines))]
        assert np.allclose(row, want, atol=1e-9), t
    assert len(quality.STATISTICS) == got.shape[1]


def plain_trees(x, y, s):
    """Boosting by loops over rows, statistics and cuts; a node without a split sends all rows left."""
    share = (sum(y) + 0.5) / (len(y) + 1)
    bias = math.log(share / (1 - share))
    cuts = [sorted(set(np.quantile(x[:, f], np.linspace(0, 1, quality.BINS + 1)[1:-1]).tolist())) for f in range(x.shape[1])]
    total = [bias] * len(y)

    def grow(rows, depth, g, h):
        if depth == 0:
            value = -s.rate * sum(g[i] for i in rows) / (sum(h[i] for i in rows) + s.l2)
            for i in rows:
                total[i] += value
            return
        G, H, best, split = sum(g[i] for i in rows), sum(h[i] for i in rows), s.least_gain, None
        for f in range(x.shape[1]):
            for cut in cuts[f]:
                left = [i for i in rows if x[i, f] <= cut]
                gl, hl = sum(g[i] for i in left), sum(h[i] for i in left)
                if hl < s.least_hessian or H - hl < s.least_hessian:
                    continue
                gain = gl * gl / (hl + s.l2) + (G - gl) ** 2 / (H - hl + s.l2) - G * G / (H + s.l2)
                if gain > best + 1e-12:
                    best, split = gain, (f, cut)
        if split is None:
            grow(rows, depth - 1, g, h)
            return
        f, cut = split
        grow([i for i in rows if x[i, f] <= cut], depth - 1, g, h)
        grow([i for i in rows if x[i, f] > cut], depth - 1, g, h)
    for _ in range(s.trees):
        p = [1 / (1 + math.exp(-v)) for v in total]
        grow(list(range(len(y))), s.depth, [a - b for a, b in zip(p, y)], [a * (1 - a) for a in p])
    return [1 / (1 + math.exp(-v)) for v in total]


@pytest.mark.parametrize("seed", [1, 2])
def test_trees_equal_plain_boosting(seed):
    r = np.random.default_rng(seed)
    x = np.column_stack([r.normal(size=80), r.integers(0, 4, 80), r.random(80)]).astype(float)
    y = ((x[:, 0] > 0.2) ^ (x[:, 1] > 1)).astype(float)
    s = quality.Settings(trees=4, depth=2)
    assert np.allclose(quality.fit(x, y, s).score(x), plain_trees(x, y.tolist(), s), atol=1e-9)
