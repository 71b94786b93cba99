"""Bounds that left data out: addresses, names of secrets, shares of near copies, samples."""

import os
import random

import numpy as np
import pytest

from locastar.llm import near_dup, pii, quality, toxicity

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")


def changed(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r.text for r in pii.pseudonymise(docs, "k").orderBy("doc_id").collect()]


def test_addresses_of_any_length_and_alphabet(spark):
    long_local, long_label = "a" * 90, "b" * 80
    addresses = ["jane@a.b.c.d.e.f.g.h.i.j.com", "müller@example.de", "élodie.noël@exemple.fr", f"{long_local}@example.org",
                 f"jane@{long_label}.com", "ana@" + "x." * 3000 + "com", "иван@пример.рф"]
    got = changed(spark, [f"Write to {a}, please." for a in addresses])
    for a, text in zip(addresses, got):
        new = text.removeprefix("Write to ").removesuffix(", please.")
        local, rest = new.split("@")
        assert a not in text and len(new) == len(a)
        assert local != a.split("@")[0] and [c.isascii() for c in local] == [c.isascii() for c in a.split("@")[0]]
    twice = changed(spark, ["müller@example.de", "x müller@example.de y"])
    assert twice[1] == f"x {twice[0]} y" and not twice[0].startswith("mü")


@pytest.mark.parametrize("text,kept", [
    ("password: hunter2hunter2", "password: "), ("Password=SecretValue", "Password="), ("api-key=abcdefgh12", "api-key="),
    ('"api_key": "abc123def456"', '"api_key": "'), ("TOKEN=abcdefghij", "TOKEN="), ('token = "abcdefghij"', 'token = "'),
    ("secret = abc12345", "secret = ")])
def test_spellings_of_secrets(spark, text, kept):
    new, = changed(spark, [text])
    assert new.startswith(kept) and new != text and len(new) == len(text)


@pytest.mark.parametrize("text", ["The secret: neverending prose", "password: forgotten", "token = something else", "secretary = assistant",
                                  "a@b", "me@home", "x @ example.com", "no secret, no token"])
def test_clean_words_stay(spark, text):
    assert changed(spark, [text]) == [text]


def test_matches_follow_the_share():
    assert [near_dup.matches_for(p) for p in (100, 80, 60)] == [64, 34, 19]
    with pytest.raises(ValueError):
        near_dup.matches_for(10)


@pytest.mark.parametrize("percent", [60, 70, 80])
def test_no_link_is_lost_at_other_shares(spark, percent):
    """Pairs at and just above the share are linked, pairs below are not."""
    r, rows, pairs = random.Random(percent), [], []
    for k in range(120):
        n = r.randint(60, 200)
        both = [f"w{k}x{i}" for i in range(n)]
        # single words as shingles: n shared, the rest differs
        extra = int(n * 100 / percent) - n + (k % 3 == 0) * 2
        rows += [(2 * k, " ".join(both + [f"a{k}y{i}" for i in range(extra)])), (2 * k + 1, " ".join(both))]
        pairs.append(100 * n >= percent * (n + extra))
    got = {x.doc_id: x.component_id for x in near_dup.near_duplicates(
        spark.createDataFrame(rows, "doc_id long, text string"), words=1, percent=percent).collect()}
    assert [got[2 * k + 1] == 2 * k for k in range(120)] == pairs and any(pairs) and not all(pairs)


def test_samples_are_bounded_by_documents(spark):
    """An id that repeats is one example; a long text gives a bounded number of coordinates."""
    docs = spark.range(3000).selectExpr("id % 10 as doc_id", "concat('text ', id % 10, ' ', id) as text")
    labels = spark.range(10).selectExpr("id as doc_id", "int(id % 2) as toxic", "int(id % 2) as quality")
    for fold, held in ((3, 1), (5, 0)):
        got = toxicity.sample(docs, labels, "toxic", fold, held, 10).collect()
        assert len(got) <= 10 and len({x.doc_id for x in got}) == len(got)
    some = np.arange(100_000)
    drawn = toxicity.drawn_from(some, -5)
    assert len(set(drawn.tolist())) == toxicity.EXAMPLE_GRAMS and (drawn == toxicity.drawn_from(some, -5)).all()
    assert (toxicity.drawn_from(some[:9], 1) == some[:9]).all()
    quality.train(docs, labels)
