"""Operator 6 against a plain search over a whole table: what is found, and that nothing else changes."""

import datetime as dt
import os
import re

import pytest

from locastar.llm import pii

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")


def luhn(digits):
    return sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(digits))) % 10 == 0


def valid_date(y, m, d):
    try:
        return bool(dt.date(int(y), int(m), int(d)))
    except ValueError:
        return False


def plain(text):
    """(kind, value) of addresses, dates, ip addresses, SSN and grouped or solid cards."""
    found = []
    for m in re.finditer(r"[^\s@,;:<>()\"'|]+@[\w.-]+\.[a-zA-Z]{2,}", text):
        found.append(("email", m[0].rstrip(".")))
    for m in re.finditer(r"(?<![\d./-])(\d{4})-(\d\d)-(\d\d)(?![./-]?\d)", text):
        found += [("date", m[0])] * valid_date(*m.groups())
    for m in re.finditer(r"(?<![\d./-])(\d{1,2})([/.])(\d{1,2})\2(\d{4})(?![./-]?\d)", text):
        found += [("date", m[0])] * (valid_date(m[4], m[3], m[1]) or (m[2] == "/" and valid_date(m[4], m[1], m[3])))
    for m in re.finditer(r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\.?\d)", text):
        found += [("ip", m[0])] * all(int(o) < 256 and str(int(o)) == o for o in m[0].split("."))
    for m in re.finditer(r"(?<![\w-])(\d{3})-(\d\d)-(\d{4})(?![\w-])", text):
        found += [("ssn", m[0])] * (m[1] not in ("000", "666") and m[1] < "900" and m[2] != "00" and m[3] != "0000")
    for m in re.finditer(r"(?<![\w.+-])(?<!\d )\d{4}([ -]?)\d{4}\1\d{4}\1\d{4}(?![ -]?\d)(?!\w)", text):
        found += [("card", m[0])] * luhn(re.sub(r"\D", "", m[0]))
    return sorted(found)


def test_values_of_a_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    done = {r.doc_id: r for r in pii.pseudonymise(docs, "k").collect()}
    kinds, total = {"email", "date", "ip", "ssn", "card"}, 0
    for i, text in docs.collect():
        got = sorted((v.kind, v.value) for v in done[i].pii if v.kind in kinds)
        assert got == plain(text), i
        total += len(got)
        # the rest of the text stays: put the values back one by one
        new, at, back = done[i].text, 0, []
        for v in done[i].pii:
            k = new.index(v.pseudonym, at)
            back += [new[at:k], v.value]
            at = k + len(v.pseudonym)
        assert "".join([*back, new[at:]]) == text, i
    assert total > 10
