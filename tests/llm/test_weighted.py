"""Fingerprints by consistent weighted sampling: edited texts by hand, collision rates against exact similarity."""

import hashlib
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import prose
from tarnflow.llm import weighted


def similarity(a, b):
    a, b = (Counter(w for w in re.split("[ \t-\r]+", s.lower()) if w) for s in (a, b))
    return sum((a & b).values()) / max(1, sum((a | b).values()))


@pytest.fixture(scope="module")
def table(spark):
    rows = [(k, prose(k, 120)) for k in range(60)]
    rows += [(100, None), (101, ""), (102, " \n"), (103, "One two"), (104, "one  TWO"), (105, "x" * 5000), (106, prose(1, 4000)), (106, "same id"), (None, "no id"), (None, None)]
    rows += [(107, "thrice")] * 3 + [(108, "ÄÖ été 😀 ñ x 中文"), (109, "thrice")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    return rows, df.withColumns({n: F.lit(1) for n in ("_key", "_text", "_a", "_at", "n_chars", "fingerprint", "_word")})


@pytest.fixture(scope="module")
def got(table):
    return weighted.edited(table[1]).collect()


def test_edited_texts_and_every_row(table, got):
    rows, df = table
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in got) == sorted((k is None, k or 0) for k, _ in rows)
    plain = sorted({(k, t or "") for k, t in rows if k is not None and k < 100}, reverse=True)
    by = {r["doc_id"]: r for r in got}
    for (k, text), (_, after) in zip(plain, plain[1:]):
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        assert by[k]["n_chars"] == len(text) and by[k]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        # Six standard deviations of a mean of 64 samples.
        assert abs(by[k]["near_edited"] - similarity(text, edited)) < 0.38 and abs(by[k]["near_next"] - similarity(text, after)) < 0.38
    errors = [by[k]["near_next"] - similarity(t, a) for (k, t), (_, a) in zip(plain, plain[1:])]
    assert abs(sum(errors) / len(errors)) < 0.04
    half = by[108]["n_chars"] // 2
    text = "ÄÖ été 😀 ñ x 中文"
    assert by[108]["n_chars"] == len(text) == 15 and by[108]["edited_sha256"] == hashlib.sha256((text[:15 - half] + "thrice"[:half]).encode()).hexdigest()


def test_equal_texts_have_equal_fingerprints(table, got):
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r)
    assert len(by[107]) == 3 and len({r["fingerprint"] for r in by[107] + by[109]}) == 1
    assert by[103][0]["fingerprint"] == by[104][0]["fingerprint"] != by[105][0]["fingerprint"]
    assert {by[k][0]["fingerprint"] for k in (100, 101, 102)} == {"0" * 256} and {len(r["fingerprint"]) for r in got} == {256}
    assert by[101][0]["near_next"] == 1.0
    alone = {(r["doc_id"], r["fingerprint"]) for r in weighted.fingerprints(table[1]).collect()}
    assert alone == {(r["doc_id"], r["fingerprint"]) for r in got}


def test_counts_weigh(spark):
    texts = ["a " * 30 + "b " * 10, "a " * 10 + "b " * 30]
    r = weighted.edited(spark.createDataFrame([(1, texts[0]), (0, texts[1])], "doc_id bigint, text string")).where("doc_id = 1").first()
    assert similarity(*texts) == pytest.approx(1 / 3) and abs(r["near_next"] - 1 / 3) < 0.36 and r["near_next"] < 1


def test_lone_and_empty(spark, table):
    row = weighted.edited(spark.createDataFrame([(5, "abcdef gh")], "doc_id bigint, text string")).first()
    assert row["edited_sha256"] == hashlib.sha256(b"abcdeabcd").hexdigest() and row["near_next"] == 1.0
    assert weighted.edited(table[1].limit(0)).count() == 0
