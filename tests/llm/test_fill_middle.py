"""Fill-in-middle against slicing of Python strings."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom.llm import fill_middle
from tests.llm.helpers import CASES, docs


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(doc_id, text):
    """(n, form, prefix_chars, middle_chars, output) of one document."""
    text = text or ""
    digest = sha(f"1:{'' if doc_id is None else doc_id}")
    h1, h2, h3, h4 = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
    n = len(text)
    if not text or h3 % 100 >= 90 or any(m in text for m in ("<P>", "<S>", "<M>")):
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return n, "spm", a, b - a, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", a, b - a, f"<P>{prefix}<S>{suffix}<M>{middle}"


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abé日\U0001f600 \n", max_size=80), st.integers(1, 9), st.integers(0, 80))
def test_cut_equals_a_scan(text, block, k):
    data = text.encode()
    points = (np.frombuffer(data, np.uint8) & 0xC0) != 0x80
    counts = fill_middle.BlockCounts(points, points, block)
    k = min(k, len(text))
    assert counts.totals() == (len(text), len(text))
    assert counts.cut(k) == (len(text[:k].encode()), k)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abé日 \n", max_size=80), st.integers(1, 9))
def test_units_of_a_pattern(text, block):
    unit = re.compile(r"\S+", re.DOTALL)
    data = text.encode()
    points = (np.frombuffer(data, np.uint8) & 0xC0) != 0x80
    counts = fill_middle.BlockCounts(fill_middle.starts_of(data, points, unit), points, block)
    starts = [m.start() for m in unit.finditer(text)]
    assert counts.totals() == (len(starts), len(text))
    for k in range(len(starts) + 1):
        at = 0 if k == 0 else starts[k] if k < len(starts) else len(text)
        assert counts.cut(k) == (len(text[:at].encode()), at)


MORE = [(k, "<" * (k % 3) + f"P>é<S {k}\n日本" * k, "en", "a", 1) for k in range(100, 180)]
MORE += [(200, "a <M> b", "en", "a", 1), (201, "<P>", "en", "a", 1), (202, "é" * 50_000, "en", "a", 1)]


def test_cases_and_round_trip(spark):
    rows = [*CASES, *MORE]
    made = fill_middle.fill_in_middle(docs(spark, rows).repartition(3))
    back = fill_middle.restored(F.col("output"), F.col("form"))
    found = [tuple(r) for r in made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output", back).collect()]
    wanted = [(d, *expected(d, t), t or "") for d, t, *_ in rows]
    assert sorted(map(repr, found)) == sorted(map(repr, wanted))
    assert {r[2] for r in found} == {"plain", "psm", "spm"}


def test_words_as_units(spark):
    rows = [(k, "one two  three\nfour", "en", "a", 1) for k in range(40)]
    made = fill_middle.fill_in_middle(docs(spark, rows), unit=r"\S+").where("form = 'psm'").collect()
    assert {r.n for r in made} == {4} and {r.prefix_chars for r in made} <= {0, 4, 9, 15, 19}
    assert {r.prefix_chars + r.middle_chars for r in made} <= {0, 4, 9, 15, 19}


def test_shares_and_empty_table(spark):
    rows = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("some words").alias("text"))
    counts = {r.form: r["count"] for r in fill_middle.fill_in_middle(rows).groupBy("form").count().collect()}
    assert abs(counts["plain"] - 2000) < 200 and abs(counts["spm"] - 3600) < 300
    assert fill_middle.fill_in_middle(docs(spark).limit(0)).count() == 0
    none = fill_middle.fill_in_middle(rows.limit(50), plain_percent=0, suffix_first_percent=100)
    assert {r.form for r in none.collect()} == {"spm"}


def test_overlapping_marks_are_refused():
    with pytest.raises(ValueError):
        fill_middle.check_marks(("<P>", "<S>", ">M<"))
    with pytest.raises(ValueError):
        fill_middle.check_marks(("<P>", "<P>", "<M>"))
    fill_middle.check_marks(fill_middle.MARKS)
