"""Periodic runs against their definition."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom.llm import periodic
from tests.llm.helpers import CASES, docs


def plain_runs(words):
    """(start, length, period) of all runs, by comparing all words a period apart."""
    n, found = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if length >= max(6, 4 * q):
                shorter = any(all(words[x] == words[x + r] for x in range(i, i + length - r)) for r in range(1, q))
                if not shorter:
                    found.append((i, length, q))
            i = j + 1
    return sorted(found, key=lambda run: (run[0], run[2]))


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def planted(doc_id, text):
    words, h = words_of(text), zlib.crc32(str("" if doc_id is None else doc_id).encode())
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def collapsed(words, runs):
    drop = {i for s, length, q in runs for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in drop)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def digest(doc_id, text):
    words = planted(doc_id, text)
    runs = plain_runs(words)
    best = min(runs, key=lambda r: (-(r[1] * 10**9 // r[2]), r[0], r[2])) if runs else (None, None, None)
    milli = 1000 * best[1] // best[2] if runs else None
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return doc_id, len(runs), *best, milli, sha(listed), sha(collapsed(words, runs))


PERIODIC = st.builds(
    lambda head, root, times, tail: head + (root * times)[: len(root) * times - len(tail) % 3] + tail,
    st.lists(st.integers(0, 3), max_size=10),
    st.lists(st.integers(0, 3), min_size=1, max_size=6),
    st.integers(1, 8),
    st.lists(st.integers(0, 3), max_size=10),
)


@settings(max_examples=400, deadline=None)
@given(st.one_of(PERIODIC, st.lists(st.integers(0, 2), max_size=40)))
def test_runs_of_a_list(values):
    assert periodic.runs_of(values) == plain_runs(values)


@settings(max_examples=200, deadline=None)
@given(st.lists(PERIODIC, min_size=1, max_size=4))
def test_zones_hold_all_runs(lists):
    bounds = np.cumsum([0, *map(len, lists)])
    codes = np.array([x for own in lists for x in own], np.int64)
    assert periodic.text_runs(codes, bounds) == [plain_runs(own) for own in lists]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(PERIODIC, st.lists(st.integers(0, 2), max_size=40)), min_size=3, max_size=12))
def test_windows_join(lists):
    values = [x for own in lists for x in own]
    found = periodic.zone_runs(np.array(values, np.int64), 4, window=64)
    wanted = plain_runs(values)
    assert sorted(r for r in found if r[2] <= 4) == sorted(r for r in wanted if r[2] <= 4)
    assert set(found) <= set(wanted)


def test_common_extensions():
    rng = random.Random(5)
    values = [rng.randrange(3) for _ in range(200)]
    extensions = periodic.Extensions(values)
    pairs = [(i, j) for i in range(0, 200, 7) for j in range(1, 200, 5) if i != j]
    found = extensions.common(*(np.array(x) for x in zip(*pairs)))
    for (i, j), shared in zip(pairs, found.tolist()):
        k = 0
        while max(i, j) + k < 200 and values[i + k] == values[j + k]:
            k += 1
        assert shared == k
    assert sorted(range(201), key=extensions.ranks.__getitem__) == sorted(range(201), key=lambda i: values[i:])


MORE = [
    (20, "a b a b a b a b", "en", "a", 1),
    (21, "A a A a\tA a\nA a", "en", "a", 1),
    (22, "x x x x x", "en", "a", 1),
    (23, "x x x x x x", "en", "a", 1),
    (24, "a b c " * 4 + "d e a b c a b c", "en", "a", 1),
    (25, " ".join(str(i % 700) for i in range(20_000)), "en", "a", 1),
    (26, "p p p p p p q " * 40, "en", "a", 1),
    (27, "é\x00 日 " * 9, "en", "a", 1),
]


def test_cases(spark):
    rows = [*CASES, *MORE, *((100 + k, "some text of nine words that is repeated here " * (k % 5 + 1), "en", "a", 1) for k in range(60))]
    made = periodic.periodic_runs(docs(spark, rows).repartition(3))
    for r in made.collect():
        texts = [words_of(t) for d, t, *_ in rows if d == r.doc_id]
        runs = [tuple(run) for run in r.runs]
        if r.doc_id == 25:
            assert runs == [(0, 20_000, 700)] and len(r.collapsed.split()) == 700
        else:
            assert (r.n_words, runs, r.collapsed) in [(len(w), plain_runs(w), collapsed(w, plain_runs(w))) for w in texts]
    rows = [r for r in rows if r[0] != 25]
    table = docs(spark, rows)
    text = periodic.with_planted_runs(F.col("doc_id"), F.col("text"))
    found = periodic.digests(periodic.periodic_runs(table.select("doc_id", text.alias("text"))))
    assert found.columns[:2] == ["doc_id", "n_runs"] and found.count() == len(rows)
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(repr(digest(d, t)) for d, t, *_ in rows)


def test_ties_take_the_smallest_start(spark):
    words = "a b a b a b a b x c c c c c c y d d d d d d"
    row = periodic.digests(periodic.periodic_runs(docs(spark, [(1, words, "en", "a", 1)]))).first()
    assert (row.n_runs, row.start, row.length, row.period, row.exponent_milli) == (3, 9, 6, 1, 6000)


def test_empty_table(spark):
    none = docs(spark).limit(0)
    assert periodic.digests(periodic.periodic_runs(none)).count() == 0


def test_registered(spark, sample):
    from ledgerloom.llm.queries import QUERIES

    found = {r.doc_id: tuple(r) for r in QUERIES["op12_periodic_runs"](spark, sample).collect()}
    short = {r.doc_id: r.text for r in spark.read.parquet(f"{sample}/documents.parquet").collect() if len(r.text or "") < 6000}
    assert len(short) > 100 and any(found[d][1] for d in short)
    for doc_id, text in short.items():
        assert found[doc_id] == digest(doc_id, text)
