"""The n-gram join, its signatures and the components against brute force."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from ledgerloom.llm import ngram_join, shingles
from ledgerloom.llm.graph import components
from tests.llm import brute
from tests.llm.helpers import CASES, docs


def reach(x, y, percent):
    """Whether two (parities, size) can be similar."""
    return shingles.can_reach([[x[0]], [y[0]]], [np.array([x[1]]), np.array([y[1]])], percent)[0]


def rows_of(df):
    return Counter((r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in df.collect())


def planted(seed=1):
    """Texts with exact copies, near copies around the threshold, shared passages, and very short texts."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("abcdefgh", k=rng.randint(1, 6))) for _ in range(2000)]
    passage = rng.choices(vocabulary, k=60)
    rows = []
    for group in range(12):
        base = rng.choices(vocabulary, k=rng.choice([2, 3, 5, 11, 12, 20, 45, 130, 400]))
        if group % 3 == 0:
            base = base + passage
        rows.append(base)
        for _ in range(rng.randint(0, 12)):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 40))):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append(copy)
    rng.shuffle(rows)
    texts = [" ".join(r).upper() if k % 5 == 0 else "  ".join(r) for k, r in enumerate(rows)]
    return [(k * 3 % 1009, t) for k, t in enumerate(texts)]


def test_cases(spark):
    rows = [(d, t) for d, t, *_ in CASES]
    assert rows_of(ngram_join.ngram_join(docs(spark))) == brute.ngram_join(rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_planted(spark, seed):
    rows = planted(seed)
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert rows_of(ngram_join.ngram_join(table)) == brute.ngram_join(rows)


def test_large_clusters_are_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_SETS", 4)
    monkeypatch.setattr(ngram_join, "BLOCK_GRAMS", 400)
    monkeypatch.setattr(ngram_join, "RARE", 3)
    monkeypatch.setattr(ngram_join, "COLUMNS", 50)
    rows = planted(3)
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert rows_of(ngram_join.ngram_join(table)) == brute.ngram_join(rows)


def test_other_thresholds(spark):
    rows = planted(4)[:60]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(ngram_join.ngram_join(table, width=5, percent=80)) == brute.ngram_join(rows, 80, 5)


def test_registered(spark, sample):
    from ledgerloom.llm.queries import QUERIES

    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sample}/documents.parquet").collect()]
    assert rows_of(QUERIES["op1_ngram_join"](spark, sample)) == brute.ngram_join(rows)


def test_empty(spark):
    assert ngram_join.ngram_join(docs(spark).limit(0)).count() == 0


def test_rows_with_one_id_and_two_texts(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(1, text), (1, "something else altogether here"), (2, "something else altogether here"), (3, text)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(ngram_join.ngram_join(table)) == brute.ngram_join(rows)


@pytest.mark.parametrize("percent", [90, 80, 50])
def test_similar_sets_share_a_signature(percent):
    rng = np.random.default_rng(percent)
    with np.errstate(over="ignore"):
        for _ in range(400):
            n = int(rng.integers(1, 300))
            base = rng.integers(0, 1 << 63, n, dtype=np.uint64)
            x, y = np.unique(base), np.unique(np.concatenate([base[int(rng.integers(0, 1 + n // 8)) :], rng.integers(0, 1 << 63, int(rng.integers(0, 1 + n // 12)), dtype=np.uint64)]))
            common = len(np.intersect1d(x, y))
            if len(x) and len(y) and 100 * common >= percent * (len(x) + len(y) - common) and not np.array_equal(x, y):
                assert len(np.intersect1d(shingles.signatures(x, percent), shingles.signatures(y, percent)))


def test_sets_of_twice_the_size_share_a_signature():
    rng = np.random.default_rng(1)
    with np.errstate(over="ignore"):
        for n in range(2, 300):
            y = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
            for percent in (50, 80, 90):
                x = np.sort(rng.permutation(y)[: max(1, math.ceil(n * percent / 100))])
                if len(x) < len(y):
                    assert len(np.intersect1d(shingles.signatures(x, percent), shingles.signatures(y, percent)))


def test_signatures_follow_the_members_that_may_differ():
    """A set signs for the partners it can have, not for the largest of its band."""
    rng = np.random.default_rng(2)
    sizes = [int(x) for x in np.geomspace(100, 1600, 60)]
    with np.errstate(over="ignore"):
        signed = [len(shingles.signatures(np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64)), 80)) / n for n in sizes]
    assert sum(signed) / len(signed) < 0.36 and max(signed) < 0.52


def test_word_hashes_follow_the_words():
    texts = ["  A b\tc\x0bd\n", "", "a B C D", "x\x00y é É \x1c", "   ", "a\x85b"]
    hashes, bounds = shingles.word_hashes(pa.array(texts).slice(0))
    own = [hashes[a:b].tolist() for a, b in zip(bounds, bounds[1:])]
    assert [len(o) for o in own] == [len(brute.words(t)) for t in texts]
    assert own[0] == own[2] and len({h for o in own for h in o}) == len({w for t in texts for w in brute.words(t)})


def test_components(spark):
    rng = random.Random(5)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(i, i + 1) for i in range(400, 460)]
    table = spark.createDataFrame(links, "a long, b long")
    nodes = {n for a, b in links if a != b for n in (a, b)}
    assert {r.node: r.component for r in components(table).collect()} == brute.connected(nodes, links)
    assert components(table.limit(0)).count() == 0


@pytest.mark.parametrize("paired", [0, 2, 16])
def test_pairs_of_a_signature_are_ruled_out_without_loss(spark, monkeypatch, paired):
    monkeypatch.setattr(ngram_join, "PAIRED", paired)
    rows = planted(5)
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert rows_of(ngram_join.ngram_join(table, width=5, percent=80)) == brute.ngram_join(rows, 80, 5)


def test_parities_rule_out_chance_and_no_similar_pair():
    rng = np.random.default_rng(0)
    draw = lambda n: np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
    for n in (1, 3, 31, 32, 33, 70, 500, 3000):
        for percent in (50, 80, 90):
            base = draw(n)
            for lost in range(0, n, max(1, n // 40)):
                other = np.union1d(base[lost:], draw(rng.integers(0, n // 3 + 1)))
                common, both = len(np.intersect1d(base, other)), len(np.union1d(base, other))
                told = [(shingles.parities(s).tobytes(), len(s)) for s in (base, other)]
                if 100 * common >= percent * both:
                    assert reach(*told, percent)
        told = [(shingles.parities(s).tobytes(), len(s)) for s in (draw(n), draw(n))]
        assert n < 31 or not reach(*told, 80)


def test_a_chance_tie_makes_no_cluster(spark):
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 1 << 63, 400, dtype=np.uint64)) for _ in range(2)]
    rows = [(k, 400, [7], shingles.parities(s).tobytes()) for k, s in enumerate(sets)]
    classes = spark.createDataFrame(rows, "cid long, n long, sigs array<long>, bits binary")
    assert ngram_join.candidate_clusters(classes, 80).count() == 0


@pytest.mark.parametrize("seed", range(60))
def test_shared_signatures_are_read_in_one_order(seed):
    """Folded in batches and read in pieces: all pairs where few classes share a signature, one group where many do."""
    rng = random.Random(seed)
    universe = [rng.randrange(-(10**18), 10**18) for _ in range(rng.randrange(1, 60))]
    sets = [{rng.choice(universe) for _ in range(rng.randrange(6))} | ({universe[0]} if rng.random() < 0.4 else set()) for _ in range(90)]
    batch, piece, rows = rng.randrange(1, 60), rng.randrange(1, 30), []
    for at in range(0, len(sets), batch):
        part = [sorted(s) for s in sets[at : at + batch]]
        flat = np.array([x for s in part for x in s], np.int64)
        folded = ngram_join.folded_signatures(np.arange(at, at + len(part)), np.array([len(s) for s in part]), flat)
        rows += zip(*(x.tolist() for x in folded))
    rows.sort()
    columns = [np.array(x, np.int64) for x in zip(*rows)] if rows else [np.zeros(0, np.int64)] * 3
    reader, found = ngram_join.SharedSignatures(), []
    for at in range(0, len(rows), piece):
        found += zip(*(x.tolist() for x in reader.read(*(c[at : at + piece] for c in columns))))
    found += zip(*(x.tolist() for x in reader.read(*(c[:0] for c in columns), True)))
    owners = {x: [k for k, s in enumerate(sets) if x in s] for x in universe}
    few = {(a, b) for own in owners.values() if len(own) <= ngram_join.PAIRED for a in own for b in own if a < b}
    many = [(own[0], k) for own in owners.values() if len(own) > ngram_join.PAIRED for k in own]
    assert {(a, b) for a, b, f in found if f} == few
    nodes = range(len(sets))
    assert brute.connected(nodes, [(a, b) for a, b, f in found if not f]) == brute.connected(nodes, many)
    hot = max(owners.values(), key=len)
    assert sum(1 for k, _, other in rows if k == universe[0] and other < 0) <= max(ngram_join.PAIRED, 1) * -(-len(sets) // batch) or len(hot) <= ngram_join.PAIRED
