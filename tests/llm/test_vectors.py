"""Near-duplicate vectors and top-k search against brute force."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import near_vectors, topk
from tests.llm import brute

SCHEMA = "vec_id long, vector array<double>"


def planted(seed=0, length=20):
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(15):
        base = rng.normal(size=length)
        for _ in range(int(rng.integers(1, 9))):
            rows.append((base + rng.normal(size=length) * rng.choice([0.0, 0.2, 0.32, 0.4])).tolist())
    rows += [None, [], [0.0] * length, [1.0, None] + [0.5] * (length - 2), [float("nan")] * length, [float("inf")] + [1.0] * (length - 1)]
    rows += [[1e200] * length, [1e-200] * length, [0.6, 0.8], [0.8, 0.6]]
    return [(int(k), v) for k, v in zip(rng.permutation(len(rows)), rows)]


def expected(rows, threshold=0.9):
    def sound(k, v):
        return k is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)

    links = []
    for i, (a, x) in enumerate(rows):
        for j, (b, y) in enumerate(rows[:i]):
            if sound(a, x) and sound(b, y) and len(x) == len(y):
                x1, y1 = (np.array(v) / np.abs(v).max() for v in (x, y))
                if x1 @ y1 / np.sqrt((x1 @ x1) * (y1 @ y1)) >= threshold:
                    links.append((i, j))
    counts = Counter(k for link in links for k in link)
    component = brute.connected({k for k, _ in rows if k is not None}, [(rows[i][0], rows[j][0]) for i, j in links])
    return Counter((k, counts[i], component.get(k), component.get(k) == k and k is not None) for i, (k, _) in enumerate(rows))


def found(df):
    return Counter((r.vec_id, r.n_links, r.component_id, r.kept) for r in df.collect())


def test_near_vectors(spark):
    rows = planted() + [(None, [1.0] * 20), (500, [0.3] * 20), (500, [0.3] * 20), (501, [-0.3] * 20)]
    table = spark.createDataFrame(rows, SCHEMA).withColumn("links", F.lit(1)).repartition(4)
    assert found(near_vectors.near_duplicates(table)) == expected(rows)


def test_small_blocks_and_tiles(spark, monkeypatch):
    monkeypatch.setattr(near_vectors, "BLOCK_ROWS", 6)
    monkeypatch.setattr(near_vectors, "TILE_ROWS", 4)
    rows = planted(3, 70)
    table = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert found(near_vectors.near_duplicates(table)) == expected(rows)


def test_cosine_at_the_threshold(spark):
    rows = [(1, [1.0, 0.0]), (2, [3.0, 4.0]), (3, [4.0, 3.0]), (4, [0.0, 1.0])]
    table = spark.createDataFrame(rows, SCHEMA)
    assert found(near_vectors.near_duplicates(table, 0.8)) == expected(rows, 0.8)


def test_near_vectors_empty(spark):
    assert near_vectors.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    nothing = spark.createDataFrame([(1, None), (2, [0.0])], SCHEMA)
    assert found(near_vectors.near_duplicates(nothing)) == Counter({(1, 0, 1, True): 1, (2, 0, 2, True): 1})


def best(rows, is_query, k):
    table = {}
    for i, w in rows:
        if i is not None and w is not None and None not in w:
            table[i] = min(table.get(i, w), w)
    out = set()
    for q, x in table.items():
        if is_query(q):
            scores = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in table.items() if i != q)[:k]
            out |= {(q, r, i, -s) for r, (s, i) in enumerate(scores, 1)}
    return out


@pytest.mark.parametrize("spread, length", [(3, 5), (200, 64)])
def test_top_k(spark, monkeypatch, spread, length):
    monkeypatch.setattr(topk, "SHARD_ROWS", 60)
    monkeypatch.setattr(topk, "QUERY_ROWS", 15)
    monkeypatch.setattr(topk, "CHUNK_ROWS", 16)
    monkeypatch.setattr(topk, "TOGETHER", 4)
    rng = np.random.default_rng(spread)
    rows = [(k, rng.integers(-spread, spread + 1, length).tolist()) for k in range(230)]
    rows += [(300, None), (301, [None] * 5), (302, [1]), (302, [1]), (None, [1] * length), (304, [0] * length), (305, [])]
    table = spark.createDataFrame(rows, "vec_id long, weights array<long>").withColumn("rank", F.lit("x")).repartition(3)
    result = topk.top_k(table, F.col("vec_id") % 5 == 0, 5)
    got = {(r.query_id, r.rank, r.vec_id, r.score) for r in result.collect()}
    assert got == best(rows, lambda q: q % 5 == 0, 5)


def test_top_k_few_rows(spark):
    rows = [(0, [1, 2]), (1, [2, 1])]
    table = spark.createDataFrame(rows, "vec_id long, weights array<long>")
    got = {tuple(r) for r in topk.top_k(table, F.col("vec_id") == 0, 5).collect()}
    assert got == {(0, 1, 1, 4)}
    assert topk.top_k(table.limit(0), F.col("vec_id") == 0, 5).count() == 0


def test_non_essential_terms_are_left_out():
    """A later chunk is scored on the essential terms only, and yet the result is exact."""
    rng = np.random.default_rng(2)
    weights = rng.integers(-20, 21, (5000, 30))
    weights[:, 10:] //= 10
    queries = rng.integers(-20, 21, (3, 30))
    shard = topk.Shard(np.arange(5000), weights)
    for q, (rows, scores) in zip(queries, shard.search(np.full(3, -1), queries, 5)):
        every = weights @ q
        order = np.lexsort((np.arange(5000), -every))[:5]
        assert rows.tolist() == order.tolist() and scores.tolist() == every[order].tolist()
