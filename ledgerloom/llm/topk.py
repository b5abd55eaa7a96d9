"""Exact top-k search by inner product with MaxScore.

A vector's positions are terms, its integers their weights. A task scores a block of queries against a shard of rows.
A query's terms are ordered by the most they can add to a score in the shard. The terms at the end that together cannot
reach the query's k-th best score so far are non-essential: rows are collected from the postings of the essential terms
only, and the others are probed one by one for rows that can still compete. The k-th best score rises from chunk to chunk
of the shard. The best k of every shard are merged.

Rows whose vector is null or holds a null take no part, nor do rows without id; rows that repeat an id count as one row, the least
vector of them. A position beyond a vector's end has weight 0. A row is no result of the query with its own id. Ties go to the smaller id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import prepared
from ledgerloom.session import materialise

# Rows of a shard and of a query block on average: they bound what a task holds.
SHARD_ROWS = 8192
QUERY_ROWS = 4096
CHUNK_ROWS = 2048
TOGETHER = 128

RESULT = "query_id long, vec_id long, score long"


def flat_weights(column: pa.ChunkedArray) -> np.ndarray:
    """Rows of integers as one matrix, short rows filled with 0."""
    lists = column.combine_chunks()
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    made = np.zeros((len(sizes), int(sizes.max(initial=0))), np.int64)
    made[np.arange(made.shape[1])[None, :] < sizes[:, None]] = lists.flatten().to_numpy()
    return made


class Shard:
    """The rows of one shard: postings[t] are the weights of term t by row, in ascending id order."""

    def __init__(self, ids: np.ndarray, weights: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids = ids[order]
        self.postings = np.ascontiguousarray(weights[order].T)
        self.most = np.maximum(self.postings.max(axis=1, initial=0), 0)
        self.least = np.minimum(self.postings.min(axis=1, initial=0), 0)

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query the rows and scores of its best k, best first."""
        n, terms = len(self.ids), len(self.postings)
        queries = queries[:, :terms]
        bounds = np.where(queries > 0, queries * self.most, queries * self.least)
        order = np.argsort(-bounds, axis=1, kind="stable")
        ordered = np.take_along_axis(bounds, order, axis=1)
        # left[q, j]: the most that the terms from place j on can add
        left = np.concatenate([np.cumsum(ordered[:, ::-1], axis=1)[:, ::-1], np.zeros((len(queries), 1), np.int64)], axis=1)
        exact = np.abs(queries).max(initial=0) * max(self.most.max(initial=0), -self.least.min(initial=0)) * max(terms, 1)
        kind = np.float64 if exact < 1 << 53 else np.int64  # sums below 2^53 are exact in double precision
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in queries]
        floor = np.full(len(queries), np.iinfo(np.int64).min)
        for at in range(0, n, CHUNK_ROWS):
            part = self.postings[:, at : at + CHUNK_ROWS]
            essential = (left[:, :terms] >= floor[:, None]).sum(axis=1)
            chosen = np.zeros(queries.shape, bool)
            np.put_along_axis(chosen, order, np.arange(terms)[None, :] < essential[:, None], axis=1)
            score = (np.where(chosen, queries, 0).astype(kind) @ part.astype(kind)).astype(np.int64)
            # Where terms are left out, their sum is below the floor: 0 plus that sum never competes.
            alive = score + left[np.arange(len(queries)), essential][:, None] >= floor[:, None]
            alive &= self.ids[at : at + CHUNK_ROWS][None, :] != query_ids[:, None]
            q, row = np.nonzero(alive)
            score, place = score[q, row], essential[q]
            while len(q) and (open_ := place < terms).any():
                term = order[q, np.minimum(place, terms - 1)]
                score = score + np.where(open_, queries[q, term] * part[term, row], 0)
                place = place + open_
                stay = score + left[q, place] >= floor[q]
                q, row, score, place = q[stay], row[stay], score[stay], place[stay]
            cuts = np.searchsorted(q, np.arange(len(queries) + 1))
            for i in np.flatnonzero(np.diff(cuts)).tolist():
                rows = np.concatenate([best[i][0], row[cuts[i] : cuts[i + 1]] + at])
                scores = np.concatenate([best[i][1], score[cuts[i] : cuts[i + 1]]])
                top = np.lexsort((rows, -scores))[:k]
                best[i] = rows[top], scores[top]
                if len(top) == k:
                    floor[i] = scores[top[-1]]
        return best


def top_k(vectors: DataFrame, is_query: Column, k: int) -> DataFrame:
    """The best k rows of ``vectors`` (vec_id, weights array<bigint>) for each row that ``is_query`` holds for.

    Returns (query_id, rank, vec_id, score). Every shard meets every block of queries: a row is sent once for each block of queries.
    """
    prepared(vectors.sparkSession)
    sound = vectors.where("vec_id IS NOT NULL AND weights IS NOT NULL AND NOT exists(weights, x -> x IS NULL)")
    rows = materialise(sound.groupBy("vec_id").agg(F.min("weights").alias("weights")), "vectors")
    shards = rows.count() // SHARD_ROWS + 1
    blocks = rows.where(is_query).count() // QUERY_ROWS + 1
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    part = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
    asked = rows.where(is_query).select(
        part(blocks).alias("block"), every(shards).alias("shard"), F.lit(True).alias("asks"), "vec_id", "weights"
    )
    held = rows.select(
        every(blocks).alias("block"), part(shards).alias("shard"), F.lit(False).alias("asks"), "vec_id", "weights"
    )

    def search(found: pa.Table) -> pa.Table:
        asks = found.column("asks").to_numpy()
        ids, weights = found.column("vec_id").to_numpy(), flat_weights(found.column("weights"))
        shard, queries, query_ids = Shard(ids[~asks], weights[~asks]), weights[asks], ids[asks]
        out = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for at in range(0, len(queries), TOGETHER):
            some = query_ids[at : at + TOGETHER]
            for query, (best, scores) in zip(some, shard.search(some, queries[at : at + TOGETHER], k)):
                out[0].append(np.full(len(best), query))
                out[1].append(shard.ids[best])
                out[2].append(scores)
        return pa.table([np.concatenate(o) for o in out], names=["query_id", "vec_id", "score"])

    found = asked.unionByName(held).groupBy("block", "shard").applyInArrow(search, RESULT)
    best_first = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best_first).cast("int")).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
