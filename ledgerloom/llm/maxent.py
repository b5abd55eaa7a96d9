"""Language-model scores by a hashed maximum-entropy model with a class-factored softmax.

The probability of a token is that of its class in its context, times that of the token in its class. The most frequent tokens
are classes of their own; the others are dealt to classes by a hash. The class is predicted by a log-linear model over hashed features
of the context: the token before, the token before that (a skip feature), and both together (an n-gram feature).

A hashed class is cut into parts by more bits of the hash. A second softmax predicts the part within its class, from one hashed feature
for each pair of the token before and a part; a token's share of its part is its smoothed count. How many parts and how many buckets
of the token before there are follows from the counted vocabulary: their product grows with its square root.

Features are functions of a bounded number of context cells, so the corpus is folded once to counts by cell and class. The
weights are learned by gradient steps over these counts: tasks compute the gradient of their cells, the sums are
gathered, and each step is scaled by the curvature. Those of the parts depend on one bucket alone, so tasks learn them bucket by bucket.
A text is scored in batches: one row of class probabilities for each distinct cell,
looked up for all tokens at once. Probabilities of all tokens and an unknown one sum to at most 1 in every context.

Tokens are words with A-Z in lower case, cut at ASCII white space, and one end for each text; they are handled as 64-bit hashes.
Null text is the empty text (its only token is the end). Every row is a text of its own, also rows that repeat a doc_id or
have none. Without training texts every count is 0. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import BATCH_ROWS, prepared, slices, texts
from ledgerloom.llm.shingles import MIX, mixed, word_hashes
from ledgerloom.session import materialise

# Classes: the most frequent tokens, and a power of two of hashed ones.
TOP = 96
HASHED = 32
# Buckets of the token before and of the one before that (the most frequent tokens first), and of both together.
NEAR, NEAR_TOP = 256, 96
SKIP, SKIP_TOP = 64, 48
JOINT = 2048
STEPS = 12
PRIOR = 0.5
GRADIENT_TASKS = 8
# Tokens that make up more than one in so many are looked up in a broadcast table; there can be no more than that.
FREQUENT = 1 << 19
END = int(mixed(np.full(1, 7, np.uint64) * MIX)[0])
START = np.uint64(11)
# Pairs of a bucket of the token before and a part, for each square root of a distinct token.
PAIRS = 1024
# Distinct tokens a task counts before it hands the counts on.
COUNTED = 2_000_000

CELLS = NEAR * SKIP
CLASSES = TOP + HASHED
FEATURES = NEAR + SKIP + JOINT + 1


def tokens_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all texts, each with its end, and the number of tokens before each text (one entry more)."""
    words, bounds = word_hashes(column)
    tokens = np.insert(words, bounds[1:], np.uint64(END))
    return tokens, bounds + np.arange(len(bounds))


def sizes(distinct: int) -> tuple[int, int]:
    """Buckets of the token before, and parts of all hashed classes together, for a vocabulary: powers of two."""
    bits = round(math.log2(PAIRS * math.sqrt(distinct + 1)))
    return max(NEAR, 1 << bits // 2), max(HASHED, 1 << (bits + 1) // 2)


class Layout:
    """Classes and context cells of tokens, given the most frequent ones; parts of classes and the buckets they depend on."""

    def __init__(self, top: list[int], buckets: int = NEAR, parts: int = HASHED):
        self.buckets, self.parts = buckets, parts
        self.top = np.sort(np.array(top, np.uint64))
        rank = np.full(len(top), 0, np.int64)
        rank[np.searchsorted(self.top, np.array(top, np.uint64))] = np.arange(len(top))
        self.rank = rank

    def ranks(self, tokens: np.ndarray) -> np.ndarray:
        """0, 1, 2 and so on for the most frequent tokens, -1 for the others."""
        if not len(self.top):
            return np.full(len(tokens), -1, np.int64)
        at = np.minimum(np.searchsorted(self.top, tokens), len(self.top) - 1)
        return np.where(self.top[at] == tokens, self.rank[at], -1)

    def read(self, tokens: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The class and the context cell of each token; a text begins after two start marks."""
        ranks = self.ranks(tokens)
        classes = np.where(ranks >= 0, ranks, TOP + (tokens & np.uint64(HASHED - 1)).astype(np.int64))
        near = self._bucket(tokens, ranks, NEAR, NEAR_TOP)
        skip = self._bucket(tokens, ranks, SKIP, SKIP_TOP)
        none = np.full(1, START, np.uint64)
        start_near = self._bucket(none, np.array([-1]), NEAR, NEAR_TOP)[0]
        start_skip = self._bucket(none, np.array([-1]), SKIP, SKIP_TOP)[0]
        before, before_that = np.empty_like(near), np.empty_like(skip)
        before[1:], before_that[2:] = near[:-1], skip[:-2]
        first = bounds[:-1]
        before[first] = start_near
        before_that[first] = start_skip
        second = first + 1
        second = second[second < bounds[1:]]
        before_that[second] = start_skip
        return classes, before * SKIP + before_that

    def pairs(self, tokens: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Of each token, the bucket of the one before it, times the number of parts, plus its part."""
        fine = self._bucket(tokens, self.ranks(tokens), self.buckets, NEAR_TOP)
        before = np.empty_like(fine)
        before[1:] = fine[:-1]
        before[bounds[:-1]] = self._bucket(np.full(1, START, np.uint64), np.array([-1]), self.buckets, NEAR_TOP)[0]
        return before * self.parts + (tokens & np.uint64(self.parts - 1)).astype(np.int64)

    @staticmethod
    def _bucket(tokens: np.ndarray, ranks: np.ndarray, buckets: int, own: int) -> np.ndarray:
        hashed = own + ((tokens >> np.uint64(20)) % np.uint64(buckets - own)).astype(np.int64)
        return np.where((ranks >= 0) & (ranks < own), ranks, hashed)


def cell_features(cells: np.ndarray) -> np.ndarray:
    """The features of context cells, one column for each kind."""
    near, skip = cells // SKIP, cells % SKIP
    joint = (mixed(cells.astype(np.uint64) * MIX) % np.uint64(JOINT)).astype(np.int64)
    return np.stack([near, NEAR + skip, NEAR + SKIP + joint, np.full(len(cells), FEATURES - 1)], axis=1)


def class_logs(weights: np.ndarray, cells: np.ndarray) -> np.ndarray:
    """The natural logarithms of the class probabilities in each cell."""
    scores = weights[cell_features(cells)].sum(axis=1)
    scores -= scores.max(axis=1, keepdims=True)
    return scores - np.log(np.exp(scores).sum(axis=1, keepdims=True))


def token_counts(docs: DataFrame) -> DataFrame:
    """(h, c): how often each token occurs in ``docs`` (text)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, waiting = [], 0

        def folded() -> tuple[np.ndarray, np.ndarray]:
            tokens, counts = (np.concatenate(x) for x in zip(*held))
            distinct, place = np.unique(tokens, return_inverse=True)
            return distinct, np.bincount(place, counts, len(distinct)).astype(np.int64)

        def rows(tokens: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
            return pa.record_batch([pa.array(tokens.view(np.int64)), pa.array(counts)], names=["h", "c"])

        for batch in batches:
            column = texts(batch.column(0))
            for begin, stop in slices(column):
                with np.errstate(over="ignore"):
                    tokens, _ = tokens_of(column.slice(begin, stop - begin))
                held.append(np.unique(tokens, return_counts=True))
                waiting += len(held[-1][0])
            if waiting > COUNTED:
                held = [folded()]
                waiting = len(held[0][0])
                if waiting > COUNTED // 2:
                    yield rows(*held.pop())
                    waiting = 0
        if held:
            yield rows(*folded())

    parts = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(count, "h long, c long")
    return parts.groupBy("h").agg(F.sum("c").alias("c"))


def context_counts(docs: DataFrame, top: list[int]) -> DataFrame:
    """(cell, class, n): how often each class follows each context cell in ``docs`` (text)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        layout, total = Layout(top), np.zeros(CELLS * CLASSES, np.int32)
        for batch in batches:
            column = texts(batch.column(0))
            for begin, stop in slices(column):
                with np.errstate(over="ignore"):
                    classes, cells = layout.read(*tokens_of(column.slice(begin, stop - begin)))
                at, n = np.unique(cells * CLASSES + classes, return_counts=True)
                total[at] += n.astype(np.int32)
        at = np.flatnonzero(total)
        for k in range(0, len(at), 100_000):
            part = at[k : k + 100_000]
            yield pa.record_batch(
                [
                    pa.array((part // CLASSES).astype(np.int32)),
                    pa.array((part % CLASSES).astype(np.int32)),
                    pa.array(total[part].astype(np.int64)),
                ],
                names=["cell", "class", "n"],
            )

    parts = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(count, "cell int, class int, n long")
    return parts.groupBy("cell", "class").agg(F.sum("n").alias("n"))


def part_steps(counts: np.ndarray, shares: np.ndarray, steps: int) -> np.ndarray:
    """Natural logarithms of the probabilities of parts in their classes, for one bucket.

    ``counts`` holds how often each part follows, ``shares`` the smoothed counts of its tokens, which are what the softmax gives without
    a weight. Parts of a class are HASHED places apart.
    """
    seen, base = counts.reshape(-1, HASHED).astype(float), np.log(shares.reshape(-1, HASHED))
    weights, total = np.zeros_like(seen), seen.sum(axis=0)

    def logs() -> np.ndarray:
        scores = base + weights
        scores -= scores.max(axis=0)
        return scores - np.log(np.exp(scores).sum(axis=0))

    for _ in range(steps):
        expected = total * np.exp(logs())
        weights += (seen - expected - PRIOR * weights) / (np.maximum(seen, expected) + PRIOR)
    return logs().ravel()


def part_logs(docs: DataFrame, layout: Layout, shares: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """Natural logarithms of the probability of each part in its class, by bucket of the token before, learned from ``docs`` (text).

    Tasks fold their texts to one row for each bucket they meet; a group holds the rows of one bucket.
    """
    kind = "bucket long, sums binary"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(layout.buckets * layout.parts, np.int32)
        for batch in batches:
            column = texts(batch.column(0))
            for begin, stop in slices(column):
                with np.errstate(over="ignore"):
                    tokens, bounds = tokens_of(column.slice(begin, stop - begin))
                at, n = np.unique(layout.pairs(tokens, bounds)[layout.ranks(tokens) < 0], return_counts=True)
                total[at] += n.astype(np.int32)
        rows = total.reshape(layout.buckets, layout.parts)
        used = np.flatnonzero(rows.any(axis=1))
        for k in range(0, len(used), BATCH_ROWS):
            part = used[k : k + BATCH_ROWS]
            yield pa.record_batch([pa.array(part), pa.array([rows[b].tobytes() for b in part])], names=["bucket", "sums"])

    def learn(found: pa.Table) -> pa.Table:
        counts = np.zeros(layout.parts)
        for sums in found.column("sums"):
            counts += np.frombuffer(sums.as_buffer(), np.int32)
        logs = part_steps(counts, shares, steps).astype(np.float32)
        return pa.table({"bucket": found.column("bucket").slice(0, 1), "sums": pa.array([logs.tobytes()], pa.binary())})

    logs = np.tile(part_steps(np.zeros(layout.parts), shares, 0).astype(np.float32), (layout.buckets, 1))
    rows = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(count, kind)
    for row in rows.groupBy("bucket").applyInArrow(learn, kind).collect():  # one row for each bucket
        logs[row.bucket] = np.frombuffer(row.sums, np.float32)
    return logs


def train(contexts: DataFrame, steps: int = STEPS) -> np.ndarray:
    """Weights by feature and class, from (cell, class, n).

    The table has a bounded number of cells. In each step tasks add up the expected counts of their cells; one row for each
    feature comes back, and the difference to the counts seen is the gradient. A step is scaled by a bound of the curvature.
    """
    spark = contexts.sparkSession
    rows = contexts.groupBy("cell").agg(F.collect_list(F.struct("class", "n")).alias("counts"))
    rows = materialise(rows.coalesce(GRADIENT_TASKS), "contexts")
    kinds = cell_features(np.zeros(1, np.int64)).shape[1]
    kind = "feature long, sums binary"

    def by_feature(weights: np.ndarray | None) -> np.ndarray:
        """Counts by feature and class: those seen, or those that the weights lead to expect."""
        shared = spark.sparkContext.broadcast(weights)

        def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = np.zeros((FEATURES, CLASSES))
            for batch in batches:
                cells, lists = batch.column(0).to_numpy().astype(np.int64), batch.column(1)
                index = np.repeat(np.arange(len(cells)), lists.value_lengths().to_numpy(zero_copy_only=False))
                counts = np.zeros((len(cells), CLASSES))
                counts[index, lists.flatten().field("class").to_numpy()] = lists.flatten().field("n").to_numpy()
                if shared.value is not None:
                    counts = counts.sum(axis=1, keepdims=True) * np.exp(class_logs(shared.value, cells))
                for column in cell_features(cells).T:
                    np.add.at(sums, column, counts)
            used = np.flatnonzero(sums.any(axis=1))
            if len(used):
                sums = sums.astype(np.float32)
                yield pa.record_batch([pa.array(used), pa.array([sums[f].tobytes() for f in used])], names=["feature", "sums"])

        def add(found: pa.Table) -> pa.Table:
            feature = found.column("feature").to_numpy()
            sums = np.frombuffer(b"".join(found.column("sums").to_pylist()), np.float32).reshape(len(feature), -1)
            distinct, place = np.unique(feature, return_inverse=True)
            total = np.zeros((len(distinct), CLASSES))
            np.add.at(total, place, sums)
            return pa.table({"feature": distinct, "sums": [t.astype(np.float32).tobytes() for t in total]})

        total = np.zeros((FEATURES, CLASSES))
        parts = rows.mapInArrow(fold, kind).groupBy(F.floor(F.col("feature") / 256))
        for row in parts.applyInArrow(add, kind).collect():  # at most one row for each feature
            total[row.feature] = np.frombuffer(row.sums, np.float32)
        shared.unpersist()
        return total

    seen = by_feature(None)
    weights = np.zeros((FEATURES, CLASSES))
    weights[-1] = np.log((seen[-1] + 1) / (seen[-1] + 1).sum())  # the feature that is always there: class frequencies
    for _ in range(steps):
        expected = by_feature(weights)
        slope = seen - expected - PRIOR * weights
        slope[-1] += PRIOR * weights[-1]
        weights = weights + slope / (kinds * np.maximum(seen, expected) + PRIOR)
    return weights


def score(docs: DataFrame, held_out: Column, steps: int = STEPS) -> DataFrame:
    """Score every row of ``docs`` (doc_id, text) with a model of the rows that are not held out.

    Returns (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score); scores are log10 probabilities.
    """
    spark = prepared(docs.sparkSession)
    source = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), held_out.alias("held_out")
    )
    learned = source.where(~F.col("held_out"))
    counts = materialise(token_counts(learned), "token-counts")
    size = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    top = [r["h"] % (1 << 64) for r in counts.orderBy(F.desc("c"), "h").limit(TOP).collect()]
    buckets, parts = sizes(size["v"])
    hashed = F.col("h").bitwiseAND(F.lit(parts - 1)).cast("int").alias("k")
    classes = counts.where(~F.col("h").isin([_signed(t) for t in top])).groupBy(hashed).agg(
        F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")
    )
    shares = np.ones(parts)  # what a count is divided by in each part; a frequent token fills its class
    for row in classes.collect():  # one row for each part
        shares[row["k"]] = row["n"] + row["v"] + 1
    layout = Layout(top, buckets, parts)
    # log10 of the probability of a part in its class, divided by its smoothed counts
    inner = (part_logs(learned, layout, shares, steps) / np.log(10) - np.log10(shares)).astype(np.float32).ravel()
    weights = train(materialise(context_counts(learned, top), "context-counts"), steps)
    often = (F.col("c") > size["n"] / FREQUENT) | F.col("h").isin([_signed(t) for t in top])
    frequent = counts.where(often).toPandas()  # FREQUENT + TOP rows at most
    order = np.argsort(frequent["h"].to_numpy().astype(np.int64).view(np.uint64))
    known = frequent["h"].to_numpy().astype(np.int64).view(np.uint64)[order], frequent["c"].to_numpy().astype(np.int64)[order]
    shared = spark.sparkContext.broadcast((inner, weights, known))
    base = float(np.log10(size["n"] + size["v"] + 1))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inner, weights, (hashes, numbers) = shared.value
        done = TaskContext.get().partitionId() << 33
        logs = (class_logs(weights, np.arange(CELLS)) / np.log(10)).astype(np.float32)
        for batch in batches:
            column = texts(batch.column(1))
            for begin, stop in slices(column):
                n = stop - begin
                with np.errstate(over="ignore"):
                    tokens, bounds = tokens_of(column.slice(begin, n))
                    classes, cells = layout.read(tokens, bounds)
                    pairs = layout.pairs(tokens, bounds)
                at = np.minimum(np.searchsorted(hashes, tokens), max(len(hashes) - 1, 0))
                often = hashes[at] == tokens if len(hashes) else np.zeros(len(tokens), bool)
                count = np.where(often, numbers[at], 0) if len(hashes) else np.zeros(len(tokens), np.int64)
                log_count = np.log10(count + 1)
                single = classes < TOP
                model = logs[cells, classes].astype(np.float64) + np.where(single, 0, inner[pairs] + log_count)
                first = bounds[:-1]
                rare = np.flatnonzero(~often)
                doc = np.searchsorted(bounds, rare, side="right") - 1
                yield pa.record_batch(
                    [
                        pa.array(done + np.arange(n)),
                        batch.column(0).slice(begin, n),
                        batch.column(2).slice(begin, n),
                        pa.array(np.diff(bounds)),
                        pa.array(np.add.reduceat(often, first, dtype=np.int64)),
                        pa.array(np.add.reduceat(log_count, first)),
                        pa.array(np.add.reduceat(model, first)),
                        pa.ListArray.from_arrays(
                            pa.array(np.searchsorted(doc, np.arange(n + 1)).astype(np.int32)),
                            pa.array(tokens[rare].view(np.int64)),
                        ),
                    ],
                    names=["row", "doc_id", "held_out", "n_tokens", "known", "logs", "model", "rare"],
                )
                done += n

    scored = source.mapInArrow(
        read,
        "row long, doc_id long, held_out boolean, n_tokens long, known long, logs double, model double, rare array<long>",
    )
    scored = materialise(scored, "scored")
    # A rare token is a small share of the training tokens. It counts towards both scores with its count.
    found = scored.select("row", F.explode("rare").alias("h")).join(counts, "h")
    sums = found.groupBy("row").agg(
        F.count(F.lit(1)).alias("rare_known"), F.sum(F.log10(F.col("c") + 1)).alias("rare_logs")
    )
    both = lambda name, rare: F.col(name) + F.coalesce(rare, F.lit(0))
    return scored.drop("rare").join(sums, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        both("known", "rare_known").alias("n_known"),
        F.lit(size["n"]).cast("long").alias("train_tokens"),
        (both("logs", "rare_logs") - F.col("n_tokens") * base).alias("base_score"),
        both("model", "rare_logs").alias("score"),
    )


def _signed(token: int) -> int:
    return token - (1 << 64) if token >= 1 << 63 else token
