"""Similarity join of documents on word n-grams by Jaccard, with vertical partitioning.

The global order of n-grams is the order of their 64-bit hashes. It is cut into fragments twice.

Fine fragments find who may be similar: there are so many that two similar sets must agree on a whole fragment, whose
members are signed with one number (``shingles.signatures``). Equal sets are one class first, so copies sign once. If few
classes share a signature, each two of them are compared by size and by parities of their members, which rule out most pairs that
share it by chance and never a similar one (``shingles.can_reach``); the rest are connected. If many share it, all are connected.
What is connected is a cluster of candidates.

Coarse fragments count: a task holds one or two blocks of a cluster, cuts their sets into fragments, counts the overlap of all
pairs in each fragment on its own, sums the counts per pair, and compares with the threshold exactly. Blocks hold sets of
similar size and are bounded in sets and n-grams; blocks whose sizes rule out the threshold never meet. A task returns the
number of links of each class and the smallest class it is connected with inside the task, so pairs never become rows.

Null and empty texts, or texts without a word, have no n-gram and link with nothing; rows without doc_id link with nothing and have
no component. Rows that share a doc_id are one document for the components; each keeps its row. An empty table gives
an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import prepared, slices, texts
from ledgerloom.llm.graph import components
from ledgerloom.llm.links import Links
from ledgerloom.llm.shingles import can_reach, digest, mixed, parities, shingle_sets, signatures
from ledgerloom.session import discard, materialise

WIDTH = 3
PERCENT = 90
# Classes that share a signature are compared two by two if there are no more than that.
PAIRED = 16
# Sets and n-grams of a block on average, and the factor between the sizes of a large cluster's bands.
BLOCK_SETS = 1024
BLOCK_GRAMS = 2 << 20
BAND_FACTOR = 1.05
# Coarse fragments of the n-gram order, as bits: 8 fragments.
FRAGMENT_BITS = 3
# n-grams of at most so many sets are counted pair by pair, others with a matrix product of so many columns at once.
RARE = 8
COLUMNS = 2048


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """The number of common members of all pairs of sets, counted fragment by fragment."""
    n = len(sets)
    total = np.zeros((n, n), np.int64)
    members = np.concatenate(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    place = members >> np.uint64(64 - FRAGMENT_BITS)
    for part in range(1 << FRAGMENT_BITS):
        chosen = np.flatnonzero(place == part)
        order = chosen[np.argsort(members[chosen], kind="stable")]
        grams, rows = members[order], owner[order]
        first = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]])) if len(grams) else np.zeros(0, np.int64)
        count = np.diff(np.append(first, len(grams)))
        for k in range(2, RARE + 1):
            held = rows[first[count == k][:, None] + np.arange(k)[None, :]]
            for i in range(k):
                for j in range(i + 1, k):
                    np.add.at(total, (held[:, i], held[:, j]), 1)
        common = np.flatnonzero(count > RARE)
        for at in range(0, len(common), COLUMNS):
            some = common[at : at + COLUMNS]
            index = np.concatenate([np.arange(first[c], first[c] + count[c]) for c in some])
            held = np.zeros((n, len(some)), np.float32)  # counts stay far below 2^24, so they are exact
            held[rows[index], np.repeat(np.arange(len(some)), count[some])] = 1
            total += np.triu(held @ held.T, 1).astype(np.int64)
    return total


def similar(sets: list[np.ndarray], left: np.ndarray, same: bool, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j), i before j, that reach the threshold; from both sides only, unless ``same``."""
    sizes = np.array([len(s) for s in sets], np.int64)
    reach = overlaps(sets) * (100 + percent) >= percent * (sizes[:, None] + sizes[None, :])
    i, j = np.nonzero(np.triu(reach, 1))
    if not same:
        across = left[i] != left[j]
        i, j = i[across], j[across]
    return i, j


def ngram_sets(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """(doc_id, n, d1, d2, sigs, bits): set size, digest, signatures and parities of each document."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = texts(batch.column(1))
            for begin, stop in slices(column, 2 << 20):
                with np.errstate(over="ignore"):
                    sets = shingle_sets(column.slice(begin, stop - begin), width)
                    signed = [signatures(own, percent).view(np.int64) for own in sets]
                    bits = [parities(own).tobytes() for own in sets]
                digests = [digest(own) for own in sets]
                offsets = np.cumsum([0, *map(len, signed)]).astype(np.int32)
                yield pa.record_batch(
                    [
                        batch.column(0).slice(begin, stop - begin),
                        pa.array([len(own) for own in sets], pa.int64()),
                        pa.array([d[0] for d in digests], pa.int64()),
                        pa.array([d[1] for d in digests], pa.int64()),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(signed))),
                        pa.array(bits, pa.binary()),
                    ],
                    names=["doc_id", "n", "d1", "d2", "sigs", "bits"],
                )

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return source.mapInArrow(read, "doc_id long, n long, d1 long, d2 long, sigs array<long>, bits binary")


# What stands in a signed row's place for another class: none, or none but already known to be one of many.
PLAIN, ONE_OF_MANY = -1, -2


def folded_signatures(cid: np.ndarray, counts: np.ndarray, sigs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, cid, other) for the signatures of some classes, one after the other, ``counts`` of each.

    A row with its signature as key stands for one class that signs it. Where more than PAIRED of these classes share a signature,
    the first stands for all, and the others become edges to it, dealt by themselves, so a hot signature sends one such row.
    """
    owner = np.repeat(cid, counts)
    order = np.lexsort((owner, sigs))
    sigs, owner = sigs[order], owner[order]
    first = np.flatnonzero(np.concatenate([[True], sigs[1:] != sigs[:-1]])) if len(sigs) else np.zeros(0, np.int64)
    size = np.diff(np.append(first, len(sigs)))
    head = np.repeat(first, size)
    many = np.repeat(size > PAIRED, size)
    other = np.where(many, owner[head], PLAIN)
    leads = many & (np.arange(len(sigs)) == head)
    other[leads] = ONE_OF_MANY
    with np.errstate(over="ignore"):
        own = mixed(owner.astype(np.uint64)).view(np.int64)
    return np.where(other >= 0, own, sigs), owner, other


class SharedSignatures:
    """Reads (key, cid, other) in ascending order and gives pairs (a, b, few): of classes that share a signature with at most
    PAIRED in all, or an edge to the first of many. It keeps the run of the last key only, and of a long one only its first row."""

    def __init__(self):
        self.rest = [np.zeros(0, np.int64)] * 3

    def read(self, key: np.ndarray, cid: np.ndarray, other: np.ndarray, last: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        edges = other >= 0
        found = [(cid[edges], other[edges], False)]
        key, cid, other = (np.concatenate([old, new[~edges]]) for old, new in zip(self.rest, (key, cid, other)))
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        size = np.diff(np.append(first, len(key)))
        many = np.maximum.reduceat(other == ONE_OF_MANY, first) | (size > PAIRED) if len(first) else np.zeros(0, bool)
        whole = np.ones(len(first), bool)
        if not last and len(first):
            begin = first[-1]
            whole[-1] = bool(many[-1])  # a run of many gives its edges at once, and its first row waits for more
            keep = slice(begin, begin + 1) if many[-1] else slice(begin, None)
            self.rest = [key[keep], cid[keep], np.full(1, ONE_OF_MANY) if many[-1] else other[keep]]
        elif last:
            self.rest = [np.zeros(0, np.int64)] * 3
        for k in range(2, PAIRED + 1):
            held = cid[first[whole & ~many & (size == k)][:, None] + np.arange(k)[None, :]]
            found += [(held[:, i], held[:, j], True) for i in range(k) for j in range(i + 1, k) if len(held)]
        chained = np.repeat(whole & many, size)
        head = np.repeat(first, size)
        chained &= np.arange(len(key)) != head
        found.append((cid[chained], cid[head[chained]], False))
        a, b = (np.concatenate([f[k] for f in found]) for k in (0, 1))
        return a, b, np.repeat([f[2] for f in found], [len(f[0]) for f in found])


def candidate_clusters(classes: DataFrame, percent: int) -> DataFrame:
    """Classes (cid, n, sigs, bits) connected by shared signatures: (cid, cluster).

    Signatures are shuffled once: folded where they are read, dealt and sorted by signature, and read in that order.
    """

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("sigs")
            counts = np.diff(lists.offsets.to_numpy())
            columns = folded_signatures(batch.column("cid").to_numpy(), counts, lists.flatten().to_numpy())
            yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=["key", "cid", "other"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = SharedSignatures()
        empty = np.zeros(0, np.int64)
        for columns in chain(([c.to_numpy() for c in batch.columns] for batch in batches), [None]):
            pairs = shared.read(empty, empty, empty, True) if columns is None else shared.read(*columns)
            if len(pairs[0]):
                yield pa.record_batch([pa.array(c) for c in pairs], names=["a", "b", "few"])

    signed = classes.select("cid", "sigs").mapInArrow(fold, "key long, cid long, other long")
    ordered = signed.repartition("key").sortWithinPartitions("key", "cid")
    tied = materialise(ordered.mapInArrow(read, "a long, b long, few boolean").distinct(), "tied")
    pairs, many = tied.where("few").select("a", "b"), tied.where("NOT few").select("a", "b")
    return components(possible(pairs, classes, percent).unionByName(many)).select(
        F.col("node").alias("cid"), F.col("component").alias("cluster")
    )


def possible(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of classes whose sizes and parities do not rule out the threshold."""

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = [batch.column(name).to_pylist() for name in ("bits_a", "bits_b")]
            sizes = [batch.column(name).to_numpy() for name in ("n_a", "n_b")]
            yield batch.select(["a", "b"]).filter(pa.array(can_reach(bits, sizes, percent)))

    for side in ("a", "b"):
        own = classes.select(F.col("cid").alias(side), F.col("n").alias(f"n_{side}"), F.col("bits").alias(f"bits_{side}"))
        pairs = pairs.join(own.hint("merge"), side)
    return pairs.mapInArrow(choose, "a long, b long")


def block_pairs(members: DataFrame, percent: int) -> DataFrame:
    """Where each member (cid, n, cluster) is compared: (cid, task, is_left, same).

    A cluster that fits one block is one block. A larger one is cut by set size into bands, and each band by a hash into
    blocks; a block meets those of its own band and of the bands whose sizes can still reach the threshold.
    """
    whole = members.groupBy("cluster").agg(F.count(F.lit(1)).alias("_sets"), F.sum("n").alias("_grams"))
    large = (F.col("_sets") > BLOCK_SETS) | (F.col("_grams") > BLOCK_GRAMS)
    large_ones = whole.where(large).select("cluster", F.lit(True).alias("_large"))
    band = F.when(F.col("_large"), F.floor(F.log(F.col("n").cast("double")) / math.log(BAND_FACTOR))).otherwise(0)
    banded = members.join(large_ones, "cluster", "left").withColumn("band", band.cast("int"))
    cells = banded.groupBy("cluster", "band").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_SETS), F.ceil(F.sum("n") / BLOCK_GRAMS)).cast("int").alias("parts"),
        F.first("_large").alias("_large"),
    )
    cells = materialise(cells, "cells")
    placed = banded.join(cells.drop("_large"), ["cluster", "band"]).select(
        "cid", "cluster", "band", F.pmod(F.xxhash64("cid"), F.col("parts")).cast("int").alias("part")
    )
    reach = math.ceil(math.log(100 / percent) / math.log(BAND_FACTOR)) + 1
    steps = F.when(F.col("_large"), F.sequence(F.lit(0), F.lit(reach))).otherwise(F.array(F.lit(0)))
    left = cells.select("cluster", "band", F.col("parts").alias("left_parts"), F.explode(steps).alias("step"))
    left = left.withColumn("other", (F.col("band") + F.col("step")).cast("int"))
    right = cells.select("cluster", F.col("band").alias("other"), F.col("parts").alias("right_parts"))
    pairs = left.join(right, ["cluster", "other"])
    pairs = pairs.withColumn("x", F.explode(F.sequence(F.lit(0), F.col("left_parts") - 1)))
    lowest = F.when(F.col("step") == 0, F.col("x")).otherwise(0)
    pairs = pairs.withColumn("y", F.explode(F.sequence(lowest, F.col("right_parts") - 1)))
    same = (F.col("step") == 0) & (F.col("x") == F.col("y"))
    pairs = pairs.select("cluster", "band", "x", "other", "y", same.alias("same"))
    task = F.struct("cluster", "band", "x", "other", "y").alias("task")
    as_left = pairs.select("cluster", "band", F.col("x").alias("part"), task, F.lit(True).alias("is_left"), "same")
    as_right = pairs.where(~F.col("same")).select(
        "cluster", F.col("other").alias("band"), F.col("y").alias("part"), task, F.lit(False).alias("is_left"), "same"
    )
    return placed.join(as_left.unionByName(as_right), ["cluster", "band", "part"]).select("cid", "task", "is_left", "same")


def ngram_join(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """Link ``docs`` (doc_id, text) whose n-gram sets have a Jaccard similarity of ``percent`` or more.

    Returns (doc_id, n_shingles, component_id, n_links), one row a document: the size of its set, the smallest doc_id it is
    connected with, and the number of other documents it links with directly.
    """
    prepared(docs.sparkSession)
    sets = materialise(ngram_sets(docs, width, percent), "ngram-sets")
    classes = sets.where("n > 0 AND doc_id IS NOT NULL").groupBy("n", "d1", "d2").agg(
        F.min(F.struct("doc_id", "sigs", "bits")).alias("least"), F.count(F.lit(1)).alias("weight")
    )
    classes = classes.select(
        F.monotonically_increasing_id().alias("cid"), "n", "d1", "d2", "weight", "least.doc_id", "least.sigs", "least.bits"
    )
    classes = materialise(classes, "ngram-classes")  # from here on the numbers are fixed
    known = materialise(classes.drop("sigs", "bits"), "known-classes")
    rows = materialise(sets.select("doc_id", "n", "d1", "d2"), "set-sizes")
    discard(sets)
    clusters = materialise(candidate_clusters(classes, percent), "clusters")
    discard(classes)
    members = materialise(known.join(clusters, "cid"), "members")

    # A class is compared in as many tasks as its cluster has blocks of similar size.
    tasks = block_pairs(members.select("cid", "n", "cluster"), percent).groupBy("cid").agg(
        F.collect_list(F.struct("task", "is_left", "same")).alias("tasks")
    )
    tasks = materialise(members.select("doc_id", "cid", "weight", "d1", "d2").join(tasks, "cid"), "tasks")
    kind = tasks.schema["tasks"].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = texts(batch.column("text"))
            for begin, stop in slices(column, 2 << 20):
                with np.errstate(over="ignore"):
                    own = shingle_sets(column.slice(begin, stop - begin), width)
                part = batch.slice(begin, stop - begin)
                wanted = list(zip(part.column("d1").to_pylist(), part.column("d2").to_pylist()))
                # Another row with the same doc_id may have another text.
                keep = [k for k, s in enumerate(own) if digest(s) == wanted[k]]
                part = part.take(pa.array(keep, pa.int64()))
                grams = pa.array([own[k].view(np.int64) for k in keep], pa.list_(pa.int64()))
                yield pa.record_batch(
                    [part.column("cid"), part.column("weight"), part.column("tasks"), grams],
                    names=["cid", "weight", "tasks", "grams"],
                )

    # Texts are shuffled by id: the tasks grow with the corpus, so they are never broadcast.
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    read_again = source.join(tasks.hint("merge"), "doc_id").select("cid", "weight", "d1", "d2", "tasks", "text")
    grams = read_again.mapInArrow(read, f"cid long, weight long, tasks {kind}, grams array<long>")
    assigned = grams.select("cid", "weight", "grams", F.inline("tasks"))

    def search(found: pa.Table) -> pa.Table:
        found = found.combine_chunks()
        cid, at = np.unique(found.column("cid").to_numpy(), return_index=True)  # repeated rows
        lists = found.column("grams").chunk(0)
        sets = [lists[k].values.to_numpy().view(np.uint64) for k in at.tolist()]
        links = Links(found.column("weight").to_numpy()[at])
        links.add(*similar(sets, found.column("is_left").to_numpy()[at], found.column("same")[0].as_py(), percent))
        hit = np.flatnonzero(links.counts)
        return pa.table({"cid": cid[hit], "links": links.counts[hit], "near": cid[links.root[hit]]})

    result = assigned.groupBy("task").applyInArrow(search, "cid long, links long, near long")
    result = materialise(result, "links")
    counts = result.groupBy("cid").agg(F.sum("links").alias("links"))
    named = known.select("cid", F.col("doc_id").alias("a"))
    linked = result.where("cid != near").join(named, "cid").join(
        known.select(F.col("cid").alias("near"), F.col("doc_id").alias("b")), "near"
    )
    # Classes whose first document is the same row's doc_id with another text meet here, too.
    groups = components(linked.select("a", "b"))
    outcome = known.join(counts, "cid", "left").join(groups, known["doc_id"] == groups["node"], "left").select(
        "n", "d1", "d2", F.coalesce("component", "doc_id").alias("component_id"),
        (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
    )
    outcome = materialise(outcome, "classes-linked")
    joined = rows.join(outcome, ["n", "d1", "d2"], "left")
    has_id = F.col("doc_id").isNotNull()
    return joined.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(has_id, F.coalesce("component_id", "doc_id")).alias("component_id"),
        F.when(has_id, F.coalesce("n_links", F.lit(0))).otherwise(0).alias("n_links"),
    )
