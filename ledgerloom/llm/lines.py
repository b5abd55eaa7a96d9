"""Removing lines that many documents share, with levelled sorted runs of line hashes.

A line's key is the line without ASCII white space at both ends and with A-Z in lower case; its hash is the md5 of the key.
Documents arrive in batches. A batch counts its hashes, merge-anti-joins them with the runs (hashes that the runs already
hold often enough are settled and left out), and adds the rest as a sorted run of its own. When a level has ``FANOUT`` runs,
they are merged into one run of the next level. Runs are bucketed and sorted by hash, so a batch meets them without a
shuffle of the runs. The counts of all runs give the lines to drop.

A document drops every line whose non-empty key is found in at least ``min_docs`` documents; its other lines stay, joined
by newlines. Null and empty texts are one empty line. Every row is a document, also rows that repeat a doc_id or have none.
An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import prepared, slices, texts
from ledgerloom.session import scratch_path

MIN_DOCS = 10
BATCHES = 4
FANOUT = 2
# A key that holds more than one in so many of all line rows counts as hot; there can be no more hot keys than that.
HOT_SHARE = 2000
BLANKS = " \t\n\x0b\x0c\r"


def line_keys(column: pa.Array) -> tuple[pa.Array, pa.Array, np.ndarray]:
    """The lines of all texts, their keys, and the number of lines before each text (one entry more)."""
    split = pc.split_pattern(column, "\n")
    lines = split.flatten()
    counts = split.value_lengths().to_numpy(zero_copy_only=False)
    return lines, pc.ascii_lower(pc.ascii_trim(lines, characters=BLANKS)), np.concatenate([[0], np.cumsum(counts)])


def key_hash(key: str) -> bytes:
    return hashlib.md5(key.encode("utf-8"), usedforsecurity=False).digest()


class LineRuns:
    """Sorted runs of (h, n): line hashes and the number of documents that hold them, kept in levels."""

    def __init__(self, spark: SparkSession, min_docs: int):
        self.spark, self.min_docs = spark, min_docs
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []

    def _write(self, counts: DataFrame, level: int) -> None:
        name = f"line_run_{uuid.uuid4().hex}"
        path = scratch_path(self.spark, "line-run")
        writer = counts.write.bucketBy(self.buckets, "h").sortBy("h").option("path", path).format("parquet")
        writer.saveAsTable(name)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)

    def runs(self) -> list[str]:
        return [name for level in self.levels for name in level]

    def add(self, batch: DataFrame) -> None:
        """Add a batch of (h), one row for each document and hash, less the hashes that are settled already."""
        counts = batch.groupBy("h").agg(F.count(F.lit(1)).alias("n"))
        found = F.lit(0).cast("long")
        for k, name in enumerate(self.runs()):
            run = self.spark.table(name).select("h", F.col("n").alias(f"n_{k}"))
            counts = counts.join(run, "h", "left")
            found = found + F.coalesce(F.col(f"n_{k}"), F.lit(0))
        self._write(counts.where(found < self.min_docs).select("h", "n"), 0)
        level = 0
        while len(self.levels[level]) >= FANOUT:
            self._merge(self.levels[level], level + 1)
            self.levels[level] = []
            level += 1

    def _merge(self, names: list[str], level: int) -> None:
        self._write(self._totals(names), level)
        for name in names:
            self.spark.sql(f"DROP TABLE {name}")

    def _totals(self, names: list[str]) -> DataFrame:
        """Runs merged on their sorted buckets, counts added."""

        def merged(left: DataFrame, right: DataFrame) -> DataFrame:
            right = right.withColumnRenamed("n", "m")
            total = F.coalesce("n", F.lit(0)) + F.coalesce("m", F.lit(0))
            return left.join(right, "h", "full").select("h", total.alias("n"))

        return reduce(merged, map(self.spark.table, names))

    def frequent(self) -> DataFrame:
        """The hashes found in at least ``min_docs`` documents: (h, n), n up to where the hash was settled."""
        return self._totals(self.runs()).where(F.col("n") >= self.min_docs)


def drop_shared_lines(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` with its text less the shared lines, and n_lines and n_dropped: (row, text, n_lines, n_dropped).

    ``row`` is the whole input row as a struct, so its columns may have any names but need doc_id and text.
    """
    spark = prepared(docs.sparkSession)

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = texts(batch.column(1))
            for begin, stop in slices(column):
                _, keys, bounds = line_keys(column.slice(begin, stop - begin))
                found = [key_hash(k) if k else b"" for k in keys.to_pylist()]
                own = [[*{h for h in found[a:b] if h}] for a, b in zip(bounds, bounds[1:])]
                n = stop - begin
                columns = [batch.column(k).slice(begin, n) for k in (0, 2)]
                yield pa.record_batch([*columns, pa.array(own, pa.list_(pa.binary()))], names=["doc_id", "batch", "hs"])

    source = docs.select(F.struct("*").alias("row"))
    keyed = source.select(
        F.col("row.doc_id").cast("long").alias("doc_id"),
        F.col("row.text").cast("string").alias("text"),
        F.pmod(F.xxhash64("row.doc_id", "row.text"), F.lit(BATCHES)).cast("int").alias("batch"),
    )
    path = scratch_path(spark, "lines")
    lines = keyed.mapInArrow(hashes, "doc_id long, batch int, hs array<binary>")
    lines.select("doc_id", "batch", F.explode("hs").alias("h")).write.partitionBy("batch").parquet(path)
    lines = spark.read.schema("doc_id long, h binary, batch int").parquet(path)

    runs = LineRuns(spark, min_docs)
    for k in range(BATCHES):
        runs.add(lines.where(F.col("batch") == k).select("h"))
    settled = scratch_path(spark, "frequent-lines")
    runs.frequent().write.parquet(settled)
    frequent = spark.read.schema("h binary, n long").parquet(settled)

    # The runs count a line row once at most, so no more than HOT_SHARE hashes can reach the limit: they are broadcast.
    # Every other hash is a small share of the rows: batches are cut by a hash, and the runs hold the whole first batch.
    limit = max(min_docs, lines.count() // HOT_SHARE + 1)
    hot = F.broadcast(frequent.where(F.col("n") >= limit).select("h", F.lit(True).alias("hot")))
    rare = frequent.where(F.col("n") < limit).select("h")
    marked = lines.select("doc_id", "h").join(hot, "h", "left")
    shared = marked.where("hot").select("doc_id", "h").unionByName(
        marked.where("hot IS NULL").select("doc_id", "h").join(rare, "h")
    )
    per_doc = shared.groupBy("doc_id").agg(F.collect_set("h").alias("hs")).withColumnRenamed("doc_id", "_id")
    joined = source.join(per_doc, F.col("row.doc_id").cast("long").eqNullSafe(F.col("_id")), "left")

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = texts(batch.column(1))
            for begin, stop in slices(column):
                n = stop - begin
                values, gone = column.slice(begin, n), batch.column(2).slice(begin, n).to_pylist()
                kept, counts, dropped = values.to_pylist(), [], []
                lines, keys, bounds = line_keys(values)
                for k, (a, b) in enumerate(zip(bounds.tolist(), bounds[1:].tolist())):
                    counts.append(b - a)
                    if not gone[k]:
                        dropped.append(0)
                        continue
                    bad = set(gone[k])
                    stay = [
                        line
                        for line, key in zip(lines.slice(a, b - a).to_pylist(), keys.slice(a, b - a).to_pylist())
                        if not key or key_hash(key) not in bad
                    ]
                    dropped.append(b - a - len(stay))
                    kept[k] = "\n".join(stay)
                yield pa.record_batch(
                    [
                        batch.column(0).slice(begin, n),
                        pa.array(kept, pa.string()),
                        pa.array(counts, pa.int64()),
                        pa.array(dropped, pa.int64()),
                    ],
                    names=["row", "text", "n_lines", "n_dropped"],
                )

    kind = docs.schema.simpleString()
    return joined.select("row", F.col("row.text").cast("string").alias("text"), "hs").mapInArrow(
        drop, f"row {kind}, text string, n_lines long, n_dropped long"
    )
