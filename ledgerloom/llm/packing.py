"""Packing documents into training sequences: bounded-space online best fit.

A task encodes its documents in order. A document of n ids is cut into pieces of ``length`` ids and a rest; whole pieces are
sequences of their own. The rest goes to the open window in which it leaves the least space; if it fits in none, the fullest
window is emitted when all are in use, and a new one is opened. What is still open when a partition ends is merged:
groups of partitions place the pieces of their open windows anew, largest first, best fit. Memory is bounded by the number
of open windows, whatever the input.

A sequence is padded to ``length``, unless its ids are a power of two in number: then it stays as it is.

Null text is the empty text (its ids are the end id alone). Rows that share a doc_id, also a null one, are documents
of their own. An empty table gives no piece.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import BYTE_BPE, prepared, slices, texts
from ledgerloom.llm.encoding import binaries, byte_encoder
from ledgerloom.session import scratch_path

LENGTH = 1024
OPEN_WINDOWS = 128
# Partitions whose open windows one task merges.
MERGED_PARTITIONS = 64

PLACED_SCHEMA = (
    "closed boolean, part int, doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, "
    "sequence_length long, ids binary"
)


def padded_length(filled: int, length: int) -> int:
    """The stored length of a sequence: a power of two stays, anything else is padded."""
    return filled if filled & (filled - 1) == 0 else length


class Windows:
    """A bounded set of open windows; a window is a list of (size, piece)."""

    def __init__(self, length: int, most: int):
        self.length, self.most = length, most
        self.room: list[tuple[int, int]] = []  # (free ids, window), ascending
        self.content: dict[int, list] = {}
        self.made = 0

    def place(self, size: int, piece) -> list | None:
        """Put a piece where it leaves the least space; returns a window that had to be emitted for it, if any."""
        at, emitted = bisect_left(self.room, (size, -1)), None
        if at < len(self.room):
            free, window = self.room.pop(at)
        else:
            if len(self.room) >= self.most:
                emitted = self.content.pop(self.room.pop(0)[1])
            free, window = self.length, self.made
            self.content[window] = []
            self.made += 1
        self.content[window].append((size, piece))
        if free == size:
            return self.content.pop(window)  # an open window, so none was emitted: a piece is shorter than a window
        insort(self.room, (free - size, window))
        return emitted

    def rest(self) -> list[list]:
        return [self.content[w] for _, w in self.room]


def pack(docs: DataFrame, vocabulary: str = BYTE_BPE, end_id: int = 0, length: int = LENGTH) -> DataFrame:
    """Pack ``docs`` (doc_id, text): one row for each piece.

    Columns: doc_id, start (ids of its document before it), length, doc_tokens, sequence_id, offset (in the sequence),
    sequence_length (padded), ids (little-endian unsigned 32-bit integers).
    """
    spark = prepared(docs.sparkSession)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = byte_encoder(vocabulary), TaskContext.get().partitionId()
        windows, made, ready, waiting = Windows(length, OPEN_WINDOWS), 0, [], 0

        def emit(window: list, closed: bool) -> None:
            nonlocal made, waiting
            filled, at = sum(size for size, _ in window), 0
            stored = padded_length(filled, length)
            for size, (doc, start, total, ids) in window:
                ready.append((closed, part, doc, start, size, total, (part << 32) + made, at, stored, ids))
                at += size
            made, waiting = made + 1, waiting + filled

        def rows() -> pa.RecordBatch:
            nonlocal ready, waiting
            columns = list(zip(*ready))
            ids = columns.pop()
            kinds = [pa.bool_(), pa.int32(), *[pa.int64()] * 7]
            done = pa.record_batch(
                [pa.array(c, k) for c, k in zip(columns, kinds)]
                + [binaries(np.concatenate(ids), np.cumsum([0, *map(len, ids)]))],
                names=[f.split()[0] for f in PLACED_SCHEMA.split(", ")],
            )
            ready, waiting = [], 0
            return done

        for batch in batches:
            column, keys = texts(batch.column(1)), batch.column(0).to_pylist()
            for begin, stop in slices(column):
                ids, bounds = encoder.encode(column.slice(begin, stop - begin).to_pylist())
                ids = np.insert(ids, bounds[1:], end_id)
                bounds = (bounds + np.arange(len(bounds))).tolist()
                for k in range(stop - begin):
                    own, total = ids[bounds[k] : bounds[k + 1]], bounds[k + 1] - bounds[k]
                    whole = total // length * length
                    for at in range(0, whole, length):
                        emit([(length, (keys[begin + k], at, total, own[at : at + length]))], True)
                    if whole < total:
                        rest = keys[begin + k], whole, total, own[whole:].copy()
                        if pushed := windows.place(total - whole, rest):
                            emit(pushed, True)
                    if waiting >= 1 << 20:
                        yield rows()
        for window in windows.rest():
            emit(window, False)
        if ready:
            yield rows()

    path = scratch_path(spark, "packed")
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    placed = source.mapInArrow(place, PLACED_SCHEMA)
    placed.write.partitionBy("closed").option("compression", "zstd").parquet(path)
    placed = spark.read.schema(PLACED_SCHEMA).parquet(path)
    kept = "doc_id, start, length, doc_tokens, sequence_id, offset, sequence_length, ids".split(", ")
    return placed.where("closed").select(kept).unionByName(merged(placed.where("not closed"), length).select(kept))


def merged(left: DataFrame, length: int) -> DataFrame:
    """Place the pieces of open windows anew; a task merges the windows of a fixed number of partitions."""

    def merge(key: tuple[pa.Scalar], pieces: pa.Table) -> pa.Table:
        group = key[0].as_py()
        sizes = pieces.column("length").to_numpy()
        order = np.lexsort((pieces.column("offset").to_numpy(), pieces.column("sequence_id").to_numpy(), -sizes))
        windows = Windows(length, len(order) + 1)
        done = [full for row in order.tolist() if (full := windows.place(int(sizes[row]), row))] + windows.rest()
        sequence, offset, stored = (np.zeros(len(order), np.int64) for _ in range(3))
        for number, window in enumerate(done):
            filled, at = sum(size for size, _ in window), 0
            for size, row in window:
                sequence[row], offset[row] = (1 << 62) + (group << 32) + number, at
                stored[row] = padded_length(filled, length)
                at += size
        columns = {name: pieces.column(name) for name in ("doc_id", "start", "length", "doc_tokens", "ids")}
        return pa.table(
            columns
            | {"sequence_id": pa.array(sequence), "offset": pa.array(offset), "sequence_length": pa.array(stored)}
        )

    grouped = left.withColumn("_group", F.floor(F.col("part") / MERGED_PARTITIONS)).groupBy("_group")
    return grouped.applyInArrow(
        merge,
        "doc_id long, start long, length long, doc_tokens long, ids binary, sequence_id long, offset long, "
        "sequence_length long",
    )

