"""Token ids of a corpus in Arrow files of equal-length sequences, and reading documents back from them.

A data set is a folder. ``tokens/`` holds Arrow IPC files; each record batch has two fixed-size-list columns, ``ids`` and
``mask``, of ``length`` values a sequence, so sequence k of a file is values k * length up to (k + 1) * length of one flat
buffer: a memory map of the file gives any sequence and its mask without a copy. The ids of all documents follow one
another in ascending doc_id order, file after file; only the last sequence of a file is padded, with mask false. ``index/``
is a Parquet table with the file, the place and the number of ids of each document.

Null text is the empty text (its ids are the end id alone); documents without doc_id come first; documents that share a
doc_id follow one another, ordered by text; an empty table gives an empty data set.
"""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import BYTE_BPE, prepared, slices, texts
from ledgerloom.llm.encoding import binaries, byte_encoder

# Values of a sequence and sequences of a record batch.
LENGTH = 1024
BATCH_SEQUENCES = 256

INDEX_SCHEMA = "file_no int, doc_id long, file_start long, n_tokens long"


def located(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system and path of a folder that executors and readers share."""
    return pafs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (pafs.LocalFileSystem(), uri)


def opened(uri: str) -> pa.ipc.RecordBatchFileReader:
    """A file's reader; a local file is mapped into memory, so its values are not copied."""
    system, path = located(uri)
    if isinstance(system, pafs.LocalFileSystem):
        return pa.ipc.open_file(pa.memory_map(path))
    return pa.ipc.open_file(system.open_input_file(path))


def token_file(folder: str, number: int) -> str:
    return f"{folder}/tokens/part-{number:06d}.arrow"


class SequenceWriter:
    """Cuts a stream of ids into sequences and writes them batch by batch; the file appears whole when it is closed.

    The ids are kept in the narrowest unsigned type that holds the vocabulary.
    """

    def __init__(self, uri: str, length: int, vocabulary: int):
        self.system, self.path = located(uri)
        self.unfinished = f"{posixpath.dirname(self.path)}/.{uuid.uuid4().hex}"
        self.length = length
        self.kind = pa.uint16() if vocabulary <= 1 << 16 else pa.uint32()
        self.schema = pa.schema({"ids": pa.list_(self.kind, length), "mask": pa.list_(pa.bool_(), length)})
        self.system.create_dir(posixpath.dirname(self.path), recursive=True)
        self.sink = self.system.open_output_stream(self.unfinished)
        self.file = pa.ipc.new_file(self.sink, self.schema)
        self.pending: list[np.ndarray] = []
        self.waiting = 0

    def add(self, ids: np.ndarray) -> None:
        self.pending.append(ids.astype(self.kind.to_pandas_dtype()))
        self.waiting += len(ids)
        size = self.length * BATCH_SEQUENCES
        if self.waiting >= size:
            joined = np.concatenate(self.pending)
            whole = len(joined) // size * size
            for at in range(0, whole, size):
                self._batch(joined[at : at + size], size)
            self.pending, self.waiting = [joined[whole:].copy()], len(joined) - whole

    def _batch(self, ids: np.ndarray, real: int) -> None:
        mask = np.zeros(len(ids), bool)
        mask[:real] = True
        columns = [
            pa.FixedSizeListArray.from_arrays(pa.array(ids, self.kind), self.length),
            pa.FixedSizeListArray.from_arrays(pa.array(mask), self.length),
        ]
        self.file.write_batch(pa.record_batch(columns, schema=self.schema))

    def close(self) -> None:
        if self.waiting:
            joined = np.concatenate(self.pending)
            padded = np.zeros(-(-len(joined) // self.length) * self.length, joined.dtype)
            padded[: len(joined)] = joined
            self._batch(padded, len(joined))
        self.file.close()
        self.sink.close()
        self.system.move(self.unfinished, self.path)


class SequenceReader:
    """Random access to the sequences and to any range of ids of one file."""

    def __init__(self, uri: str):
        self.file = opened(uri)
        self.length = self.file.schema.field("ids").type.list_size
        self.batches: dict[int, tuple[np.ndarray, pa.Array]] = {}

    def _flat(self, number: int) -> tuple[np.ndarray, pa.Array]:
        if number not in self.batches:
            batch = self.file.get_batch(number)
            if len(self.batches) >= 8:
                self.batches.pop(next(iter(self.batches)))
            self.batches[number] = batch.column("ids").values.to_numpy(), batch.column("mask").values
        return self.batches[number]

    def sequence(self, number: int) -> tuple[np.ndarray, pa.Array]:
        """The ids and the mask of one sequence, as views of the file."""
        ids, mask = self._flat(number // BATCH_SEQUENCES)
        at = number % BATCH_SEQUENCES * self.length
        return ids[at : at + self.length], mask.slice(at, self.length)

    def ids(self, start: int, count: int) -> np.ndarray:
        """A range of the file's ids; a range within one record batch is a view."""
        size, found = self.length * BATCH_SEQUENCES, []
        while count:
            flat = self._flat(start // size)[0]
            part = flat[start % size : start % size + count]
            found.append(part)
            start, count = start + len(part), count - len(part)
        return found[0] if len(found) == 1 else np.concatenate(found) if found else np.zeros(0, np.uint16)


def write_token_files(
    docs: DataFrame, folder: str, vocabulary: str = BYTE_BPE, end_id: int = 2, length: int = LENGTH
) -> DataFrame:
    """Encode ``docs`` (doc_id, text) into a new data set at ``folder``; returns its index.

    One range shuffle by doc_id. A task writes its file under a name of its own and moves it into place at the end, so a
    task that runs again replaces the file by an equal one. A task holds one batch of texts and of sequences.
    """
    spark = prepared(docs.sparkSession)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, number = byte_encoder(vocabulary), TaskContext.get().partitionId()
        size = encoder.library.get_vocab_size(with_added_tokens=True)
        out, at = None, 0
        for batch in batches:
            column = texts(batch.column(1))
            for begin, stop in slices(column):
                ids, bounds = encoder.encode(column.slice(begin, stop - begin).to_pylist())
                if out is None:
                    out = SequenceWriter(token_file(folder, number), length, max(size, end_id + 1))
                n = stop - begin
                out.add(np.insert(ids, bounds[1:], end_id))
                counts = np.diff(bounds) + 1
                starts = at + np.cumsum(counts) - counts
                at += int(counts.sum())
                yield pa.record_batch(
                    [
                        pa.array(np.full(n, number, np.int32)),
                        batch.column(0).slice(begin, n).cast(pa.int64()),
                        pa.array(starts),
                        pa.array(counts),
                    ],
                    names=["file_no", "doc_id", "file_start", "n_tokens"],
                )
        if out is not None:
            out.close()

    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
    )
    ordered.mapInArrow(write, INDEX_SCHEMA).write.parquet(f"{folder}/index")
    return token_index(spark, folder)


def token_index(spark: SparkSession, folder: str) -> DataFrame:
    """Where each document lies: (file_no, doc_id, file_start, n_tokens, start); start counts all ids before it."""
    index = prepared(spark).read.schema(INDEX_SCHEMA).parquet(f"{folder}/index")
    files = index.groupBy("file_no").agg(F.sum("n_tokens").alias("_ids"))
    before = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)  # one row for each file
    bases = files.select("file_no", F.coalesce(F.sum("_ids").over(before), F.lit(0)).alias("_base"))
    return index.join(bases, "file_no").select(
        "file_no", "doc_id", "file_start", "n_tokens", (F.col("_base") + F.col("file_start")).alias("start")
    )


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Every document of a data set from its files: (doc_id, start, n_tokens, ids), ids as little-endian 32-bit integers."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        readers: dict[int, SequenceReader] = {}
        for batch in batches:
            places = list(zip(*(batch.column(k).to_pylist() for k in ("file_no", "file_start", "n_tokens"))))
            for begin in range(0, len(places), 200):
                found = []
                for number, start, count in places[begin : begin + 200]:
                    if number not in readers:
                        if len(readers) >= 4:
                            readers.pop(next(iter(readers)))
                        readers[number] = SequenceReader(token_file(folder, number))
                    found.append(readers[number].ids(start, count))
                bounds = np.cumsum([0, *map(len, found)])
                piece = batch.slice(begin, len(found))
                yield pa.record_batch(
                    [*(piece.column(k) for k in ("doc_id", "start", "n_tokens")), binaries(np.concatenate(found), bounds)],
                    names=["doc_id", "start", "n_tokens", "ids"],
                )

    index = token_index(spark, folder).sortWithinPartitions("file_no", "file_start")
    return index.mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")
