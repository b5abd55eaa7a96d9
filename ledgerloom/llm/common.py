"""What the operators share: session settings, vocabulary files, slices of Arrow columns."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from types import ModuleType

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.session import tuned

# Rows of one Arrow batch, and bytes of text a task works on at once: they bound a Python worker's memory.
BATCH_ROWS = 1000
SLICE_BYTES = 2 << 20

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def prepared(spark: SparkSession) -> SparkSession:
    """The session with this library's settings and Arrow batches of bounded size."""
    tuned(spark).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    # Spark 4.1 takes a union of bucketed scans for bucketed, but does not line their buckets up: wrong aggregates.
    spark.conf.set("spark.sql.unionOutputPartitioning", "false")
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{folder}/{name}.parquet")


def texts(column: pa.Array) -> pa.Array:
    """A text column as plain strings, null as the empty text."""
    return pc.fill_null(column.cast(pa.string()), "")


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of about ``limit`` bytes of text each, at least one row."""
    if not len(column):
        return
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    group = (np.cumsum(sizes) - sizes) // limit
    cuts = np.flatnonzero(np.diff(group)) + 1
    bounds = [0, *cuts.tolist(), len(column)]
    yield from zip(bounds[:-1], bounds[1:])


def fold(key: Column, parts: int) -> Column:
    """crc32 of an id written as text, modulo ``parts``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % parts


def all_finite(vector: Column) -> Column:
    """Whether a vector is there and holds finite numbers only."""
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(sound, F.lit(False))


def kept_in_worker() -> dict:
    """A dictionary that lives as long as the Python worker; functions sent by value have no module of their own."""
    return sys.modules.setdefault("ledgerloom_llm_worker", ModuleType("ledgerloom_llm_worker")).__dict__
