"""Byte-pair encoding with word ends, and decoding.

A unit's symbols form a doubly linked list; a priority queue holds the mergeable neighbours by (merge rank, place). The
lowest is merged, the pairs it forms with its neighbours join the queue, and entries whose symbols have changed since are
skipped when they come up. Decoding joins the vocabulary strings as the library does for a file without a decoder.

Null text is the empty text, which has no ids and decodes to the empty text. Strings of added tokens inside a text are
those tokens. Every row is encoded, also rows that repeat a doc_id or have none; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import WORD_BPE, kept_in_worker, prepared, slices, texts
from ledgerloom.llm.encoding import REMEMBERED, binaries
from ledgerloom.llm.pretokens import Gathered, Splitter, as_letters


class WordCodec:
    """Encodes and decodes with one vocabulary file: NFC, lower case, white space dropped, a suffix at word ends."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model = content["model"]
        self.vocabulary: dict[str, int] = model["vocab"]
        self.suffix: str = model["end_of_word_suffix"] or ""
        self.strings = {i: s for s, i in self.vocabulary.items()}
        self.added = {t["content"]: t["id"] for t in content["added_tokens"]}
        self.strings |= {i: s for s, i in self.added.items()}
        self.pairs: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (left, right) in enumerate(model["merges"]):
            pair = self.vocabulary[left], self.vocabulary[right]
            self.pairs.setdefault(pair, (rank, self.vocabulary[left + right]))
        self.splitter = Splitter(leading_space=False, single_numbers=True)
        self.known: dict[str, tuple[tuple[int, ...], str]] = {}

    def merge(self, letters: str) -> tuple[int, ...]:
        """The ids of one unit, given as vocabulary characters."""
        vocabulary, pairs = self.vocabulary, self.pairs
        ids = [vocabulary[c] for c in letters[:-1]]
        ids.append(vocabulary[letters[-1] + self.suffix])
        n = len(ids)
        if n == 1:
            return (ids[0],)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = []
        for i in range(n - 1):
            found = pairs.get((ids[i], ids[i + 1]))
            if found is not None:
                queue.append((found[0], i, ids[i], ids[i + 1], found[1]))
        heapify(queue)
        while queue:
            _, i, left, right, joined = heappop(queue)
            j = after[i]
            if ids[i] != left or j >= n or ids[j] != right:
                continue  # stale: one of the two symbols has been merged since
            ids[i], ids[j] = joined, -1
            j = after[i] = after[j]
            if j < n:
                before[j] = i
                found = pairs.get((joined, ids[j]))
                if found is not None:
                    heappush(queue, (found[0], i, joined, ids[j], found[1]))
            j = before[i]
            if j >= 0:
                found = pairs.get((ids[j], joined))
                if found is not None:
                    heappush(queue, (found[0], j, ids[j], joined, found[1]))
        return tuple([i for i in ids if i >= 0])

    def decode(self, ids) -> str:
        """The text of ids, special tokens included."""
        return " ".join([self.strings[i] for i in ids])

    def unit(self, text: str) -> tuple[tuple[int, ...], str]:
        """The ids of one unit and their decoded string."""
        found = self.known.get(text)
        if found is None:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            ids = self.merge(as_letters(text))
            found = self.known[text] = ids, self.decode(ids)
        return found

    def normalised(self, text: str) -> str:
        # One character at a time, as the library lower-cases: no final form of sigma.
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def encode(self, values: list[str]) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        """The ids of all texts, the number of ids before each (one entry more), and the decoded texts."""
        segments, special, owner = [], [], []
        cut = re.compile("(" + "|".join(map(re.escape, self.added)) + ")") if self.added else None
        for row, value in enumerate(values):
            parts = cut.split(value) if cut is not None and any(a in value for a in self.added) else [value]
            for k in range(0, len(parts), 2):  # every second part is the string of an added token
                segments.append(self.normalised(parts[k]))
                special.append(parts[k + 1] if k + 1 < len(parts) else None)
                owner.append(row)
        units, before = self.splitter.split(segments)
        coded = units.dictionary_encode()
        distinct = [self.unit(u) for u in coded.dictionary.to_pylist()]
        codes = coded.indices.to_numpy(zero_copy_only=False)
        marked = [k for k, s in enumerate(special) if s is not None]
        codes = np.insert(codes, before[[k + 1 for k in marked]], np.arange(len(marked)) + len(distinct))
        distinct += [((self.added[special[k]],), special[k]) for k in marked]
        sizes = np.diff(before) + np.array([s is not None for s in special], np.int64)
        rows = np.concatenate([[0], np.cumsum(np.bincount(owner, weights=sizes, minlength=len(values)))]).astype(np.int64)
        ids, starts = Gathered([d[0] for d in distinct]).take(codes)
        strings = pa.array([d[1] for d in distinct], pa.string()).take(pa.array(codes))
        decoded = pc.binary_join(pa.ListArray.from_arrays(pa.array(rows.astype(np.int32)), strings), " ")
        return ids, starts[rows], decoded


def word_codec(path: str) -> WordCodec:
    """The codec of a Python worker."""
    held = kept_in_worker()
    if path not in held:
        held[path] = WordCodec(path)
    return held[path]


def encode_decode(docs: DataFrame, vocabulary: str = WORD_BPE) -> DataFrame:
    """Encode ``docs`` (doc_id, text) and decode the ids again.

    Returns (doc_id, n_tokens, ids, decoded); ids are little-endian unsigned 32-bit integers. No shuffle; a task holds
    one slice of a batch and the distinct units it remembers.
    """
    prepared(docs.sparkSession)

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = word_codec(vocabulary)
        for batch in batches:
            column = texts(batch.column(1))
            for begin, stop in slices(column):
                ids, bounds, decoded = codec.encode(column.slice(begin, stop - begin).to_pylist())
                yield pa.record_batch(
                    [
                        batch.column(0).slice(begin, stop - begin),
                        pa.array(np.diff(bounds)),
                        binaries(ids, bounds),
                        decoded,
                    ],
                    names=["doc_id", "n_tokens", "ids", "decoded"],
                )

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return source.mapInArrow(convert, "doc_id long, n_tokens long, ids binary, decoded string")
