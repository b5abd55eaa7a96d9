"""Fill-in-middle transformation: a text is cut twice and its middle moved to the end, behind control strings.

A text is cut into units (code points, or what a pattern matches). Its UTF-8 bytes fall into blocks of fixed size; a Fenwick
tree over the blocks counts units and code points. To cut after k units, a descent by binary lifting finds the block that holds
the cut, and the units that start inside this one block give the place.

Forms: ``plain`` is the text itself; ``psm`` is prefix, suffix, middle; ``spm`` is suffix, prefix, middle, each part behind its
control string. A text that is empty or holds a control string stays plain, so every output can be taken apart again.

Null text counts as empty. A null id draws as an empty id. Rows are independent: repeated rows and ids give repeated
results, an empty table an empty one; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import prepared, slices, texts

BLOCK_BYTES = 1024
# Control strings before prefix, suffix and middle.
MARKS = ("<P>", "<S>", "<M>")
PLAIN, PREFIX_FIRST, SUFFIX_FIRST = "plain", "psm", "spm"


class BlockCounts:
    """A Fenwick tree over the blocks of one text, with the units and the code points that start in each block."""

    def __init__(self, unit_starts: np.ndarray, point_starts: np.ndarray, block: int = BLOCK_BYTES):
        """Both arguments mark for each byte of the text whether a unit or a code point starts there."""
        self.unit_starts, self.point_starts, self.block = unit_starts, point_starts, block
        edges = np.arange(0, len(unit_starts), block)
        self.blocks = len(edges)
        self.tree = np.zeros((self.blocks + 1, 2), np.int64)
        if self.blocks:
            counts = [np.add.reduceat(marks, edges, dtype=np.int64) for marks in (unit_starts, point_starts)]
            before = np.concatenate([np.zeros((1, 2), np.int64), np.cumsum(np.stack(counts, 1), axis=0)])
            nodes = np.arange(1, self.blocks + 1)
            self.tree[1:] = before[nodes] - before[nodes - (nodes & -nodes)]
        self.sums = self.tree.tolist()

    def totals(self) -> tuple[int, int]:
        """Units and code points of the whole text."""
        units = points = 0
        node = self.blocks
        while node:
            units, points = units + self.sums[node][0], points + self.sums[node][1]
            node &= node - 1
        return units, points

    def cut(self, k: int) -> tuple[int, int]:
        """The byte where the unit after the first ``k`` starts, and the code points before it; past the last one, the end."""
        if not k:
            return 0, 0
        node, points, left = 0, 0, k
        step = 1 << self.blocks.bit_length()
        while step := step >> 1:
            further = node + step
            if further <= self.blocks and self.sums[further][0] <= left:
                node = further
                left -= self.sums[node][0]
                points += self.sums[node][1]
        if node == self.blocks:
            return len(self.unit_starts), points
        first = node * self.block
        inside = int(np.flatnonzero(self.unit_starts[first : first + self.block])[left])
        return first + inside, points + int(np.count_nonzero(self.point_starts[first : first + inside]))


def starts_of(text: bytes, points: np.ndarray, unit: re.Pattern | None) -> np.ndarray:
    """Marks the bytes where a unit starts; without a pattern every code point is one."""
    if unit is None:
        return points
    marks = np.zeros(len(points), bool)
    found = [m.start() for m in unit.finditer(text.decode("utf-8")) if m.end() > m.start()]
    marks[np.flatnonzero(points)[found]] = True
    return marks


def check_marks(marks: tuple[str, str, str]) -> None:
    """Control strings must not overlap themselves or one another, or an output could not be taken apart."""
    for x, a in enumerate(marks):
        for y, b in enumerate(marks):
            overlaps = any(a.endswith(b[:k]) for k in range(1, min(len(a), len(b))))
            if not a or overlaps or (x != y and a in b):
                raise ValueError(f"control strings overlap: {marks}")


def draws(key: Column, seed: str) -> list[Column]:
    """Four numbers of 32 bits from the digest of seed and key."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def fill_in_middle(
    docs: DataFrame,
    seed: str = "1",
    plain_percent: int = 10,
    suffix_first_percent: int = 20,
    unit: str | None = None,
    marks: tuple[str, str, str] = MARKS,
) -> DataFrame:
    """Transform ``docs`` (doc_id, text).

    Of ids that are drawn, ``plain_percent`` of 100 stay plain and ``suffix_first_percent`` of the others put the suffix first; the
    draws depend on seed and id only. ``unit`` is a pattern for the units, matched from left to right over code points; what lies
    between two matches goes with the unit before it. Returns (doc_id, n, form, prefix_chars, middle_chars, output):
    ``n`` counts units, the lengths are code points, null for plain texts. No shuffle; a task holds one slice of a batch.
    """
    check_marks(marks)
    prepared(docs.sparkSession)
    pattern = None if unit is None else re.compile(unit, re.DOTALL)
    before_prefix, before_suffix, before_middle = (m.encode("utf-8") for m in marks)

    def parts(text: bytes, points: np.ndarray, h1: int, h2: int, plain: bool, suffix_first: bool) -> tuple:
        counts = BlockCounts(starts_of(text, points, pattern), points)
        n, _ = counts.totals()
        if plain or not text or before_prefix in text or before_suffix in text or before_middle in text:
            return n, PLAIN, None, None, text
        low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
        (a, a_points), (b, b_points) = counts.cut(low), counts.cut(high)
        prefix, middle, suffix = text[:a], text[a:b], text[b:]
        if suffix_first:
            out = (before_suffix, suffix, before_prefix, prefix, before_middle, middle)
        else:
            out = (before_prefix, prefix, before_suffix, suffix, before_middle, middle)
        return n, SUFFIX_FIRST if suffix_first else PREFIX_FIRST, a_points, b_points - a_points, b"".join(out)

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = texts(batch.column("text"))
            drawn = [batch.column(f"h{k}").to_numpy() for k in (1, 2, 3, 4)]
            plain = drawn[2] % 100 >= 100 - plain_percent
            suffix_first = drawn[3] % 100 < suffix_first_percent
            for begin, stop in slices(column):
                found = []
                for row in range(begin, stop):
                    text = column[row].as_buffer().to_pybytes()
                    points = (np.frombuffer(text, np.uint8) & 0xC0) != 0x80
                    found.append(parts(text, points, int(drawn[0][row]), int(drawn[1][row]), plain[row], suffix_first[row]))
                n, form, prefix_chars, middle_chars, out = zip(*found)
                yield pa.record_batch(
                    [
                        batch.column("doc_id").slice(begin, stop - begin),
                        pa.array(n, pa.int64()),
                        pa.array(form, pa.string()),
                        pa.array(prefix_chars, pa.int64()),
                        pa.array(middle_chars, pa.int64()),
                        pa.array(out, pa.binary()).cast(pa.string()),
                    ],
                    names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
                )

    source = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        *(h.alias(f"h{k}") for k, h in enumerate(draws(F.col("doc_id"), seed), 1)),
    )
    return source.mapInArrow(
        convert, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
    )


def restored(output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The text an output was made from: each control string stands in it once."""
    before_prefix, before_suffix, before_middle = marks

    def split(whole: Column, mark: str) -> tuple[Column, Column]:
        return F.substring_index(whole, mark, 1), F.substring_index(whole, mark, -1)

    head, tail = split(output, before_suffix)
    suffix, middle = split(tail, before_middle)
    from_prefix_first = F.concat(F.substring_index(head, before_prefix, -1), middle, suffix)
    head, tail = split(output, before_prefix)
    prefix, middle = split(tail, before_middle)
    from_suffix_first = F.concat(prefix, middle, F.substring_index(head, before_suffix, -1))
    return F.when(form == PLAIN, output).when(form == PREFIX_FIRST, from_prefix_first).otherwise(from_suffix_first)
