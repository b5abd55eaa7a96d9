"""Splitting texts into the units byte-pair merges stay within, on whole columns at once.

The byte-level vocabularies cut a text by a pattern before any merge. The pattern only looks at character classes, an
optional leading space and a few English endings, so a column of texts is cut with array operations over its characters.
"""

from __future__ import annotations

import unicodedata
from itertools import chain

import numpy as np
import pyarrow as pa

# The characters with the Unicode property White_Space.
WHITE_SPACE = (
    0x9, 0xA, 0xB, 0xC, 0xD, 0x20, 0x85, 0xA0, 0x1680, 0x2000, 0x2001, 0x2002, 0x2003, 0x2004, 0x2005, 0x2006, 0x2007,
    0x2008, 0x2009, 0x200A, 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)
# The endings the public patterns split off after an apostrophe.
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")

SPACE, LETTER, NUMBER, OTHER = 0, 1, 2, 3
LOW = 0x3000


def class_table(size: int) -> np.ndarray:
    """The class of each code point below ``size``."""
    kinds = {"L": LETTER, "N": NUMBER}
    found = np.fromiter(
        (kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(size)), dtype=np.uint8, count=size
    )
    found[[c for c in WHITE_SPACE if c < size]] = SPACE
    return found


class Splitter:
    """Cuts texts at the boundaries of a byte-level pattern.

    leading_space: a single space joins the run that follows it, and runs of white space are units of their own; else
    white space is dropped. single_numbers: every number character is a unit.
    """

    def __init__(self, leading_space: bool, single_numbers: bool):
        self.leading_space = leading_space
        self.single_numbers = single_numbers
        self.classes = class_table(LOW)

    def _classes(self, points: np.ndarray) -> np.ndarray:
        if len(points) and int(points.max()) >= len(self.classes):
            self.classes = class_table(0x110000)
        return self.classes[points]

    def split(self, values: list[str]) -> tuple[pa.Array, np.ndarray]:
        """The units of all texts in order, and for each text the number of units before it (one entry more at the end)."""
        lengths = np.fromiter(map(len, values), dtype=np.int64, count=len(values))
        ends = np.cumsum(lengths)
        data = "".join(values)
        points = np.frombuffer(data.encode("utf-32-le"), dtype=np.uint32)
        n = len(points)
        if not n:
            return pa.array([], pa.string()), np.zeros(len(values) + 1, np.int64)
        kinds = self._classes(points)
        first = np.zeros(n + 1, bool)
        first[(ends - lengths)] = True  # an empty last text points one past the end
        first[n] = True
        starts = np.empty(n, bool)
        starts[0] = True
        np.not_equal(kinds[1:], kinds[:-1], out=starts[1:])
        starts |= first[:n]
        if self.single_numbers:
            starts |= kinds == NUMBER
        if self.leading_space:
            after = np.flatnonzero(starts[1:] & ~first[1:n] & (kinds[:-1] == SPACE)) + 1
            starts[after - 1] = True
            starts[after[points[after - 1] == 0x20]] = False
        self._endings(points, kinds, starts, first)
        where = np.flatnonzero(starts)
        before = np.searchsorted(where, np.concatenate([ends - lengths, [n]]))
        width = 1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000)
        offsets = np.empty(n + 1, np.int64)
        offsets[0] = 0
        np.cumsum(width, out=offsets[1:])
        cuts = np.append(offsets[where], offsets[n]).astype(np.int32)
        units = pa.Array.from_buffers(
            pa.string(), len(where), [None, pa.py_buffer(cuts), pa.py_buffer(data.encode("utf-8"))]
        )
        if not self.leading_space:
            keep = kinds[where] != SPACE
            units = units.filter(pa.array(keep))
            before = np.concatenate([[0], np.cumsum(keep)])[before]
        return units, before

    def _endings(self, points: np.ndarray, kinds: np.ndarray, starts: np.ndarray, first: np.ndarray) -> None:
        """Split 's, 't, 're and so on off, where the apostrophe begins a unit and letters follow it directly."""
        n = len(points)
        at = np.flatnonzero((points == 0x27) & starts)
        at = at[at + 1 < n]
        at = at[(kinds[at + 1] == LETTER) & ~first[at + 1]]
        for i in at.tolist():
            for ending in ENDINGS:
                stop = i + 1 + len(ending)
                if (
                    stop <= n
                    and not first[i + 1 : stop].any()
                    and "".join(map(chr, points[i + 1 : stop])) == ending
                ):
                    starts[i + 1] = False
                    if stop < n:
                        starts[stop] = True
                    break


def letters_of_bytes() -> dict[int, str]:
    """The printable character that stands for each byte in a byte-level vocabulary.

    Printable bytes of Latin-1 stand for themselves; the rest, in order, for the code points from 256 on.
    """
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


BYTE_LETTERS = letters_of_bytes()


def as_letters(unit: str) -> str:
    """The UTF-8 bytes of a unit as vocabulary characters."""
    if not unit.isascii():
        unit = unit.encode("utf-8").decode("latin-1")
    return unit.translate(BYTE_LETTERS)


LETTER_POINTS = np.array([ord(BYTE_LETTERS[b]) for b in range(256)], "<u2")


def letter_units(units: pa.Array) -> list[str]:
    """The UTF-8 bytes of each of some units as vocabulary characters, mapped for all of them at once."""
    offsets = np.frombuffer(units.buffers()[1], np.int32)[units.offset : units.offset + len(units) + 1] if len(units) else [0]
    if not offsets[-1]:
        return [""] * len(units)
    data = np.frombuffer(units.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    letters, cuts = LETTER_POINTS[data].tobytes().decode("utf-16-le"), (offsets - offsets[0]).tolist()
    return [letters[a:b] for a, b in zip(cuts, cuts[1:])]


class Gathered:
    """Ids of many units, looked up by code: the ids of unit c are flat[first[c] : first[c] + count[c]]."""

    def __init__(self, entries: list[tuple[int, ...]]):
        self.count = np.fromiter(map(len, entries), dtype=np.int64, count=len(entries))
        self.first = np.cumsum(self.count) - self.count
        self.flat = np.fromiter(chain.from_iterable(entries), dtype=np.uint32, count=int(self.count.sum()))

    @classmethod
    def of_bytes(cls, entries: list[bytes]) -> Gathered:
        """The same for entries of little-endian unsigned 32-bit ids."""
        made = cls([])
        made.count = np.fromiter(map(len, entries), dtype=np.int64, count=len(entries)) // 4
        made.first = np.cumsum(made.count) - made.count
        made.flat = np.frombuffer(b"".join(entries), "<u4")
        return made

    def take(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the coded units one after the other, and the number of ids before each unit (one entry more)."""
        count = self.count[codes]
        before = np.concatenate([[0], np.cumsum(count)])
        index = np.arange(before[-1]) + np.repeat(self.first[codes] - before[:-1], count)
        return self.flat[index], before
