"""SentencePiece encoding and decoding of merge-type (BPE) models, by backtracking over longest matches.

The library merges the pair of neighbours with the best score until none is left. The same ids come out of a search from the
left: an Aho-Corasick automaton gives the longest piece at each place; a piece may follow another if merging the two strings
together gives these two pieces again; if no piece can follow, the last one is taken back for a shorter one, and its end is
marked in a bitfield of places from which nothing leads to the end.

Merges never cross a place whose two characters are neighbours in no piece, as before every run of space marks. A text is cut
there into units, and a task encodes each distinct unit once. Pieces of several space marks share one score, below all others, where
the library merges from the left: that order depends on the place, so runs of space marks are merged directly, after the rest.

Null text is the empty text, whose only id is the end id. Characters outside the vocabulary become bytes; strings of control
pieces inside a text are plain characters; a space mark inside a text decodes as a space. Rows are independent: repeated rows
give repeated results, an empty table an empty one; extra columns are ignored.
"""

from __future__ import annotations

import codecs
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import PIECES, kept_in_worker, prepared, slices, texts
from ledgerloom.llm.pretokens import Gathered

SPACE = "▁"
UNKNOWN_TEXT = " ⁇ "
# Bytes that the units a task remembers may take (each with so many besides its characters), and the number of pairs of
# pieces; beyond that the memory starts anew.
REMEMBERED_BYTES, UNIT_BYTES, REMEMBERED_PAIRS = 96 << 20, 240, 500_000
# Longer units hardly come twice.
LONGEST_REMEMBERED = 64


def one_for_each_byte(error: UnicodeDecodeError) -> tuple[str, int]:
    return "\N{REPLACEMENT CHARACTER}" * (error.end - error.start), error.end


class PieceCodec:
    """Encodes and decodes as the library does with one model file: space marks, a mark before each text, byte fallback."""

    def __init__(self, path: str):
        library = sentencepiece.SentencePieceProcessor(model_file=path)
        count = library.get_piece_size()
        strings = [library.id_to_piece(i) for i in range(count)]
        special = [library.is_control(i) or library.is_unknown(i) or library.is_byte(i) for i in range(count)]
        probe = "  ﬁé Ω"  # nothing may be normalised, no space be dropped
        if library.decode(library.encode(probe)) != probe or any(library.is_unused(i) for i in range(count)):
            raise ValueError("only models without normalisation, with byte fallback and without unused pieces are supported")
        self.end = library.eos_id()
        self.ids = {s: i for i, s in enumerate(strings) if not special[i]}
        self.bytes = [library.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.score = {s: library.get_score(i) for s, i in self.ids.items() if len(s) > 1}
        words = [x for s, x in self.score.items() if s.strip(SPACE)]
        gaps = [x for s, x in self.score.items() if not s.strip(SPACE)]
        inner = any(SPACE in s[1:] for s in self.ids if s.strip(SPACE))
        if inner or len(set(words)) < len(words) or (gaps and words and max(gaps) >= min(words)):
            raise ValueError("space marks must stand first, scores differ, and runs of space marks come last")
        self.strings = strings
        self.raw = [s.replace(SPACE, " ").encode("utf-8") for s in strings]  # what each id stands for in a decoded text
        for b, i in enumerate(self.bytes):
            self.raw[i] = bytes([b])
        for i in range(count):
            if library.is_control(i):
                self.raw[i] = b""
            elif library.is_unknown(i):
                self.raw[i] = UNKNOWN_TEXT.encode("utf-8")
        # The same once more for the first id of a text, without the mark before the text.
        first = [r.removeprefix(b" ") if s[:1] == SPACE else r for r, s in zip(self.raw, strings)]
        self.raw_strings = pa.array([*self.raw, *first], pa.binary())
        self.silent = np.array([not r for r in self.raw])
        # Pairs of ASCII characters that stand side by side in a piece; a space stands for the space mark.
        self.beside = np.zeros((128, 128), bool)
        for s in self.ids:
            own = s.replace(SPACE, " ")
            for a, b in zip(own, own[1:]):
                if a.isascii() and b.isascii():
                    self.beside[ord(a), ord(b)] = True
        self.characters = {s for s in self.ids if len(s) == 1}
        codecs.register_error("one_for_each_byte", one_for_each_byte)
        self.automaton = ahocorasick.Automaton()
        for s, i in self.ids.items():
            if s == SPACE or s.strip(SPACE):
                self.automaton.add_word(s, (i, len(s)))
        self.automaton.make_automaton()
        self.shorter = [-1] * count  # the longest piece that a piece begins with
        for s, i in self.ids.items():
            self.shorter[i] = next((self.ids[s[:k]] for k in range(len(s) - 1, 0, -1) if s[:k] in self.ids), -1)
        self.size = [len(s) for s in strings]
        self.fits: dict[int, bool] = {}
        self.known: dict[str, tuple[int, ...]] = {}
        self.known_bytes = 0
        self.gaps: dict[int, tuple[int, ...]] = {}

    def merge(self, symbols: list[str]) -> list[str]:
        """Merge the neighbours with the best score, the leftmost of equals, until none can be merged."""
        symbols, score = list(symbols), self.score
        while len(symbols) > 1:
            best, place = None, -1
            for k in range(len(symbols) - 1):
                found = score.get(symbols[k] + symbols[k + 1])
                if found is not None and (best is None or found > best):
                    best, place = found, k
            if best is None:
                break
            symbols[place : place + 2] = [symbols[place] + symbols[place + 1]]
        return symbols

    def follows(self, last: int, piece: int) -> bool:
        """Whether merging the strings of two neighbours (or of one piece, after -1) gives the same pieces again."""
        key = (last + 1) * len(self.strings) + piece
        found = self.fits.get(key)
        if found is None:
            if len(self.fits) >= REMEMBERED_PAIRS:
                self.fits.clear()
            pieces = [self.strings[piece]] if last < 0 else [self.strings[last], self.strings[piece]]
            found = self.fits[key] = self.merge("".join(pieces)) == pieces
        return found

    def search(self, text: str) -> list[int]:
        """The ids of a text whose characters are all pieces, without runs of space marks."""
        n, shorter, size, count, fits = len(text), self.shorter, self.size, len(self.strings), self.fits
        longest = [-1] * (n + 1)
        for stop, (piece, length) in self.automaton.iter(text):
            longest[stop - length + 1] = piece  # longer matches of a place end later
        failed = bytearray((n >> 3) + 1)
        found: list[int] = []
        at, piece, last = 0, longest[0], -1
        while at < n:
            stop = at + size[piece]
            if not failed[stop >> 3] >> (stop & 7) & 1:
                fit = fits.get((last + 1) * count + piece)
                if fit or fit is None and self.follows(last, piece):
                    found.append(piece)
                    at, last, piece = stop, piece, longest[stop]
                    continue
            piece = shorter[piece]
            while piece < 0:  # nothing can follow here: take the last piece back for a shorter one
                failed[at >> 3] |= 1 << (at & 7)
                last = found.pop()
                at -= size[last]
                piece, last = shorter[last], found[-1] if found else -1
        return found

    def gap(self, marks: int) -> tuple[int, ...]:
        """The ids of a run of space marks. Merges from the left: the marks read so far form one piece as long as they can."""
        found = self.gaps.get(marks)
        if found is None:
            found = tuple([self.ids[s] for s in self.merge_gap(marks)])
            if marks <= LONGEST_REMEMBERED:
                self.gaps[marks] = found
        return found

    def merge_gap(self, marks: int) -> list[str]:
        """As ``merge`` on equal symbols of one score: the leftmost pair that makes a piece goes first, each time anew."""
        done: list[str] = []
        for _ in range(marks):
            done.append(SPACE)
            while len(done) > 1 and done[-2] + done[-1] in self.ids:
                done[-2:] = [done[-2] + done[-1]]
        return done

    def encode_unit(self, unit: str) -> tuple[int, ...]:
        """The ids of one unit: space marks, and what follows them."""
        rest = unit.lstrip(SPACE)
        marks = len(unit) - len(rest)
        if marks:
            rest = SPACE + rest
        if self.characters.issuperset(rest):
            found = self.search(rest)
        else:
            found, begin = [], 0
            for at, c in enumerate(rest):
                if c not in self.characters:
                    found += self.search(rest[begin:at])
                    found += [self.bytes[b] for b in c.encode("utf-8")]
                    begin = at + 1
            found += self.search(rest[begin:])
        if marks > 1 and self.strings[found[0]] == SPACE:
            return self.gap(marks) + tuple(found[1:])
        return self.gap(marks - 1) + tuple(found) if marks > 1 else tuple(found)

    def unit(self, unit: str) -> tuple[int, ...]:
        """The ids of one unit."""
        found = self.known.get(unit)
        if found is None:
            found = self.encode_unit(unit.replace(" ", SPACE))
            if len(unit) <= LONGEST_REMEMBERED:
                if self.known_bytes >= REMEMBERED_BYTES:
                    self.known.clear()
                    self.known_bytes = 0
                self.known[unit] = found
                self.known_bytes += UNIT_BYTES + len(unit)
        return found

    def units(self, values: list[str]) -> tuple[pa.Array, np.ndarray]:
        """The units of all texts in order, spaces for space marks, and the number of units before each text (one entry more)."""
        data = [b" " + v.replace(SPACE, " ").encode("utf-8") if v else b"" for v in values]
        before = np.cumsum([0, *map(len, data)])
        joined = np.frombuffer(b"".join(data), np.uint8)
        starts = np.zeros(len(joined), bool)
        if len(joined):
            starts[before[:-1][np.diff(before) > 0]] = True
            plain = joined < 0x80
            low = joined & 0x7F
            starts[1:] |= plain[:-1] & plain[1:] & ~self.beside[low[:-1], low[1:]]
            starts[1:] |= (joined[1:] == 0x20) & (joined[:-1] != 0x20)
        where = np.flatnonzero(starts)
        cuts = np.append(where, len(joined)).astype(np.int32)
        units = pa.Array.from_buffers(pa.string(), len(where), [None, pa.py_buffer(cuts), pa.py_buffer(joined)])
        return units, np.searchsorted(where, before)

    def encode(self, values: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, each closed by the end id, and the number of ids before each text (one entry more)."""
        units, before = self.units(values)
        coded = units.dictionary_encode()
        known = [self.unit(u) for u in coded.dictionary.to_pylist()]
        codes = coded.indices.to_numpy(zero_copy_only=False)
        codes = np.insert(codes, before[1:], len(known))  # the end id, behind the units of each text
        ids, starts = Gathered([*known, (self.end,)]).take(codes)
        return ids, starts[before + np.arange(len(before))]

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> pa.Array:
        """The texts of ranges of ids: vocabulary strings one after the other, without the mark before the text."""
        own = ids.astype(np.int32)
        loud = np.append(np.flatnonzero(~self.silent[own]), len(own))
        first = loud[np.searchsorted(loud, bounds[:-1])]
        own[first[first < bounds[1:]]] += len(self.strings)
        strings = self.raw_strings.take(pa.array(own))
        whole = pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), strings), b"")
        try:
            return whole.cast(pa.string())
        except pa.ArrowInvalid:  # bytes that form no character
            return pa.array([w.decode("utf-8", "one_for_each_byte") for w in whole.to_pylist()], pa.string())


def piece_codec(path: str) -> PieceCodec:
    """The codec of a Python worker."""
    held = kept_in_worker()
    if path not in held:
        held[path] = PieceCodec(path)
    return held[path]


def encode_decode(docs: DataFrame, model: str = PIECES) -> DataFrame:
    """Encode ``docs`` (doc_id, text) with an end id and decode the ids again.

    Returns (doc_id, ids array<int>, decoded). No shuffle; a task holds one slice of a batch and what it remembers.
    """
    prepared(docs.sparkSession)

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = piece_codec(model)
        for batch in batches:
            column = texts(batch.column("text"))
            for begin, stop in slices(column):
                ids, bounds = codec.encode(column.slice(begin, stop - begin).to_pylist())
                decoded = codec.decode(ids, bounds)
                lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids.astype(np.int32)))
                yield pa.record_batch(
                    [batch.column("doc_id").slice(begin, stop - begin), lists, decoded], names=["doc_id", "ids", "decoded"]
                )

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return source.mapInArrow(convert, "doc_id long, ids array<int>, decoded string")
