"""Word-shingle sets as sorted 64-bit hashes, and signatures of their fragments, on whole columns at once."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa

MIX = np.uint64(0x9E3779B97F4A7C15)
OTHER_MIX = np.uint64(0xD6E8FEB86659FD93)


def byte_kinds() -> np.ndarray:
    """For each byte its value with A-Z in lower case; 0 for white space, which no word holds (a zero byte counts as 256)."""
    kinds = np.arange(256, dtype=np.uint64)
    kinds[0] = 256
    kinds[65:91] += np.uint64(32)
    kinds[[9, 10, 11, 12, 13, 32]] = 0
    return kinds


BYTE_KINDS = byte_kinds()


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers (the splitmix64 finish)."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts in order (A-Z in lower case, cut at ASCII white space), and the number of words
    before each text (one entry more).

    A word's hash is the scrambled sum of scrambled (place, byte) pairs, computed for all bytes at once.
    """
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint64), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    offsets -= offsets[0]
    kinds = BYTE_KINDS[data]
    inside = kinds != 0
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    first[edges] = inside[edges]
    starts = np.flatnonzero(first)
    bounds = np.searchsorted(starts, offsets)
    at = np.flatnonzero(inside)
    number = np.cumsum(first[at]) - 1
    if not len(starts):
        return np.zeros(0, np.uint64), bounds
    place = (at - starts[number]).astype(np.uint64)
    marks = mixed((place << np.uint64(9) | kinds[at]) * MIX)
    return mixed(np.add.reduceat(marks, np.searchsorted(at, starts))), bounds


def shingle_sets(column: pa.Array, width: int) -> list[np.ndarray]:
    """For each text its distinct shingles of ``width`` words as ascending hashes; fewer words make one shingle."""
    words, bounds = word_hashes(column)
    n = max(len(words) - width + 1, 0)
    grams = np.full(n, width, np.uint64)
    for k in range(width):
        grams = mixed(grams * MIX + words[k : k + n])
    found = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a >= width:
            own = np.sort(grams[a : b - width + 1])
            keep = np.empty(len(own), bool)
            keep[0] = True
            np.not_equal(own[1:], own[:-1], out=keep[1:])
            found.append(own[keep])
        elif b > a:
            whole = np.full(1, b - a, np.uint64)
            for word in words[a:b]:
                whole = mixed(whole * MIX + word)
            found.append(whole)
        else:
            found.append(np.zeros(0, np.uint64))
    return found


def digest(own: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a whole set, as two signed numbers."""
    with np.errstate(over="ignore"):
        sums = [mixed(own ^ salt).sum(dtype=np.uint64) for salt in (MIX, OTHER_MIX)]
    return tuple(int(np.array(s, np.uint64).view(np.int64)) for s in sums)


def fragment(own: np.ndarray, fragments: int) -> np.ndarray:
    """The fragment of each hash when the order of all hashes is cut into equal ranges."""
    return ((own >> np.uint64(32)) * np.uint64(fragments) >> np.uint64(32)).astype(np.int64)


def size_bands(largest: int = 1 << 40) -> np.ndarray:
    """Lower ends of the bands of set sizes, each twice the one before."""
    ends = [1]
    while ends[-1] < largest:
        ends.append(2 * ends[-1])
    return np.array(ends)


BANDS = size_bands()
# Share of its fragments, the smallest ones, that no set of a band signs: a few members in common say little.
UNSIGNED = 0.3


def signatures(own: np.ndarray, percent: int) -> np.ndarray:
    """Numbers of which two different sets with a Jaccard similarity of ``percent`` (50 at least) or more share at least one.

    Sets x and y that similar differ in at most (|x| + |y|) (100 - percent) / (100 + percent) members, d. If the order of all members is
    cut into c fragments, at least c - d of them hold the same members in both. A set whose partners can differ from it in at most e
    members signs its e + 1 largest fragments (ties by place): the other c - e - 1 are fewer than the fragments in common, so the largest
    in common is not among them. That holds for both sets, with their own e, so both sign it. c depends on the larger set's size
    band; e on the largest partner that a set can have there. A set close to the next band also signs for that one.
    """
    n = len(own)
    if not n:
        return own
    band, found = int(np.searchsorted(BANDS, n, side="right")) - 1, []
    scrambled = mixed(own)
    for b in (band, band + 1):
        if b > band and 100 * n < percent * int(BANDS[b]):
            break
        largest = int(BANDS[b + 1]) - 1
        differing = (n + min(largest, 100 * n // percent)) * (100 - percent) // (100 + percent)
        if not differing:
            continue
        count = math.ceil((2 * largest * (100 - percent) // (100 + percent) + 1) / (1 - UNSIGNED))
        place = fragment(own, count)
        first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        sums, places = np.add.reduceat(scrambled, first), place[first]
        held = np.diff(np.append(first, n))
        if len(first) < differing + 1:  # fewer fragments have members than must be signed: empty ones count as well
            empty = np.setdiff1d(np.arange(count), places)
            places, sums = np.concatenate([places, empty]), np.concatenate([sums, np.zeros(len(empty), np.uint64)])
            held = np.concatenate([held, np.zeros(len(empty), held.dtype)])
        signed = np.lexsort((places, held))[len(held) - differing - 1 :]
        sums, places = sums[signed], places[signed]
        found.append(mixed(sums + mixed(places.astype(np.uint64) * MIX + np.uint64(b))))
    return np.concatenate(found) if found else own[:0]


def parities(own: np.ndarray) -> np.ndarray:
    """One bit for each low end of a hash, set if an odd number of members has it: 2 to 4 bits a member, packed in bytes."""
    width = 64
    while width < 2 * len(own):
        width *= 2
    return np.packbits(np.bincount((own & np.uint64(width - 1)).astype(np.int64), minlength=width).astype(np.uint8) & 1)


def can_reach(bits: list[list[bytes]], sizes: list[np.ndarray], percent: int) -> np.ndarray:
    """Which pairs of sets with these parities and sizes (a list for either side) can have a Jaccard similarity of ``percent``.

    Each bit that differs stands for a member of its own that only one of the sets has, so a similar pair is never ruled out.
    Pairs are worked on together by the widths of their parities.
    """
    a, b = sizes
    keep = percent * np.maximum(a, b) <= 100 * np.minimum(a, b)
    kinds: dict[tuple[int, int], list[int]] = {}
    for k in np.flatnonzero(keep).tolist():
        kinds.setdefault((len(bits[0][k]), len(bits[1][k])), []).append(k)
    for widths, own in kinds.items():
        width = min(widths)
        folded = [
            np.bitwise_xor.reduce(np.frombuffer(b"".join([side[k] for k in own]), np.uint8).reshape(len(own), -1, width), axis=1)
            for side in bits
        ]
        differing = np.bitwise_count(folded[0] ^ folded[1]).sum(axis=1, dtype=np.int64)
        keep[own] = differing * (100 + percent) <= (a[own] + b[own]) * (100 - percent)
    return keep
