"""Periodic run detection: stretches of words that repeat with a period, found by longest common extensions.

A run is a stretch of consecutive words with smallest period q (words q apart are equal) and a length of at least 6 words and
four periods, which no neighbouring word extends.

Where a run can lie is narrowed first, by a condition that every run meets: all its word triples but the last q come again
within q words. The words of such a zone and of its reversal go into Ukkonen suffix trees. An Euler tour of a tree with a
table of minima gives the lowest common ancestor of two leaves, so the longest common extension of two places, in constant
time. For both orders of the words the longest Lyndon word at each place ends where the next smaller suffix starts; it is the
root of a candidate, which is extended in both directions.

Null text has no words. Words are compared exactly (case counts). Rows are independent: repeated rows give repeated results,
an empty table an empty one; extra columns are ignored. A zone longer than WINDOW is searched in overlapping windows of at least
16 times its longest possible period; what touches the edge of a window is extended beyond it word by word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import prepared, slices, texts

LEAST_WORDS, LEAST_PERIODS = 6, 4
# Words of which a stretch must come again within a period.
GRAM = 3
# Words of a zone that one pair of trees covers.
WINDOW = 1 << 15
BLANKS = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
MIX = np.uint64(0x9E3779B97F4A7C15)


def least_length(period: int) -> int:
    return max(LEAST_WORDS, LEAST_PERIODS * period)


class SuffixTree:
    """Ukkonen's tree over a list of numbers >= 0, closed by a smaller end mark."""

    def __init__(self, values: list[int]):
        text = [v + 1 for v in values] + [0]
        n = len(text)
        width = max(text) + 1
        # Edges are found by node * width + first symbol; an edge ends at the node it leads to.
        edges: dict[int, int] = {}
        first, last, link = [0], [0], [0]  # of a node's edge: text[first:last]; leaves end at n
        node, at, length = 0, 0, 0  # the active point: below node, along text[at], so many symbols
        waiting = 0
        for i in range(n):
            symbol = text[i]
            waiting += 1
            joint = 0
            while waiting:
                if not length:
                    at = i
                key = node * width + text[at]
                child = edges.get(key)
                if child is None:
                    edges[key] = len(first)
                    first.append(i)
                    last.append(n)
                    link.append(0)
                    if joint:
                        link[joint] = node
                        joint = 0
                else:
                    begin = first[child]
                    size = last[child] - begin
                    if last[child] == n:
                        size = i + 1 - begin
                    if length >= size:
                        node, at, length = child, at + size, length - size
                        continue
                    if text[begin + length] == symbol:
                        length += 1
                        if joint:
                            link[joint] = node
                        break
                    middle = len(first)
                    first.append(begin)
                    last.append(begin + length)
                    link.append(0)
                    edges[key] = middle
                    first[child] = begin + length
                    edges[middle * width + text[begin + length]] = child
                    edges[middle * width + symbol] = len(first)
                    first.append(i)
                    last.append(n)
                    link.append(0)
                    if joint:
                        link[joint] = middle
                    joint = middle
                waiting -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    at = i - waiting + 1
        self.size, self.width, self.edges, self.first, self.last = n, width, edges, first, last


class Extensions:
    """Longest common extensions of the suffixes of a list, and the order of its suffixes."""

    def __init__(self, values: list[int]):
        tree = SuffixTree(values)
        n, first, last = tree.size, tree.first, tree.last
        below: list[list[int]] = [[] for _ in first]
        for key in sorted(tree.edges, reverse=True):  # so that the smallest symbol is taken first from the end
            below[key // tree.width].append(tree.edges[key])
        depth = [0] * len(first)
        tour, seen, ranks = [0], [0] * n, [0] * n
        path, found = [0], 0
        while path:
            node = path[-1]
            if below[node]:
                child = below[node].pop()
                depth[child] = depth[node] + last[child] - first[child]
                path.append(child)
                tour.append(depth[child])
                if last[child] == n:  # a leaf: no inner node's edge reaches the end mark
                    place = n - depth[child]
                    seen[place], ranks[place] = len(tour) - 1, found
                    found += 1
            else:
                path.pop()
                if path:
                    tour.append(depth[path[-1]])
        self.ranks = ranks
        self.seen = np.array(seen, np.int64)
        self.minima = [np.array(tour, np.int32)]
        step = 1
        while 2 * step <= len(tour):
            own = self.minima[-1]
            self.minima.append(np.minimum(own[:-step], own[step:]))
            step *= 2

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The number of symbols that the suffixes at two different places share, for many pairs of places."""
        x, y = self.seen[a], self.seen[b]
        low, high = np.minimum(x, y), np.maximum(x, y)
        level = np.frexp((high - low + 1).astype(np.float64))[1] - 1
        shared = np.empty(len(low), np.int64)
        for k in np.unique(level).tolist():
            own = level == k
            shared[own] = np.minimum(self.minima[k][low[own]], self.minima[k][high[own] + 1 - (1 << k)])
        return shared


def next_beyond(ranks: list[int], sign: int) -> list[int]:
    """For each suffix the next one to the right that is smaller (sign 1) or larger (sign -1); the length if none."""
    n = len(ranks)
    found, stack = [n] * n, []
    for i, rank in enumerate(ranks):
        rank *= sign
        while stack and stack[-1][0] > rank:
            found[stack.pop()[1]] = i
        stack.append((rank, i))
    return found


def runs_of(values: list[int]) -> list[tuple[int, int, int]]:
    """The runs of a list of numbers >= 0 as (start, length, period), ascending."""
    n = len(values)
    if n < LEAST_WORDS:
        return []
    forward, backward = Extensions(values), Extensions(values[::-1])
    places = np.arange(n)
    found = []
    for sign in (1, -1):
        after = np.array(next_beyond(forward.ranks[:n], sign))
        i = places[after < n]
        j = after[after < n]
        right = forward.common(i, j)
        left = np.zeros(len(i), np.int64)
        inner = i > 0
        left[inner] = backward.common(n - i[inner], n - j[inner])
        period = j - i
        length = period + left + right
        long = length >= np.maximum(LEAST_WORDS, LEAST_PERIODS * period)
        found.append(np.stack([i - left, length, period], 1)[long])
    return [tuple(run) for run in np.unique(np.concatenate(found), axis=0).tolist()]


def extent(codes: np.ndarray, start: int, stop: int, period: int) -> tuple[int, int]:
    """The longest stretch around codes[start:stop] that keeps the period."""
    step = 64
    while start:
        low = max(0, start - step)
        differs = np.flatnonzero(codes[low:start] != codes[low + period : start + period])
        if len(differs):
            start = low + int(differs[-1]) + 1
            break
        start, step = low, 2 * step
    step = 64
    while stop < len(codes):
        high = min(len(codes), stop + step)
        differs = np.flatnonzero(codes[stop:high] != codes[stop - period : high - period])
        if len(differs):
            stop += int(differs[0])
            break
        stop, step = high, 2 * step
    return start, stop


def zone_runs(codes: np.ndarray, reach: int, window: int = WINDOW) -> list[tuple[int, int, int]]:
    """The runs of a zone with periods of at most ``reach`` words, as (start, length, period)."""
    window = max(window, 16 * reach)
    if len(codes) <= window:
        return runs_of(np.unique(codes, return_inverse=True)[1].tolist())
    found: dict[int, list[tuple[int, int]]] = {}
    # Windows overlap by half: four periods of any run lie within one of them.
    for begin in range(0, len(codes) - window // 2, window // 2):
        own = codes[begin : begin + window]
        for start, length, period in runs_of(np.unique(own, return_inverse=True)[1].tolist()):
            a, b = begin + start, begin + start + length
            known = found.setdefault(period, [])
            if known and known[-1][0] <= a and b <= known[-1][1]:
                continue
            span = extent(codes, a, b, period)
            if span not in known[-2:]:
                known.append(span)
    return sorted({(a, b - a, period) for period, spans in found.items() for a, b in spans})


def words_of(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of all texts in order, cut at ASCII white space, and the number of words before each text (one entry more)."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    size = int(offsets[-1] - offsets[0])
    if not size:
        return pa.array([], pa.binary()), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    offsets -= offsets[0]
    inside = ~BLANKS[data]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    edges = offsets[:-1][offsets[:-1] < size]
    starts[edges] = inside[edges]
    own = np.flatnonzero(starts[inside])
    cuts = np.append(own, np.count_nonzero(inside)).astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), len(own), [None, pa.py_buffer(cuts), pa.py_buffer(data[inside])])
    return words, np.searchsorted(np.flatnonzero(starts), offsets)


def again_after(codes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """For each word of each text the distance to the next place of the text with the same triple of words; 0 if none."""
    n = len(codes) - GRAM + 1
    gaps = np.zeros(len(codes), np.int64)
    if n < 2:
        return gaps
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    whole = owner[:n] == owner[GRAM - 1 :]
    with np.errstate(over="ignore"):
        grams = owner[:n].astype(np.uint64)
        for k in range(GRAM):
            grams = (grams + codes[k : k + n].astype(np.uint64) + np.uint64(1)) * MIX
            grams ^= grams >> np.uint64(29)
    places = np.flatnonzero(whole)
    order = places[np.argsort(grams[places], kind="stable")]
    same = (grams[order[1:]] == grams[order[:-1]]) & (owner[order[1:]] == owner[order[:-1]])
    gaps[order[:-1][same]] = np.diff(order)[same]
    return gaps


def zones(gaps: np.ndarray, bounds: np.ndarray) -> list[tuple[int, int, int]]:
    """Disjoint (start, stop, longest possible period) of word ranges outside which no run lies, with a word more at both ends.

    In a run of period q all triples but those that start in its last q + 2 words come again within q words. Periods are
    taken together from one power of two to the next.
    """
    found = []
    repeated = np.flatnonzero(gaps)
    if not len(repeated):
        return []
    near = gaps[repeated]
    reach, shortest = 1, 1
    longest = int(np.diff(bounds).max()) // LEAST_PERIODS
    while shortest <= longest:
        places = repeated[near <= reach]
        if len(places):
            breaks = np.flatnonzero(np.diff(places) > 1)
            first = places[np.concatenate([[0], breaks + 1])]
            last = places[np.concatenate([breaks, [len(places) - 1]])]
            enough = last - first + 1 >= least_length(shortest) - shortest - GRAM + 1
            found += [(a - 1, b + 1 + reach + GRAM, reach) for a, b in zip(first[enough].tolist(), last[enough].tolist())]
        shortest, reach = reach + 1, 2 * reach
    joined: list[list[int]] = []
    for a, b, reach in sorted(found):
        text = int(np.searchsorted(bounds, a + 1, side="right")) - 1
        a, b = max(a, int(bounds[text])), min(b, int(bounds[text + 1]))
        if joined and a < joined[-1][1]:
            joined[-1][1:] = max(b, joined[-1][1]), max(reach, joined[-1][2])
        else:
            joined.append([a, b, reach])
    return [tuple(zone) for zone in joined]


def text_runs(codes: np.ndarray, bounds: np.ndarray) -> list[list[tuple[int, int, int]]]:
    """The runs of each text, ascending."""
    found: list[list[tuple[int, int, int]]] = [[] for _ in bounds[1:]]
    for a, b, reach in zones(again_after(codes, bounds), bounds):
        text = int(np.searchsorted(bounds, a, side="right")) - 1
        first = a - int(bounds[text])
        found[text] += [(first + s, length, period) for s, length, period in zone_runs(codes[a:b], reach)]
    return [sorted(own, key=lambda run: (run[0], run[2])) for own in found]


RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def periodic_runs(docs: DataFrame) -> DataFrame:
    """The runs of each text of ``docs`` (doc_id, text), and the text without their repetitions.

    Returns (doc_id, n_words, runs, collapsed): ``runs`` are structs of start, length and period by start and period;
    ``collapsed`` joins with one space the words that no run holds after its first period. No shuffle; a task holds one
    slice of a batch.
    """
    prepared(docs.sparkSession)

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = texts(batch.column("text"))
            for begin, stop in slices(column):
                words, bounds = words_of(column.slice(begin, stop - begin))
                codes = words.dictionary_encode().indices.to_numpy(zero_copy_only=False)
                runs = text_runs(codes, bounds)
                change = np.zeros(len(codes) + 1, np.int64)
                for first, own in zip(bounds.tolist(), runs):
                    for start, length, period in own:
                        change[first + start + period] += 1
                        change[first + start + length] -= 1
                keep = np.cumsum(change)[:-1] == 0
                left = np.concatenate([[0], np.cumsum(keep)])[bounds].astype(np.int32)
                kept = pa.ListArray.from_arrays(pa.array(left), words.filter(pa.array(keep)).cast(pa.string()))
                flat = [run for own in runs for run in own]
                marks = np.cumsum([0, *map(len, runs)]).astype(np.int32)
                fields = [pa.array([run[k] for run in flat], pa.int64()) for k in range(3)]
                yield pa.record_batch(
                    [
                        batch.column("doc_id").slice(begin, stop - begin),
                        pa.array(np.diff(bounds), pa.int64()),
                        pa.ListArray.from_arrays(pa.array(marks), pa.StructArray.from_arrays(fields, fields=list(RUN))),
                        pc.binary_join(kept, " "),
                    ],
                    names=["doc_id", "n_words", "runs", "collapsed"],
                )

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    run = "struct<start: bigint, length: bigint, period: bigint>"
    return source.mapInArrow(convert, f"doc_id long, n_words long, runs array<{run}>, collapsed string")


def with_planted_runs(key: Column, text: Column) -> Column:
    """The text, or for a tenth of all ids its words from some place on replaced by a repeated part of them.

    Place, period and choice follow the crc32 of the id as text; a null id counts as the empty text.
    """
    h = F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    g = F.floor(h / 10)
    words = F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    n = F.size(words)
    a = (g % n).cast("int")
    period = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    repeated = F.flatten(F.array_repeat(F.slice(words, a + 1, period), F.ceil((n - a) / period).cast("int")))
    planted = F.array_join(F.concat(F.slice(words, F.lit(1), a), F.slice(repeated, F.lit(1), n - a)), " ")
    return F.when((h % 10 != 0) | text.isNull() | (n < 1), text).otherwise(planted)


def digests(found: DataFrame) -> DataFrame:
    """One row a document: the number of runs, the run with the greatest length in periods, and digests of runs and text.

    Of runs with equal exponents the one with the smallest start, then period, comes first.
    """
    best = F.aggregate(
        F.slice("runs", 2, F.greatest(F.size("runs"), F.lit(1))),
        F.get("runs", F.lit(0)),
        lambda top, run: F.when(run["length"] * top["period"] > top["length"] * run["period"], run).otherwise(top),
    )
    line = lambda run: F.concat_ws(",", run["start"], run["length"], run["period"])
    listed = F.concat_ws("", F.transform("runs", lambda run: F.concat(line(run), F.lit("\n"))))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("_best"), listed.alias("_listed"), "collapsed"
    ).select(
        "doc_id",
        "n_runs",
        "_best.start",
        "_best.length",
        "_best.period",
        F.floor(1000 * F.col("_best.length") / F.col("_best.period")).alias("exponent_milli"),
        F.sha2(F.col("_listed").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
