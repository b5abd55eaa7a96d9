"""Language identification by unigram pieces, summed over all segmentations.

The pieces come from a fixed public vocabulary. Each language has a probability for every piece; a word's probability under a
language is the sum over all ways to cut it into pieces, which a forward pass over the word gives. Piece probabilities are
learned by expectation-maximisation: a forward-backward pass gives the expected number of uses of each piece in the words of
the training documents, and a sum over all words gives the next probabilities. A text's score is the posterior
of the best language with equal priors, over all words of the whole text.

Training reads text and language only. It is bounded: a language with more than ``SAMPLE_DOCS`` training documents is
represented by about that many, chosen by a hash of the text; a language with fewer by all of them.

Null texts and texts without a letter are ``und`` with score 0, and so is every text if there is nothing to learn from. Ties go
to the first language in alphabetical order. Every row is scored, also rows that repeat a doc_id or have none.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from ledgerloom.llm.common import PIECES, prepared, slices, texts
from ledgerloom.llm.shingles import mixed
from ledgerloom.session import materialise

SAMPLE_DOCS = 3000
ROUNDS = 2
# The sample's words are few for Spark and costly to cut up, so they are dealt out to so many tasks.
EXPECTATION_TASKS = 64
# Added to every expected count.
SMOOTHING = 0.1
REMEMBERED = 200_000
UNDETERMINED = "und"
LETTER = re.compile(r"[^\W\d_]")
SPACE = "▁"  # stands before a word in the vocabulary
TINY = 1e-200
# Characters of a word whose sums are plain numbers; those of longer ones are scaled or logarithms.
LONG = 64
# Words whose segmentations a task holds at once, and characters of long ones; a longer word is held alone.
TOGETHER = 20_000
LONG_TOGETHER = 100_000


def vocabulary_pieces(path: str) -> list[str]:
    """The lower-case pieces of a vocabulary file, without control, byte and unknown pieces."""
    model = SentencePieceProcessor(model_file=path)
    normal = (
        model.IdToPiece(i)
        for i in range(model.GetPieceSize())
        if not (model.IsControl(i) or model.IsByte(i) or model.IsUnknown(i) or model.IsUnused(i))
    )
    return sorted({p for p in normal if p == p.lower()})


def words_of(column: pa.Array) -> pa.Array:
    """The words of each text, in lower case."""
    return pc.utf8_split_whitespace(pc.utf8_lower(column))


class Vocabulary:
    """The pieces by number, the last number being a lone character that is no piece, and a search for them in many words."""

    def __init__(self, pieces: list[str]):
        self.pieces = pieces
        self.number = {piece: k for k, piece in enumerate(pieces)}
        self.longest = max(map(len, pieces), default=1)
        # Every beginning of a piece by its hash, with the piece's number or -1: a search ends where none goes on.
        begun = {piece[:k]: -1 for piece in pieces for k in range(1, len(piece))} | self.number
        self.begun = begun
        points, starts = _points(list(begun))
        hashes = _Hashes(points).of(starts[:-1], starts[1:])
        order = np.argsort(hashes)
        self.hashes, self.numbers = hashes[order], np.fromiter(begun.values(), np.int64, len(begun))[order]

    def find(self, points: np.ndarray, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All pieces in a run of characters, none beyond ``limit`` (the end of a character's word): start, end, number."""
        hashes, alive, found = _Hashes(points), np.arange(len(points)), []
        for k in range(1, self.longest + 1):
            alive = alive[alive + k <= limit[alive]]
            own = hashes.of(alive, alive + k)
            at = np.minimum(np.searchsorted(self.hashes, own), len(self.hashes) - 1)
            number = np.where(self.hashes[at] == own, self.numbers[at], -2)
            if k == 1:
                number = np.where(number < 0, np.where(number == -2, -3, len(self.pieces)), number)
                lone = np.where(number == -3, len(self.pieces), number)
                found.append((alive, alive + 1, lone))
                alive = alive[number != -3]
                continue
            hit = number >= 0
            found.append((alive[hit], alive[hit] + k, number[hit]))
            alive = alive[number != -2]
        return tuple(np.concatenate(column) for column in zip(*found))


def _points(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The characters of all words one after the other, and the place where each begins (one entry more)."""
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.uint64)
    return points, np.concatenate([[0], np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))])


class _Hashes:
    """Hashes of any stretches of a run of characters that do not depend on where they stand."""

    BASE = 0x9E3779B97F4A7C15
    INVERSE = pow(BASE, -1, 1 << 64)

    def __init__(self, points: np.ndarray):
        powers = np.full(len(points) + 1, self.BASE, np.uint64)
        back = np.full(len(points) + 1, self.INVERSE, np.uint64)
        powers[0] = back[0] = 1
        self.back = np.cumprod(back)
        self.sums = np.zeros(len(points) + 1, np.uint64)
        np.cumsum((points + np.uint64(1)) * np.cumprod(powers)[:-1], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.back[start])


class Lattice:
    """All segmentations of many words: steps between the places of a word, by the place where they start.

    Place 0 of a word stands before its first character, its last place after the last one.
    """

    def __init__(self, words: list[str], vocabulary: Vocabulary):
        points, starts = _points([SPACE + word for word in words])
        sizes = np.diff(starts)
        word = np.repeat(np.arange(len(words)), sizes)
        begin, end, number = vocabulary.find(points, np.repeat(starts[1:], sizes))
        depth = begin - starts[word[begin]]
        order = np.lexsort((begin, depth))
        begin, end, self.number = begin[order], end[order], number[order]
        self.word = word[begin]
        self.start, self.end = begin + self.word, end + self.word
        self.first = starts[:-1] + np.arange(len(words))
        self.last = starts[1:] + np.arange(len(words))
        self.size = len(points) + len(words)
        self.cuts = np.searchsorted(depth[order], np.arange(int(sizes.max(initial=0)) + 1))

    def forward(self, shares: np.ndarray) -> np.ndarray:
        """For each place the summed probability of the ways to it; shares has one row for each step."""
        sums = np.zeros((self.size, shares.shape[1]))
        sums[self.first] = 1
        for a, b in zip(self.cuts[:-1], self.cuts[1:]):  # steps from one depth end in different places
            sums[self.end[a:b]] += sums[self.start[a:b]] * shares[a:b]
        return sums

    def backward(self, shares: np.ndarray) -> np.ndarray:
        """For each place the summed probability of the ways from it to the end; shares has one number for each step."""
        sums = np.zeros(self.size)
        sums[self.last] = 1
        for a, b in zip(self.cuts[-2::-1], self.cuts[:0:-1]):
            if a < b:
                own = self.start[a:b]
                first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
                sums[own[first]] = np.add.reduceat(sums[self.end[a:b]] * shares[a:b], first)
        return sums

    def log_forward(self, logs: np.ndarray) -> np.ndarray:
        """The logarithms of the sums that ``forward`` has; logs has one number for each step."""
        sums = np.full(self.size, -np.inf)
        sums[self.first] = 0
        for a, b in zip(self.cuts[:-1], self.cuts[1:]):
            sums[self.end[a:b]] = np.logaddexp(sums[self.end[a:b]], sums[self.start[a:b]] + logs[a:b])
        return sums

    def log_backward(self, logs: np.ndarray) -> np.ndarray:
        """The logarithms of the sums that ``backward`` has."""
        sums = np.full(self.size, -np.inf)
        sums[self.last] = 0
        for a, b in zip(self.cuts[-2::-1], self.cuts[:0:-1]):
            if a < b:
                own = self.start[a:b]
                first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
                sums[own[first]] = np.logaddexp.reduceat(sums[self.end[a:b]] + logs[a:b], first)
        return sums


class Pieces:
    """Piece probabilities for a fixed list of languages: one row for each piece and one for a lone character."""

    def __init__(self, vocabulary: Vocabulary, shares: np.ndarray):
        self.vocabulary, self.shares = vocabulary, shares

    def scores(self, words: list[str]) -> np.ndarray:
        """The logarithm of each word's probability in each language, summed over all segmentations."""
        found = np.zeros((len(words), self.shares.shape[1]))
        short = [k for k, word in enumerate(words) if len(word) <= LONG] if self.shares.shape[1] else []
        for at in range(0, len(short), TOGETHER):
            some = short[at : at + TOGETHER]
            with np.errstate(over="ignore", divide="ignore"):
                lattice = Lattice([words[k] for k in some], self.vocabulary)
                found[some] = np.log(lattice.forward(self.shares[lattice.number])[lattice.last])
        for k, word in enumerate(words):
            if len(word) > LONG or np.isneginf(found[k]).any():
                found[k] = self.score(word)
        return found

    def score(self, word: str) -> np.ndarray:
        """The same for one word of any length: sums are scaled before they get too small."""
        word, begun, longest = SPACE + word, self.vocabulary.begun, self.vocabulary.longest
        shares, shift = self.shares, np.zeros(self.shares.shape[1])
        window = [np.ones(self.shares.shape[1])]  # the sums at this place and the next ones
        for at in range(len(word)):
            window += [np.zeros(len(shift)) for _ in range(longest + 1 - len(window))]
            here = window[0]
            if here.min(initial=1.0) < TINY:  # each language gets a scale of its own
                window, shift = [sums / here for sums in window], shift + np.log(here)
                here = window[0]
            for k in range(1, min(longest, len(word) - at) + 1):
                number = begun.get(word[at : at + k])
                if k == 1 and (number is None or number < 0):
                    window[1] = window[1] + here * shares[-1]
                if number is None:
                    break
                if number >= 0:
                    window[k] = window[k] + here * shares[number]
            window.pop(0)
        return np.log(window[0]) + shift

    def uses(self, words: list[str], languages: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The expected number of uses of each piece in each language, summed over words with a language and a count.

        Nothing for a word whose probability is too small for a number; ``all_uses`` counts these as well.
        """
        return self._uses(words, languages, counts)[0]

    def all_uses(self, words: list[str], languages: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The same for every word.

        Words that are long, or whose probability is too small for a number, are counted by logarithms.
        """
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        short = np.flatnonzero(sizes <= LONG)
        total, left = self._uses([words[k] for k in short], languages[short], counts[short])
        rest = np.concatenate([short[left], np.flatnonzero(sizes > LONG)])
        rest = rest[np.argsort(sizes[rest], kind="stable")]
        held = np.cumsum(sizes[rest] + 1)
        for some in np.split(rest, np.flatnonzero(np.diff(held // LONG_TOGETHER)) + 1) if len(rest) else []:
            total += self._log_uses([words[k] for k in some], languages[some], counts[some])
        return total

    def _uses(self, words: list[str], languages: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The expected uses by plain numbers, and the words for which they are too small."""
        with np.errstate(over="ignore"):
            lattice = Lattice(words, self.vocabulary)
        shares = self.shares[lattice.number, languages[lattice.word]]
        forward, backward = lattice.forward(shares[:, None])[:, 0], lattice.backward(shares)
        whole = forward[lattice.last]
        weight = np.where(whole > TINY, counts / np.maximum(whole, TINY), 0.0)
        parts = forward[lattice.start] * shares * backward[lattice.end] * weight[lattice.word]
        return self._by_piece(lattice, languages, parts), np.flatnonzero(whole <= TINY)

    def _log_uses(self, words: list[str], languages: np.ndarray, counts: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            lattice = Lattice(words, self.vocabulary)
        logs = np.log(self.shares[lattice.number, languages[lattice.word]])
        forward, backward = lattice.log_forward(logs), lattice.log_backward(logs)
        whole = forward[lattice.last][lattice.word]
        parts = np.exp(forward[lattice.start] + logs + backward[lattice.end] - whole) * counts[lattice.word]
        return self._by_piece(lattice, languages, parts)

    def _by_piece(self, lattice: Lattice, languages: np.ndarray, parts: np.ndarray) -> np.ndarray:
        cell = lattice.number * self.shares.shape[1] + languages[lattice.word]
        return np.bincount(cell, parts, self.shares.size).reshape(self.shares.shape).astype(float)


def training_words(docs: DataFrame, sample_docs: int) -> DataFrame:
    """(lang, word, n) over a bounded sample of the labelled documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def rows() -> pa.RecordBatch:
            langs, words = zip(*counts)
            return pa.record_batch([pa.array(langs), pa.array(words), pa.array(counts.values())], names=["lang", "word", "n"])

        for batch in batches:
            langs = batch.column(0).to_pylist()
            for begin, stop in slices(batch.column(1)):
                words = words_of(batch.column(1).slice(begin, stop - begin)).to_pylist()
                for lang, own in zip(langs[begin:stop], words):
                    for word, n in Counter(own).items():
                        if word:
                            counts[lang, word] += n
            if len(counts) > REMEMBERED:
                yield rows()
                counts.clear()
        if counts:
            yield rows()

    labelled = docs.where("lang IS NOT NULL AND text IS NOT NULL")
    sizes = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}  # one row a language
    share = F.lit(1.0)
    for lang, size in sizes.items():
        if size > sample_docs:
            share = F.when(F.col("lang") == lang, F.lit(sample_docs / size)).otherwise(share)
    chosen = labelled.where(F.pmod(F.xxhash64("text"), F.lit(1_000_000)) < share * 1_000_000)
    counted = chosen.select("lang", "text").mapInArrow(count, "lang string, word string, n long")
    return counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))


class Scores:
    """The scores of the words a task has met."""

    def __init__(self, languages: int):
        self.languages = languages
        self.place: dict[str, int] = {}
        self.rows = np.zeros((0, languages))

    def of(self, words: list[str], pieces: Pieces) -> np.ndarray:
        """One row of scores for each of some distinct words; the empty word has none."""
        if len(self.place) + len(words) > REMEMBERED:
            self.place, self.rows = {}, np.zeros((0, self.languages))
        new = [word for word in words if word not in self.place]
        scores = pieces.scores(new)
        scores[[k for k, word in enumerate(new) if not word]] = 0
        self.place.update(zip(new, range(len(self.rows), len(self.rows) + len(new))))
        self.rows = np.concatenate([self.rows, scores])
        return self.rows[[self.place[word] for word in words]] if words else self.rows[:0]


Model = tuple[list[str], list[str], np.ndarray]


def train(docs: DataFrame, vocabulary: str = PIECES, sample_docs: int = SAMPLE_DOCS) -> Model:
    """The languages of ``docs`` (text, lang), the pieces, and the pieces' probabilities by language.

    What reaches the driver is one number for each language and piece.
    """
    spark = prepared(docs.sparkSession)
    words = training_words(docs.select("lang", "text"), sample_docs)
    words = materialise(words.repartition(EXPECTATION_TASKS, "lang", "word"), "training-words")
    langs = sorted(r["lang"] for r in words.select("lang").distinct().collect())
    pieces = vocabulary_pieces(vocabulary)
    shares = np.full((len(pieces) + 1, len(langs)), 1 / (len(pieces) + 1))
    for _ in range(ROUNDS if langs else 0):
        shared = spark.sparkContext.broadcast((pieces, shares))

        def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own, sums = Pieces(Vocabulary(shared.value[0]), shared.value[1]), np.zeros(shared.value[1].shape)
            for batch in batches:
                spoken = np.array([langs.index(lang) for lang in batch.column(0).to_pylist()], np.int64)
                sums += own.all_uses(batch.column(1).to_pylist(), spoken, batch.column(2).to_numpy())
            piece, lang = np.nonzero(sums)
            yield pa.record_batch([pa.array(piece), pa.array(lang), pa.array(sums[piece, lang])], names=["piece", "lang", "uses"])

        expected = words.mapInArrow(expect, "piece long, lang long, uses double")
        used = expected.groupBy("piece", "lang").agg(F.sum("uses").alias("uses")).toPandas()
        shared.unpersist()
        counts = np.full(shares.shape, SMOOTHING)
        np.add.at(counts, (used["piece"].to_numpy(), used["lang"].to_numpy()), used["uses"].to_numpy())
        shares = counts / counts.sum(axis=0)
        shares[-1] = (SMOOTHING / counts.sum(axis=0)).min()  # a character that is no piece says nothing about the language
    return langs, pieces, shares


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """(row, lang_pred, score) for each row of ``docs`` (text); ``row`` is the input row as a struct. No shuffle."""
    spark = prepared(docs.sparkSession)
    langs, pieces, shares = model
    shared = spark.sparkContext.broadcast((pieces, shares))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_pieces, known = Pieces(Vocabulary(shared.value[0]), shared.value[1]), Scores(len(langs))
        for batch in batches:
            column = texts(batch.column(1))
            for begin, stop in slices(column):
                own = column.slice(begin, stop - begin)
                lists = words_of(own)
                coded = lists.flatten().dictionary_encode()
                logs = known.of(coded.dictionary.to_pylist(), own_pieces)
                bounds = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))])
                found, sure = [], []
                codes = coded.indices.to_numpy(zero_copy_only=False)
                for text, a, b in zip(own.to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist()):
                    if not langs or not LETTER.search(text):
                        found.append(UNDETERMINED)
                        sure.append(0.0)
                        continue
                    total = logs[codes[a:b]].sum(axis=0)
                    best = int(total.argmax())
                    found.append(langs[best])
                    sure.append(float(1 / np.exp(total - total[best]).sum()))
                yield pa.record_batch(
                    [batch.column(0).slice(begin, stop - begin), pa.array(found, pa.string()), pa.array(sure, pa.float64())],
                    names=["row", "lang_pred", "score"],
                )

    source = docs.select(F.struct("*").alias("row"))
    kind = docs.schema.simpleString()
    return source.select("row", F.col("row.text").cast("string").alias("text")).mapInArrow(
        predict, f"row {kind}, lang_pred string, score double"
    )


def trained_on(docs: DataFrame, held_out: Column, **settings) -> Model:
    """A model of the labelled rows that are not held out."""
    return train(docs.where(~held_out), **settings)
