"""Language identification and language-model scores: brute force, held-out quality, special cases."""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import language, maxent
from ledgerloom.llm.common import fold
from tests.llm import brute
from tests.llm.helpers import CASES, docs


def remainder(doc_id, parts):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % parts


NAMES = ["▁", "a", "b", "ab", "▁a", "aba", "▁ab", "ba", "▁zzx", "bcde"]


def segmentations(word):
    """Every way to cut a word into pieces and lone characters that are none, by piece number."""
    if not word:
        yield ()
    for k in range(1, len(word) + 1):
        if word[:k] in NAMES or k == 1:
            number = NAMES.index(word[:k]) if word[:k] in NAMES else len(NAMES)
            for rest in segmentations(word[k:]):
                yield (number, *rest)


def pieces():
    shares = np.random.default_rng(0).random((len(NAMES) + 1, 2)) / 5
    return language.Pieces(language.Vocabulary(NAMES), shares)


WORDS = ["", "a", "abab", "xabay", "abababab", "zzz", "zzxa", "b", "bcd", "日本a"]


def test_scores_sum_over_all_segmentations():
    own = pieces()
    together = own.scores(WORDS)
    for word, found in zip(WORDS, together):
        for k in range(2):
            cuts = [math.prod(own.shares[p][k] for p in cut) for cut in segmentations(language.SPACE + word)]
            assert math.isclose(found[k], math.log(sum(cuts)), rel_tol=1e-12)
            assert math.isclose(own.score(word)[k], math.log(sum(cuts)), rel_tol=1e-12)


def test_uses_are_expected_over_all_segmentations():
    own = pieces()
    languages, counts = np.arange(len(WORDS)) % 2, np.arange(len(WORDS)) + 1
    wanted = np.zeros(own.shares.shape)
    for word, k, n in zip(WORDS, languages, counts):
        cuts = {cut: math.prod(own.shares[p][k] for p in cut) for cut in segmentations(language.SPACE + word)}
        for cut, p in cuts.items():
            for piece in cut:
                wanted[piece, k] += n * p / sum(cuts.values())
    assert np.allclose(own.uses(WORDS, languages, counts), wanted)


def test_uses_of_long_and_unlikely_words(monkeypatch):
    own = pieces()
    languages, counts = np.arange(len(WORDS)) % 2, np.arange(len(WORDS)) + 1
    wanted = own.uses(WORDS, languages, counts)
    assert np.allclose(own.all_uses(WORDS, languages, counts), wanted)
    monkeypatch.setattr(language, "LONG", 2)
    monkeypatch.setattr(language, "LONG_TOGETHER", 9)
    assert np.allclose(own.all_uses(WORDS, languages, counts), wanted)
    monkeypatch.undo()
    unlikely = language.Pieces(own.vocabulary, own.shares * 1e-40)
    lone = unlikely.all_uses(["zzzzzzz"], np.zeros(1, np.int64), np.array([3]))  # about 1e-320: no plain number
    assert np.isclose(lone[len(NAMES), 0], 3 * 7) and np.isclose(lone[0, 0], 3)
    long = own.all_uses(["zq" * 3000], np.ones(1, np.int64), np.array([2]))
    assert np.isclose(long[len(NAMES), 1], 2 * 6000)


def test_language_learns_from_texts_without_spaces(spark):
    rng = np.random.default_rng(0)
    letters = {"ja": list("のにはをたがでてとし"), "zh": list("的一是不了人我在有他")}
    rows = [(k, "".join(rng.choice(letters[lang], 200)), lang) for lang in letters for k in range(40)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.trained_on(table, F.col("doc_id") % 4 == 0)
    found = language.identify(table, model).collect()
    assert all(r.lang_pred == r.row.lang and r.score > 0.99 for r in found)


def test_long_words_do_not_underflow():
    own = pieces()
    word = "abxab" * 4000
    assert all(math.isfinite(s) and s < -1000 for s in own.scores([word])[0])
    part = own.scores(["abxab" * 400])[0]
    assert np.allclose(own.scores([word])[0] / 10, part, rtol=0.01)
    unlikely = language.Pieces(own.vocabulary, np.full(own.shares.shape, 1e-9))
    assert np.isfinite(unlikely.scores(["x" * 60])).all() and not unlikely.uses(["x" * 60], np.zeros(1, int), np.ones(1)).any()


def test_language_held_out(spark):
    from ledgerloom.llm.queries import QUERIES

    folder = "/root/testdata/sf0.01"
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang").collect()}
    rows = QUERIES["op8_language"](spark, folder).collect()
    assert len(rows) == len(langs) and all(r.held_out == (remainder(r.doc_id, 4) == 2) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out and r.lang_pred != "und"]
    assert len(held) > 200 and sum(r.lang_pred == langs[r.doc_id] for r in held) >= 0.97 * len(held)


def test_language_cases(spark):
    train = [(100 + k, t, lang, "s", 1) for k in range(20) for lang, t in (("en", "the house and the garden"), ("de", "das Haus und der Garten"))]
    table = docs(spark, CASES + train + [(900, "12 34 !!", "en", "s", 1), (901, "The HOUSE and", None, None, None)])
    model = language.trained_on(table, F.lit(False))
    assert model[0] == ["de", "en"]
    found = {(r.row.doc_id, r.row.text): (r.lang_pred, r.score) for r in language.identify(table, model).collect()}
    assert found[1, None] == found[2, ""] == found[900, "12 34 !!"] == ("und", 0.0)
    assert found[901, "The HOUSE and"][0] == "en" and found[100, "das Haus und der Garten"][0] == "de"
    assert set(found) == {(r.doc_id, r.text) for r in table.collect()}
    nothing = language.trained_on(table.where("lang = 'xx'"), F.lit(False))
    assert {r.lang_pred for r in language.identify(table, nothing).collect()} == {"und"}
    assert language.identify(table.limit(0), model).count() == 0


def test_language_reads_no_label_of_a_held_out_row(spark, sample):
    table = spark.read.parquet(f"{sample}/documents.parquet")
    held_out = fold(F.col("doc_id"), 4) == 2
    spoilt = table.withColumn("lang", F.when(held_out, F.lit("zz")).otherwise(F.col("lang")))
    (langs, names, shares), (others, same, again) = language.trained_on(spoilt, held_out), language.trained_on(table, held_out)
    assert langs == others and names == same and np.allclose(shares, again, rtol=1e-9)


def base_scores(rows):
    """(held_out, n_tokens, n_known, train_tokens, base_score) of [(doc_id, text)]."""
    tokens = [[*brute.words(t), None] for _, t in rows]
    held = [remainder(d, 7) == 2 for d, _ in rows]
    counts = Counter(t for own, h in zip(tokens, held) if not h for t in own)
    n, v = sum(counts.values()), len(counts)
    return [
        (h, len(own), sum(counts[t] > 0 for t in own), n, sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in own))
        for own, h in zip(tokens, held)
    ]


def check_scores(found, rows):
    wanted, own = {}, {}
    for (d, t), e in zip(rows, base_scores(rows)):
        wanted.setdefault(d, []).append(e)
    for r in found:
        own.setdefault(r.doc_id, []).append((r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score))
        assert r.score <= 1e-6
    assert set(own) == set(wanted)
    for d, values in wanted.items():
        for a, b in zip(sorted(values), sorted(own[d])):
            assert a[:4] == b[:4] and math.isclose(a[4], b[4], rel_tol=1e-9, abs_tol=1e-9)


@pytest.mark.parametrize("frequent", [1 << 19, 1, 40])
def test_maxent_cases(spark, monkeypatch, frequent):
    monkeypatch.setattr(maxent, "FREQUENT", frequent)
    rows = [(d, t) for d, t, *_ in CASES]
    table = docs(spark)
    check_scores(maxent.score(table, fold(F.col("doc_id"), 7) == 2, steps=2).collect(), rows)


def test_maxent_without_rows_or_training(spark):
    table = docs(spark)
    assert maxent.score(table.limit(0), F.lit(False), steps=1).count() == 0
    rows = maxent.score(table, F.lit(True), steps=1).collect()
    assert len(rows) == len(CASES) and all(r.train_tokens == r.n_known == 0 and r.base_score == 0 for r in rows)


def test_maxent_registered_beats_the_base(spark):
    from ledgerloom.llm.queries import QUERIES

    folder = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    found = QUERIES["op9_maxent"](spark, folder).collect()
    check_scores(found, rows)
    held = [r for r in found if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held) + 0.02 * sum(r.n_tokens for r in held)


def test_layout_reads_contexts():
    texts = pa.array(["a b c", "", "b"])
    tokens, bounds = maxent.tokens_of(texts)
    assert bounds.tolist() == [0, 4, 5, 7] and tokens[3] == tokens[4] == tokens[6] == maxent.END
    layout = maxent.Layout([int(tokens[1]), int(tokens[0])])  # b, then a
    classes, cells = layout.read(tokens, bounds)
    assert classes[0] == 1 and classes[1] == classes[5] == 0 and (classes[[2, 3]] >= maxent.TOP).all()
    assert cells[0] == cells[4] == cells[5]  # nothing stands before
    assert cells[1] // maxent.SKIP == 1 and cells[2] == 0 * maxent.SKIP + 1


def test_class_probabilities_sum_to_one():
    weights = np.random.default_rng(0).normal(size=(maxent.FEATURES, maxent.CLASSES))
    logs = maxent.class_logs(weights, np.arange(0, maxent.CELLS, 37))
    assert np.allclose(np.exp(logs).sum(axis=1), 1)


def test_training_raises_the_likelihood(spark):
    rng = np.random.default_rng(1)
    cells = rng.integers(0, maxent.CELLS, 40)
    rows = [(int(c), int(k), int(rng.integers(1, 50))) for c in set(cells) for k in rng.choice(maxent.CLASSES, 6, replace=False)]
    table = spark.createDataFrame(rows, "cell int, class int, n long")

    def likelihood(steps):
        logs = maxent.class_logs(maxent.train(table, steps), np.array([r[0] for r in rows]))
        return sum(n * logs[i, k] for i, (_, k, n) in enumerate(rows))

    values = [likelihood(s) for s in (0, 1, 4, 10)]
    assert values == sorted(values) and values[-1] > values[0] + 100


def test_part_probabilities_sum_to_one_and_follow_the_counts():
    rng = np.random.default_rng(2)
    counts, shares = rng.integers(0, 9, 4 * maxent.HASHED), rng.integers(1, 50, 4 * maxent.HASHED)
    values = []
    for steps in (0, 1, 4, 12):
        logs = maxent.part_steps(counts, shares, steps)
        assert np.allclose(np.exp(logs).reshape(-1, maxent.HASHED).sum(axis=0), 1)
        values.append((counts * logs).sum())
    assert values == sorted(values) and values[-1] > values[0] + 100
    start = maxent.part_steps(np.zeros(4 * maxent.HASHED), shares, 12).reshape(-1, maxent.HASHED)
    assert np.allclose(np.exp(start), shares.reshape(-1, maxent.HASHED) / shares.reshape(-1, maxent.HASHED).sum(axis=0))


def test_maxent_grows_with_the_vocabulary():
    assert maxent.sizes(0) == (maxent.NEAR, maxent.HASHED)
    found = [math.prod(maxent.sizes(v)) for v in (0, 10**5, 10**6, 10**7, 10**8)]
    assert found == sorted(set(found)) and found[-1] < 1 << 25


def test_maxent_tells_pairs_of_words_of_one_class_apart(spark):
    """Words that follow each other: the right second word scores above another of its class that is as frequent."""
    second = [f"b{i}" for i in range(600)]
    tokens, _ = maxent.tokens_of(pa.array([" ".join(second)]))
    tokens = tokens[:-1].tolist()
    parts = maxent.sizes(1201)[1]
    wrong = {}
    for i in range(600):
        same = (j for j in range(600) if tokens[j] % maxent.HASHED == tokens[i] % maxent.HASHED)
        j = next((j for j in same if tokens[j] % parts != tokens[i] % parts), None)
        if j is not None:
            wrong[i] = j
    learned = [(i, f"a{i} b{i} " * 5) for i in range(600)]
    right = [(1000 + i, f"a{i} b{i}") for i in wrong]
    other = [(2000 + i, f"a{i} b{j}") for i, j in wrong.items()]
    table = spark.createDataFrame(learned + right + other, "doc_id long, text string")
    found = {r.doc_id: r.score for r in maxent.score(table, F.col("doc_id") >= 1000).collect()}
    better = [found[1000 + i] > found[2000 + i] + 0.1 for i in wrong]
    assert len(better) > 400 and np.mean(better) > 0.9
