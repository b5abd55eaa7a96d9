"""The pipeline's stages against plain versions."""

from __future__ import annotations

from collections import Counter

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
from ledgerloom.llm.common import BYTE_BPE
from ledgerloom.session import materialise
from tests.llm import brute
from tests.llm.helpers import CASES, docs

LIBRARY = Tokenizer.from_file(BYTE_BPE)


def sample_docs(spark, folder):
    table = spark.read.parquet(f"{folder}/documents.parquet")
    extra = [(10_000, None, "en", "s", None), (10_001, "", None, None, 0), (10_002, "123 !!", "en", "s", 6)]
    copies = table.where("doc_id < 10").unionByName(table.where("doc_id < 3"))
    return materialise(table.unionByName(spark.createDataFrame(extra, table.schema)).unionByName(copies), "docs")


def counted(df):
    return Counter(tuple(r) for r in df.collect())


def test_stages_follow_brute_force(spark, sample):
    table = sample_docs(spark, sample)
    stages = dict(corpus_pipeline.STAGES)
    rows = [tuple(r) for r in table.collect()]

    kept = materialise(stages["language"](spark, table, sample), "kept")
    assert kept.columns == table.columns
    gone = Counter(rows) - counted(kept)
    assert not counted(kept) - Counter(rows)
    assert {r[0] for r in gone} >= {10_000, 10_001, 10_002}
    assert sum(r[0] < 10_000 for r in gone.elements()) <= 0.02 * len(rows)

    lined = materialise(stages["shared_lines"](spark, kept, sample), "lined")
    before = [tuple(r) for r in kept.collect()]
    texts = [k[2] for k in brute.shared_lines([r[1] for r in before])]
    assert counted(lined) == Counter((r[0], t, r[2], r[3], len(t)) for r, t in zip(before, texts))

    single = materialise(stages["near_duplicates"](spark, lined, sample), "single")
    before = sorted((tuple(r) for r in lined.collect()), key=lambda r: (r[0], r[1]))
    pairs = brute.similar_pairs([(r[0], r[1]) for r in before], 80, 5)
    component = brute.connected({r[0] for r in before}, [(before[i][0], before[j][0]) for i, j in pairs])
    first = {}
    for r in before:
        first.setdefault(r[0], r)
    assert counted(single) == Counter(r for d, r in first.items() if component[d] == d)

    pieces = stages["packing"](spark, single, sample).collect()
    read = {}
    for r in sorted(pieces, key=lambda r: r.start):
        read.setdefault(r.doc_id, []).extend(np.frombuffer(r.ids, "<u4").tolist())
    expected = {r.doc_id: [*LIBRARY.encode(r.text, add_special_tokens=False).ids, 0] for r in single.collect()}
    assert read == expected


def test_special_cases_pass_every_stage(spark, sample):
    table = materialise(docs(spark), "docs")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, table.limit(0), sample).count() == 0
        found = materialise(stage(spark, table, sample), name)
        if name != "packing":
            assert found.columns == docs(spark).columns
            table = found
    assert {r.doc_id for r in table.collect()} <= {c[0] for c in CASES}


def test_run(spark, sample):
    rows = corpus_pipeline.run(spark, sample).collect()
    assert rows and {"doc_id", "sequence_id", "offset", "length"} <= set(rows[0].asDict())


def test_near_duplicates_share_80_percent_of_five_words(spark, sample):
    words = [f"w{k}" for k in range(200)]
    replaced = [f"x{k}" if k in (20, 70, 120, 170) else w for k, w in enumerate(words)]  # 176 of 216, with three words 186 of 210
    longer = words + [f"y{k}" for k in range(30)]  # 196 of 226
    other = [f"x{k}" if k % 40 == 20 else w for k, w in enumerate(words)]  # 171 of 221: too few
    rows = [(k, " ".join(text), "en", "s", None) for k, text in enumerate([words, replaced, longer, other])]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = dict(corpus_pipeline.STAGES)["near_duplicates"](spark, table, sample)
    assert sorted(r.doc_id for r in kept.collect()) == [0, 3]
