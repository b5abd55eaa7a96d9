"""Encoding, packing and token files against the tokenizers library."""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgerloom.llm import packing, token_files
from ledgerloom.llm.common import BYTE_BPE
from ledgerloom.llm.encoding import ByteEncoder
from ledgerloom.session import scratch_path
from tests.llm.helpers import CASES, crc32, docs

LIBRARY = Tokenizer.from_file(BYTE_BPE)
ENCODER = ByteEncoder(BYTE_BPE)


def library_ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="ab'slvetrdm  \n\t1²é日\U0001f600!.<|>\x1c\x85 ", max_size=30), max_size=5))
def test_encoder_equals_library(values):
    ids, bounds = ENCODER.encode(values)
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [library_ids(v) for v in values]


def test_encoder_on_sample(spark, sample):
    values = [r.text for r in spark.read.parquet(f"{sample}/documents.parquet").select("text").collect()]
    ids, bounds = ENCODER.encode(values)
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [library_ids(v) for v in values]


class Counting:
    """A model that counts its calls."""

    def __init__(self, model):
        self.model, self.calls = model, 0

    def tokenize(self, text):
        self.calls += 1
        return self.model.tokenize(text)


@pytest.mark.parametrize("alone", [False, True])
def test_encoder_joins_units(alone):
    encoder = ByteEncoder(BYTE_BPE)
    encoder.model = counted = Counting(encoder.model)
    if alone:
        encoder.separator = None
    values = [f"w{k}x \xff\u00fe\u00c0{k} \x00\x7f 日{k}\n" for k in range(300)] + ["", "ÿ" * 300]
    for _ in range(2):  # from the model, then from memory
        ids, bounds = encoder.encode(values)
        assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [library_ids(v) for v in values]
    distinct = len(encoder.known)
    assert distinct > 300 and counted.calls == (distinct if alone else -(-distinct // 64))


def check_packing(rows, expected):
    """expected: doc_id -> list of id lists. Every id in one piece, sequences without gaps, digests of the real ids."""
    sequences, covered = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
        assert r.length == len(r.ids) // 4 > 0
        covered[r.doc_id].append((r.start, np.frombuffer(r.ids, "<u4").tolist(), r.doc_tokens))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= packing.LENGTH
    for doc, lists in expected.items():
        found = sorted((s, i) for s, i, _ in covered[doc])
        assert {t for *_, t in covered[doc]} == {len(i) for i in lists}
        wanted = sorted((s, i[s : s + packing.LENGTH]) for i in lists for s in range(0, len(i), packing.LENGTH))
        assert found == wanted
    assert set(covered) == set(expected)
    return sequences


def test_packing_cases(spark):
    expected = defaultdict(list)
    for doc, text, *_ in CASES:
        expected[doc].append([*library_ids(text), 0])
    check_packing(packing.pack(docs(spark).repartition(3)).collect(), expected)


def test_packing_sample_has_little_padding(spark, sample):
    table = spark.read.parquet(f"{sample}/documents.parquet")
    expected = {r.doc_id: [[*library_ids(r.text), 0]] for r in table.collect()}
    rows = packing.pack(table.repartition(4)).collect()
    sequences = check_packing(rows, expected)
    filled = {s: sum(n for _, n in p) for s, p in sequences.items()}
    stored = {r.sequence_id: r.sequence_length for r in rows}
    assert all(stored[s] == packing.padded_length(n, packing.LENGTH) for s, n in filled.items())
    assert sum(filled.values()) >= 0.97 * sum(stored.values())


def test_windows_stay_bounded():
    windows = packing.Windows(100, 3)
    emitted = [windows.place(60, i) for i in range(10)]
    assert len(windows.rest()) == 3 and sum(e is not None for e in emitted) == 7
    assert windows.place(40, "x") == [(60, 7), (40, "x")] or windows.place(40, "y")


def test_empty_tables(spark):
    none = docs(spark).limit(0)
    assert packing.pack(none).count() == 0
    folder = scratch_path(spark, "none")
    assert token_files.write_token_files(none, folder).count() == 0
    assert token_files.read_token_files(spark, folder).count() == 0


def test_token_files_round_trip(spark):
    folder = scratch_path(spark, "tokens")
    token_files.write_token_files(docs(spark).repartition(3), folder, length=64)
    rows = sorted(token_files.read_token_files(spark, folder).collect(), key=lambda r: r.start)
    ordered = sorted(CASES, key=lambda c: (c[0] is not None, c[0] or 0))
    assert [r.doc_id for r in rows] == [c[0] for c in ordered]
    at = 0
    for r, case in zip(rows, ordered):
        wanted = [*library_ids(case[1]), 2]
        assert (r.start, r.n_tokens) == (at, len(wanted))
        assert np.frombuffer(r.ids, "<u4").tolist() == wanted
        at += len(wanted)


def test_sequences_are_views_of_the_file(tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "BATCH_SEQUENCES", 4)
    path = str(tmp_path / "tokens" / "part-000000.arrow")
    out, ids = token_files.SequenceWriter(path, 8, 50_000), np.arange(101, dtype=np.uint32)
    for at in range(0, 101, 7):
        out.add(ids[at : at + 7])
    out.close()
    reader = token_files.SequenceReader(path)
    for k in range(13):
        own, mask = reader.sequence(k)
        real = min(8, 101 - 8 * k)
        assert own[:real].tolist() == ids[8 * k : 8 * k + real].tolist() and not own[real:].any()
        assert mask.to_pylist() == [True] * real + [False] * (8 - real)
        assert not own.flags.owndata and own.dtype == np.uint16
    for start, count in ((0, 101), (5, 40), (31, 1), (100, 1), (3, 0)):
        assert reader.ids(start, count).tolist() == ids[start : start + count].tolist()


def test_wide_vocabulary_uses_four_bytes(tmp_path):
    path = str(tmp_path / "tokens" / "part-000000.arrow")
    out = token_files.SequenceWriter(path, 4, 1 << 17)
    out.add(np.array([100_000, 5], np.uint32))
    out.close()
    assert token_files.SequenceReader(path).ids(0, 2).tolist() == [100_000, 5]


@pytest.mark.parametrize("name", ["op2_packing", "op10_token_files"])
def test_registered(spark, sample, name):
    from ledgerloom.llm.queries import QUERIES

    table = {r.doc_id: r.text for r in spark.read.parquet(f"{sample}/documents.parquet").collect()}
    rows = QUERIES[name](spark, sample).collect()
    for r in rows:
        ids = [*library_ids(table[r.doc_id]), 0 if name.startswith("op2_") else 2]
        piece = ids[r.start : r.start + r.length] if name.startswith("op2_") else ids
        assert r.ids_crc32 == crc32(piece)
    assert {r.doc_id for r in rows} == set(table)
