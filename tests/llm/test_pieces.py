"""SentencePiece encoding and decoding against the library."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerloom.llm import pieces
from tests.llm.helpers import CASES, docs

LIBRARY = sentencepiece.SentencePieceProcessor(model_file=pieces.PIECES)
CODEC = pieces.PieceCodec(pieces.PIECES)
NORMAL = [LIBRARY.id_to_piece(i) for i in range(259, LIBRARY.get_piece_size())]


def check(values):
    ids, bounds = CODEC.encode(values)
    decoded = CODEC.decode(ids, bounds).to_pylist()
    for i, value in enumerate(values):
        wanted = LIBRARY.encode(value, add_eos=True)
        assert ids[bounds[i] : bounds[i + 1]].tolist() == wanted
        assert decoded[i] == LIBRARY.decode(wanted)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="abdehinorst  ▁\n\t\x00é日\U0001f600<>/0x.,", max_size=60), max_size=5))
def test_equals_library(values):
    check(values)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(NORMAL), max_size=12))
def test_equals_library_on_joined_pieces(parts):
    check(["".join(parts), "".join(parts).replace("▁", "")])


@pytest.mark.parametrize("count", [*range(20), 64, 65, 1000])
def test_runs_of_spaces(count):
    check([" " * count, " " * count + "the", "x" + " " * count, "a" + " " * count + "日" + "▁" * count + "\n"])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 260), st.integers(0, len(NORMAL) + 258)), max_size=6))
def test_decoding_of_any_ids(ids):
    text = CODEC.decode(np.array(ids, np.int64), np.array([0, len(ids)]))[0].as_py()
    assert text == LIBRARY.decode(ids)


def test_long_texts_without_spaces():
    check(["abcdefghij" * 3000, "日本語" * 2000, "\n" * 5000, "a" * 10_000])


def test_memory_starts_anew(monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED_BYTES", 1000)
    monkeypatch.setattr(pieces, "REMEMBERED_PAIRS", 10)
    codec = pieces.PieceCodec(pieces.PIECES)
    values = [f"word{i} other" for i in range(50)]
    ids, bounds = codec.encode(values)
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [LIBRARY.encode(v, add_eos=True) for v in values]
    assert len(codec.known) < 10 and len(codec.fits) <= 10


def test_cases(spark):
    found = [tuple(r) for r in pieces.encode_decode(docs(spark).repartition(3)).collect()]
    wanted = [(d, LIBRARY.encode(t or "", add_eos=True)) for d, t, *_ in CASES]
    assert sorted(map(repr, found)) == sorted(repr((d, ids, LIBRARY.decode(ids))) for d, ids in wanted)
    assert pieces.encode_decode(docs(spark).limit(0)).count() == 0


def test_registered(spark, sample):
    from ledgerloom.llm.queries import QUERIES

    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sample}/documents.parquet").collect()}
    rows = QUERIES["op13_sentence_pieces"](spark, sample).collect()
    assert {r.doc_id for r in rows} == set(texts)
    for r in rows:
        ids = LIBRARY.encode(texts[r.doc_id], add_eos=True)
        listed, decoded = " ".join(map(str, ids)), LIBRARY.decode(ids)
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (listed, decoded)]
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), *digests)
