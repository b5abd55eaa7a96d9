"""BPE, chat formatting and line removal against the library and brute force."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerloom.llm import bpe, chat, lines
from ledgerloom.llm.common import WORD_BPE
from tests.llm import brute
from tests.llm.helpers import CASES, docs

LIBRARY = Tokenizer.from_file(WORD_BPE)
CODEC = bpe.WordCodec(WORD_BPE)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def library_both(text):
    ids = LIBRARY.encode(text or "", add_special_tokens=False).ids
    return ids, LIBRARY.decode(ids, skip_special_tokens=False)


def codec_both(values):
    ids, bounds, decoded = CODEC.encode(values)
    return [(ids[a:b].tolist(), d) for a, b, d in zip(bounds, bounds[1:], decoded.to_pylist())]


TEXT = st.text(alphabet="abXY'slvetrdm  \n\t12²é日ΣςÅÅİß\U0001f600!.<|>\x1c\x85ﬁ", max_size=40)


@settings(max_examples=300, deadline=None)
@given(st.lists(TEXT | st.just("<|endoftext|>") | st.just("a<|startoftext|><|endoftext|> b'll"), max_size=4))
def test_bpe_equals_library(values):
    assert codec_both(values) == [library_both(v) for v in values]


def test_bpe_cases(spark):
    rows = [(d, t) for d, t, *_ in CASES]
    found = bpe.encode_decode(docs(spark).repartition(3)).collect()
    own = Counter((r.doc_id, tuple(np.frombuffer(r.ids, "<u4").tolist()), r.decoded, r.n_tokens) for r in found)
    assert own == Counter((d, tuple(library_both(t)[0]), library_both(t)[1], len(library_both(t)[0])) for d, t in rows)
    assert bpe.encode_decode(docs(spark).limit(0)).count() == 0


def test_bpe_registered(spark, sample):
    from ledgerloom.llm.queries import QUERIES

    table = {r.doc_id: r.text for r in spark.read.parquet(f"{sample}/documents.parquet").collect()}
    for r in QUERIES["op4_bpe"](spark, sample).collect():
        ids, decoded = library_both(table[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == sha(decoded)


def test_long_unit_merges_once():
    text = "ab" * 4000
    assert codec_both([text])[0] == library_both(text)


CHAT = "conv_id long, turn long, role string, text string"
TURNS = [
    (1, 0, "user", "\\### Assistant: </turn> ok"),
    (1, 1, "assistant", "\\s \\h \\l # < \\\\ </turn>\n### user: x"),
    (1, 2, "user", ""),
    (1, 3, "assistant", None),
    (1, 4, "assistant", " spaces  "),
    (2, 5, "system", "only"),
    (2, 7, None, "no role \U0001f600é"),
    (3, 1, "assistant", "b"),
    (3, 1, "assistant", "a"),
    (3, 1, "assistant", "a"),
    (3, None, "us: er\n", "null turn"),
    (None, 0, "user", "no id"),
    (None, 1, "assistant", "</turn>\n"),
    (4, 0, "assistant", "first \\c"),
    (4, 1, "user", "last\n"),
]


def chat_expected(rows):
    """Digests by conversation; a row without id is one by itself."""
    conversations = defaultdict(list)
    for k, (c, t, role, text) in enumerate(rows):
        conversations[(None, k) if c is None else c].append(((t is not None, t or 0), role or "", text or ""))
    out = Counter()
    for c, turns in conversations.items():
        turns.sort()
        said = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        loss = "".join(t for _, r, t in turns if r == "assistant")
        out[None if isinstance(c, tuple) else c, len(turns), sha(said), len(loss), sha(loss)] += 1
    return out


def chat_found(rows):
    return Counter((r.conv_id, r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in rows)


def test_chat_cases(spark):
    table = spark.createDataFrame(TURNS, CHAT).withColumn("turns", F.lit("x")).repartition(4)
    made = chat.examples(table)
    assert chat_found(chat.digests(made).collect()) == chat_expected(TURNS)
    for r in made.collect():
        # Control strings stand where turns begin and end, and nowhere else.
        assert r.formatted.count(chat.END) == r.formatted.count(chat.HEADER) == r.n_turns
        assert not set(r.formatted[r.loss_start : r.loss_start + r.loss_chars]) & set("#<")
    targets = Counter((c, r) for c, _, r, _ in TURNS)
    per_conversation = Counter(r.conv_id for r in made.collect())
    for c, n in per_conversation.items():
        assert n - targets[c, "assistant"] in (0, 1)
    assert all(r.n_turns == 1 and r.alone is not None for r in made.collect() if r.conv_id is None)
    assert chat.digests(chat.examples(table.limit(0))).count() == 0


def test_chat_context_is_a_prefix(spark):
    made = chat.examples(spark.createDataFrame(TURNS, CHAT)).collect()
    longest = {(r.conv_id, r.alone): r.formatted for r in made if r["last"]}
    assert all(longest[r.conv_id, r.alone].startswith(r.formatted) for r in made)


def test_many_rows_without_a_conversation(spark):
    """A third of all rows has no conv_id: as many small conversations, not one group."""
    rows = spark.range(30_000).selectExpr("if(id % 3 = 0, NULL, id % 4000) AS conv_id", "id AS turn", "'assistant' AS role", "concat('t', id) AS text")
    made = chat.examples(rows)
    lone = made.where("conv_id IS NULL")
    assert lone.count() == 10_000 and lone.agg(F.max("n_turns")).first()[0] == 1
    assert chat.digests(made).where("conv_id IS NULL").count() == 10_000


def test_chat_registered(spark, sample):
    from ledgerloom.llm.queries import QUERIES

    rows = [tuple(r) for r in spark.read.parquet(f"{sample}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    said = "\\### Assistant: </turn> ok"
    rows += [(-7, 0, "user", said), (-7, 1, "assistant", said)]
    result = QUERIES["op6_chat"](spark, sample).collect()
    assert chat_found(result) == chat_expected(rows)


def line_rows(seed=0):
    rng = random.Random(seed)
    common = ["License: MIT", " share  this ", "Ärger", "  "]
    rows = []
    for k in range(60):
        own = [rng.choice(common) if rng.random() < 0.3 else f"line {rng.randrange(80)}" for _ in range(rng.randrange(12))]
        rows.append((k, "\n".join(x.upper() + "\x0b" if rng.random() < 0.3 else x for x in own)))
    rows += [(100, None), (101, ""), (102, "\n\n"), (None, "license: mit\nkeep"), (5, rows[5][1]), (103, "Ärger\nÄRGER\närger")]
    return rows + [(200 + k, "License: MIT\r\nonly " + str(k)) for k in range(5)]


def line_result(df):
    return Counter((r.row.doc_id, r.n_lines, r.n_dropped, r.text) for r in df.collect())


def test_lines(spark):
    rows = line_rows()
    table = spark.createDataFrame(rows, "doc_id long, text string").withColumns({n: F.lit(1) for n in ("h", "row", "hs", "n_lines", "batch")})
    expected = Counter((d, *kept) for (d, _), kept in zip(rows, brute.shared_lines([t for _, t in rows])))
    assert line_result(lines.drop_shared_lines(table.repartition(5))) == expected
    assert lines.drop_shared_lines(table.limit(0)).count() == 0


def test_lines_with_every_hash_hot_or_none(spark, monkeypatch):
    rows = line_rows(2)
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for least in (2, 10):
        expected = Counter((d, *kept) for (d, _), kept in zip(rows, brute.shared_lines([t for _, t in rows], least)))
        for share in (1, 10**9):
            monkeypatch.setattr(lines, "HOT_SHARE", share)
            assert line_result(lines.drop_shared_lines(table, least)) == expected


def test_runs_are_levelled_and_settle(spark):
    runs = lines.LineRuns(spark, 3)
    for batch in (["a", "a", "a", "b"], ["a", "b", "c"], ["b", "c"], ["d"], ["d", "d", "e"]):
        runs.add(spark.createDataFrame([(x.encode(),) for x in batch], "h binary"))
    assert [len(level) for level in runs.levels] == [1, 0, 1]  # five batches: one run of one, one of four
    held = {bytes(r.h).decode(): r.n for name in runs.runs() for r in spark.table(name).collect()}
    assert held["a"] == 3  # settled by the first batch, so later ones left it out
    assert {bytes(r.h).decode() for r in runs.frequent().collect()} == {"a", "b", "d"}


def test_line_runs_meet_a_batch_without_a_shuffle(spark):
    """A batch is shuffled once to be counted; the bucketed runs are merged with it as they lie."""
    runs = lines.LineRuns(spark, 3)
    runs.add(spark.createDataFrame([(b"a",), (b"b",)], "h binary"))
    run = spark.table(runs.runs()[0])
    assert "Bucketed: true" in run.groupBy("h").sum("n")._jdf.queryExecution().toString()


def test_cases_keep_their_columns(spark):
    kept = lines.drop_shared_lines(docs(spark))
    assert kept.select("row.*").columns == docs(spark).columns and kept.count() == len(CASES)
