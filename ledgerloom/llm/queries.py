"""The registered queries of the subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import (
    bpe,
    chat,
    fill_middle,
    language,
    lines,
    maxent,
    near_vectors,
    ngram_join,
    packing,
    periodic,
    pieces,
    token_files,
    topk,
)
from ledgerloom.llm.common import all_finite, fold, table
from ledgerloom.llm.oracles import ORACLES as ORACLES  # the entry point takes both from here
from ledgerloom.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Register a function of session and folder under its own name."""
    QUERIES[build.__name__] = build
    return build


@query
def op1_ngram_join(spark, folder):
    return ngram_join.ngram_join(table(spark, folder, "documents"))


@query
def op2_packing(spark, folder):
    pieces = packing.pack(table(spark, folder, "documents"))
    return pieces.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
        "sequence_length",
    )


@query
def op3_near_vectors(spark, folder):
    vectors = table(spark, folder, "embeddings")
    return near_vectors.near_duplicates(vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("vector")))


@query
def op4_bpe(spark, folder):
    coded = bpe.encode_decode(table(spark, folder, "documents"))
    return coded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query
def op5_top_k(spark, folder):
    vectors = table(spark, folder, "embeddings").where(all_finite(F.col("embedding")))
    weights = F.transform("embedding", lambda x: F.floor(x.cast("double") * 256))
    return topk.top_k(vectors.select("vec_id", weights.alias("weights")), F.col("vec_id") % 50 == 0, 5)


@query
def op6_chat(spark, folder):
    # A conversation that says the template's own control strings.
    said = "\\### Assistant: </turn> ok"
    tricky = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(tricky)
    return chat.digests(chat.examples(rows))


@query
def op7_lines(spark, folder):
    kept = lines.drop_shared_lines(table(spark, folder, "documents"))
    return kept.select("row.doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


@query
def op8_language(spark, folder):
    docs = table(spark, folder, "documents")
    held_out = fold(F.col("doc_id"), 4) == 2
    found = language.identify(docs, language.trained_on(docs, held_out))
    return found.select("row.doc_id", (fold(F.col("row.doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score")


@query
def op9_maxent(spark, folder):
    return maxent.score(table(spark, folder, "documents"), fold(F.col("doc_id"), 7) == 2)


@query
def op10_token_files(spark, folder):
    data_set = scratch_path(spark, "tokens")
    token_files.write_token_files(table(spark, folder, "documents"), data_set)
    read = token_files.read_token_files(spark, data_set)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))

@query
def op11_fill_middle(spark, folder):
    made = fill_middle.fill_in_middle(table(spark, folder, "documents"))
    digest = lambda text: F.sha2(text.cast("binary"), 256)
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        digest(F.col("output")).alias("output_sha256"),
        digest(fill_middle.restored(F.col("output"), F.col("form"))).alias("restored_sha256"),
    )


@query
def op12_periodic_runs(spark, folder):
    docs = table(spark, folder, "documents")
    planted = docs.select("doc_id", periodic.with_planted_runs(F.col("doc_id"), F.col("text")).alias("text"))
    return periodic.digests(periodic.periodic_runs(planted))


@query
def op13_sentence_pieces(spark, folder):
    coded = pieces.encode_decode(table(spark, folder, "documents"))
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
