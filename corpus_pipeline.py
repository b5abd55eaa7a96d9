"""A corpus pipeline: language, shared lines, near duplicates, packing.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and returns a table that is written and read again as
the next stage's ``docs``. All but the last return the columns of ``documents``. Null and empty texts, nulls in other columns,
repeated rows, extra columns and empty tables have the results that the stages state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.llm import language, lines, ngram_join, packing
from ledgerloom.llm.common import fold, table
from ledgerloom.session import materialise

# A text whose best language is less likely than this is rejected.
LEAST_SCORE = 0.5
# Near duplicates have so much of their five-word shingles in common, in percent.
SHINGLE_WORDS, SIMILAR_PERCENT = 5, 80


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents in a language the labelled documents teach.

    Texts that are null or have no letter are rejected, and texts whose language is in doubt. If no document has both a text and a
    language, nothing can be told and all rows with a letter stay.
    """
    model = language.trained_on(docs, fold(F.col("doc_id"), 4) == 2)
    found = language.identify(docs, model)
    if not model[0]:
        return found.where(F.col("row.text").rlike(r"\p{L}")).select("row.*")
    kept = (F.col("lang_pred") != language.UNDETERMINED) & (F.col("score") >= LEAST_SCORE)
    return found.where(kept).select("row.*")


def shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the lines that many documents share; every document stays, with n_chars of the text it has left.

    A null text becomes empty. Rows may repeat a doc_id.
    """
    kept = lines.drop_shared_lines(docs)
    changed = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return kept.select(*(changed.get(name, F.col("row")[name]).alias(name) for name in docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group that shares 80% of its five-word shingles: the one with the smallest doc_id.

    Of rows that share a doc_id the one with the smallest text stays. Rows without doc_id and texts without a word all stay.
    """
    joined = ngram_join.ngram_join(docs, SHINGLE_WORDS, SIMILAR_PERCENT)
    first = joined.where("doc_id = component_id").select("doc_id").distinct()
    own = Window.partitionBy("doc_id").orderBy("text")
    rows = docs.where("doc_id IS NOT NULL").join(first, "doc_id").withColumn("_row", F.row_number().over(own))
    return rows.where("_row = 1").select(docs.columns).unionByName(docs.where("doc_id IS NULL"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the documents into sequences: one row a piece, with its ids."""
    return packing.pack(docs)


STAGES = [
    ("language", languages),
    ("shared_lines", shared_lines),
    ("near_duplicates", near_duplicates),
    ("packing", packed),
]

# The language model and the tokenizer have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
