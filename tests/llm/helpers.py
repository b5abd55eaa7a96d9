"""Small documents with every special case, and a session-independent digest."""

from __future__ import annotations

import struct
import zlib

DOCS = "doc_id long, text string, lang string, source string, n_chars long"

# Nulls in any column, empty and blank texts, repeated rows, ties, quotes, added-token strings, non-Latin text.
CASES = [
    (5, "The cat sat. It's here, isn't it?", "en", "a", 10),
    (1, None, "en", "a", None),
    (2, "", None, None, 0),
    (None, "no id", "en", "b", 5),
    (3, "  two  spaces \n\n and\tlines \n", "en", None, 3),
    (4, "<|endoftext|> plain <|startoftext|> added's", None, "a", 3),
    (9, "日本語 テスト 123abc \U0001f600!!'s Ärger ﬁn Σίσυφος", "de", "a", 3),
    (9, "日本語 テスト 123abc \U0001f600!!'s Ärger ﬁn Σίσυφος", "de", "a", 3),
    (7, "word " * 3000, "en", "c", 15000),
    (8, "x" * 5000 + "\n" + "y'll " * 50, "en", "c", 15000),
]


def crc32(ids) -> int:
    return zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))


def docs(spark, rows=CASES):
    """The rows as a table, with extra columns whose names operators might use themselves."""
    from pyspark.sql import functions as F

    made = spark.createDataFrame(rows, DOCS)
    return made.withColumns({name: F.lit("extra") for name in ("n", "ids", "part", "h", "word", "component_id")})
