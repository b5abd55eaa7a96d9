"""Chat formatting by prefix-target expansion.

A turn becomes ``### role: text </turn>\\n``. Inside role and text a backslash is written ``\\s``, ``#`` is ``\\h``, ``<`` is ``\\l``
and a colon of a role is ``\\c``: the control strings cannot occur there, every backslash begins one of these four codes,
and replacing the codes back, the backslash last, restores the original.

Every assistant turn is an example of its own: all turns up to it, with a loss mask over its text only. The mask is one
span of code points. If a conversation does not end with an assistant turn, one more example holds all its turns with an
empty mask, so nothing of a conversation is lost. An example holds its whole conversation so far: a conversation has to
fit one row, and the examples of one conversation grow with the square of its turns.

Rows are ordered by (turn, role, text), so ties and repeated rows have a fixed order and are all kept; a null turn comes
first. Null role or text is empty. A row without conv_id is a conversation of one turn, told from the others by a number of its own
(``alone``), so many such rows are many small groups. An empty table gives no example.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The template's control strings, and the codes inside texts, the backslash first.
HEADER, COLON, END = "### ", ": ", " </turn>\n"
CODES = (("\\", "\\s"), ("#", "\\h"), ("<", "\\l"))
ROLE_CODES = (*CODES, (":", "\\c"))


def escaped(value: Column, codes=CODES) -> Column:
    return reduce(lambda c, code: F.replace(c, F.lit(code[0]), F.lit(code[1])), codes, value)


def unescaped(value: Column, codes=CODES) -> Column:
    return reduce(lambda c, code: F.replace(c, F.lit(code[1]), F.lit(code[0])), reversed(codes), value)


def formatted_turn(turn: Column) -> Column:
    role, text = escaped(turn["role"], ROLE_CODES), escaped(turn["text"])
    return F.concat(F.lit(HEADER), role, F.lit(COLON), text, F.lit(END))


def examples(conversations: DataFrame, trainable: str = "assistant") -> DataFrame:
    """One row for each example of ``conversations`` (conv_id, turn, role, text).

    Columns: conv_id, alone (a number for a row without conv_id, else null), example (from 1), n_turns, last (the example that
    holds every turn), formatted, loss_start and loss_chars (the span under the mask, in code points from 0). One shuffle, by
    conversation.
    """
    turn = F.struct(
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    conv_id = F.col("conv_id").cast("long")
    alone = F.when(conv_id.isNull(), F.monotonically_increasing_id())
    whole = conversations.select(conv_id.alias("conv_id"), alone.alias("alone"), turn.alias("turn")).groupBy("conv_id", "alone")
    turns = whole.agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    targets = F.filter(F.sequence(F.lit(1), F.size("turns")), lambda i: _role(i) == trainable)
    ends = F.when(_role(F.size("turns")) == trainable, targets).otherwise(F.concat(targets, F.array(F.size("turns"))))
    parts = F.transform("turns", formatted_turn)
    exploded = turns.select("conv_id", "alone", "turns", parts.alias("parts"), F.posexplode(ends).alias("example", "end"))
    final = F.element_at("turns", F.col("end"))
    is_target = final["role"] == trainable
    spans = exploded.select(
        "conv_id",
        "alone",
        (F.col("example") + 1).alias("example"),
        F.col("end").alias("n_turns"),
        (F.col("end") == F.size("turns")).alias("last"),
        F.array_join(F.slice("parts", F.lit(1), F.col("end")), "").alias("formatted"),
        is_target.alias("is_target"),
        F.when(is_target, F.length(escaped(final["text"]))).otherwise(0).cast("long").alias("loss_chars"),
    )
    start = F.length("formatted") - len(END) - F.col("loss_chars")
    return spans.withColumn("loss_start", F.when(F.col("is_target"), start).otherwise(0).cast("long")).drop("is_target")


def _role(position: Column) -> Column:
    return F.element_at("turns", position)["role"]


def turns_of(formatted: Column) -> Column:
    """Read a formatted example back: an array of (role, text)."""
    parts = F.filter(F.split(formatted, END, -1), lambda part: part != "")

    def turn(part: Column) -> Column:
        colon = F.instr(part, F.lit(COLON))
        role = F.substring(part, F.lit(len(HEADER) + 1), colon - len(HEADER) - 1)
        text = F.substring(part, colon + len(COLON), F.length(part))
        return F.struct(unescaped(role, ROLE_CODES).alias("role"), unescaped(text).alias("text"))

    return F.transform(parts, turn)


def loss_text(formatted: Column, start: Column, chars: Column) -> Column:
    """The text under the mask, as it was before formatting."""
    return unescaped(F.substring(formatted, (start + 1).cast("int"), chars.cast("int")))


def digests(formatted: DataFrame) -> DataFrame:
    """What the examples of a conversation hold, read back from their text: one row a conversation.

    Columns: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.
    """
    said = F.array_join(F.transform(turns_of(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    read = formatted.select(
        "conv_id",
        "alone",
        F.when(F.col("last"), F.size(turns_of(F.col("formatted")))).alias("n_turns"),
        F.when(F.col("last"), F.sha2(said.cast("binary"), 256)).alias("turns_sha256"),
        F.struct("example", loss_text(F.col("formatted"), F.col("loss_start"), F.col("loss_chars")).alias("text")).alias("loss"),
        F.length("formatted").cast("long").alias("chars"),
    )
    whole = read.groupBy("conv_id", "alone").agg(
        F.max("n_turns").cast("long").alias("n_turns"),
        F.max("turns_sha256").alias("turns_sha256"),
        F.array_join(F.transform(F.sort_array(F.collect_list("loss")), lambda piece: piece["text"]), "").alias("loss"),
        F.sum("chars").alias("formatted_chars"),
    )
    return whole.select(
        "conv_id",
        "n_turns",
        "turns_sha256",
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )
