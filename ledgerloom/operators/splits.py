"""Deterministic train/test splits by a hash of the account, and statistics per split."""

from __future__ import annotations

import struct
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.session import materialise

BUCKETS = 10_000
TEST_SHARE = 0.25
SEED = 42


def hash_bucket(key: Column, seed: int = SEED) -> Column:
    """A bucket in 0..9999 from the first 32 bits of md5(key followed by the seed)."""
    digits = F.substring(F.md5(F.concat(key, F.lit(str(seed)))), 1, 8)
    return (F.conv(digits, 16, 10).cast("long") % BUCKETS).cast("int")


def random_split(df: DataFrame, test_share: float = TEST_SHARE, seed: int = SEED, key: str = "account_id") -> DataFrame:
    """Add ``is_test``; a narrow step, and the same rows fall out on every run."""
    return df.withColumn("is_test", hash_bucket(F.col(key), seed) < int(test_share * BUCKETS))


def with_held_back(
    df: DataFrame, alike: Sequence[str], share: float, seed: int, key: str = "account_id"
) -> DataFrame:
    """Add ``held_back`` for a share of the rows, chosen by the hash of the key; rows alike in all given columns stay together.

    Copies of a fitted row would be held back else, and measures on them would go on rising while the fit learns rows by heart. Such
    rows follow the smallest key among them, so a row without copies lies where its own key puts it. Keys are folded before the
    shuffle, and a group of copies may be of any size. The input is read twice: a costly one should be a written table.
    """
    marked = df.withColumn("_alike", F.md5(F.to_json(F.struct(*alike), {"ignoreNullFields": "false"})))
    first = marked.groupBy("_alike").agg(F.min(key).alias("_first"))
    # Merged, as a broadcast would hold one row of nearly every account.
    placed = marked.join(first.hint("merge"), "_alike")
    return placed.withColumn("held_back", hash_bucket(F.col("_first"), seed) < int(share * BUCKETS)).drop("_alike", "_first")


def stratified_split(
    df: DataFrame, label: str, test_share: float = TEST_SHARE, seed: int = SEED, key: str = "account_id"
) -> DataFrame:
    """Add ``is_test`` so that both classes (label 1, and the rest) give the same share of their rows.

    Each class is cut at its own hash bucket, read from a histogram of at most 10,000 buckets per class. The
    input is read twice: a costly one should be a written table.
    """
    hashed = df.withColumns({
        "_positive": F.coalesce(F.col(label) == 1, F.lit(False)), "_bucket": hash_bucket(F.col(key), seed),
    })
    one_class = Window.partitionBy("_positive")
    so_far = one_class.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cuts = (
        hashed.groupBy("_positive", "_bucket")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("_positive", "_bucket", F.sum("n").over(so_far).alias("reached"), F.sum("n").over(one_class).alias("total"))
        .groupBy("_positive")
        .agg(F.max(F.when(F.col("reached") <= F.round(F.col("total") * test_share), F.col("_bucket"))).alias("_cut"))
    )
    # Two rows at most: the class is a boolean without NULL.
    return (
        hashed.join(F.broadcast(cuts), "_positive")
        .withColumn("is_test", F.col("_bucket") <= F.coalesce("_cut", F.lit(-1)))
        .drop("_positive", "_bucket", "_cut")
    )


def positive_weight(positives: Column, rows: Column) -> Column:
    """Weight of a positive row that balances the classes."""
    return (rows - positives) / F.greatest(positives, F.lit(1))


def label_stats(split: DataFrame, label: str) -> DataFrame:
    """Rows, positives, positive rate and class weight on both sides of a split."""
    return (
        split.groupBy("is_test")
        .agg(F.count(F.lit(1)).alias("rows"), F.sum(label).alias("positives"))
        .select(
            "is_test",
            "rows",
            "positives",
            (F.col("positives") / F.col("rows")).alias("churn_rate"),
            positive_weight(F.col("positives"), F.col("rows")).alias("positive_weight"),
        )
    )


DIGIT_BITS = 16


def ordered_code(value: Column, floating: bool) -> Column:
    """A BIGINT that sorts as the number does; of floating-point numbers by their bits, NaN last and both zeros alike."""
    if not floating:
        return value.cast("long")
    text = F.reflect(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), value.cast("double") + F.lit(0.0))
    bits = text.cast("long")
    return bits.bitwiseXOR(F.shiftright(bits, 63).bitwiseAND(F.lit((1 << 63) - 1)))


def coded_number(code: int, floating: bool) -> int | float:
    """The number of a code."""
    if not floating:
        return code
    bits = code ^ ((code >> 63) & ((1 << 63) - 1))
    return struct.unpack("<d", struct.pack("<q", bits))[0]


def exact_median(df: DataFrame, flag: str, value: str) -> DataFrame:
    """Exact median of a column of any whole or floating-point numbers on both sides of a boolean.

    Radix selection: codes that sort like the numbers are written once. Each pass counts the next 16 bits of the codes that share the
    higher bits of a middle rank, and so fixes 16 bits more; there are as many passes as the range of the codes needs, four at most.
    Counts are folded before the shuffle, a window holds at most 2^16 of them, and the driver gets up to four rows a pass. Rows
    without value or flag are left out; a side without rows has no row.
    """
    floating = isinstance(df.schema[value].dataType, (T.FloatType, T.DoubleType))
    known = df.where(F.col(value).isNotNull() & F.col(flag).isNotNull())
    codes = known.select(F.col(flag).cast("boolean").alias("side"), ordered_code(F.col(value), floating).alias("code"))
    codes = materialise(codes, "codes")
    sides = codes.groupBy("side").agg(F.count(F.lit(1)).alias("n"), F.min("code").alias("low"), F.max("code").alias("high")).collect()
    # (side, which middle) -> rank among the codes with this prefix, and the prefix
    wanted = {(s.side, which): ((s.n - 1 + which) // 2, 0) for s in sides for which in (0, 1)}
    base = min((s.low for s in sides), default=0)
    span = max((s.high for s in sides), default=0) - base
    if span >= 1 << 63:  # the codes themselves, with a signed first digit
        base, span = 0, (1 << 64) - 1
    passes = -(-max(span.bit_length(), 1) // DIGIT_BITS)
    own = F.col("code") - F.lit(base) if base else F.col("code")
    for k in reversed(range(passes)):
        first = k == passes - 1
        prefix = F.lit(0).cast("long") if first else F.shiftright(own, DIGIT_BITS * (k + 1))
        digit = F.shiftright(own, DIGIT_BITS * k)
        digit = digit if first else digit.bitwiseAND(F.lit((1 << DIGIT_BITS) - 1))
        places = {(side, prefix_) for (side, _), (_, prefix_) in wanted.items()}
        here = reduce(Column.__or__, ((F.col("side") == s) & (prefix == F.lit(p)) for s, p in places)) if places else F.lit(False)
        counts = codes.where(here).groupBy("side", prefix.alias("prefix"), digit.alias("digit")).agg(F.count(F.lit(1)).alias("n"))
        before = Window.partitionBy("side", "prefix").orderBy("digit").rowsBetween(Window.unboundedPreceding, -1)
        ranked = counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
        holds = [
            (F.col("side") == s) & (F.col("prefix") == F.lit(p)) & (F.col("before") <= r) & (F.col("before") + F.col("n") > r)
            for (s, _), (r, p) in wanted.items()
        ]
        found = ranked.where(reduce(Column.__or__, holds)).collect() if holds else []
        for key, (rank, old) in wanted.items():
            row = next(x for x in found if (x.side, x.prefix) == (key[0], old) and x.before <= rank < x.before + x.n)
            wanted[key] = rank - row.before, row.digit if first else (old << DIGIT_BITS) + row.digit
    middles = {key: coded_number(code + base, floating) for key, (_, code) in wanted.items()}
    rows = [(s.side, (middles[s.side, 0] + middles[s.side, 1]) / 2) for s in sides]
    return df.sparkSession.createDataFrame(rows, f"{flag} boolean, median double")
