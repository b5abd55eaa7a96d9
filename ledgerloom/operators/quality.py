"""Integrity checks of the table contracts. Every check returns rows; nothing is raised and nothing dropped."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.schemas import TABLES, Table

COLUMN_CHECKS = ("not_null", "domain", "non_negative", "text_length", "decimal_range")
# Digits after the point; only columns that are no decimals can break it.
SCALE_CHECK = "decimal_scale"


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _conditions(table: Table, present: set[str], kinds: Sequence[str]) -> list[tuple[str, str, str]]:
    """(check, column, SQL condition that marks a bad value) for the columns at hand."""
    found = [("not_null", c, f"{c} IS NULL") for c in table.required]
    for c, values in table.domains.items():
        listed = ", ".join(f"'{v}'" for v in values)
        found.append(("domain", c, f"{c} NOT IN ({listed})"))
    found += [("non_negative", c, f"{c} < 0") for c in table.non_negative]
    found += [("text_length", c, f"length({c}) > {limit}") for c, limit in table.text_limits.items()]
    found += [
        ("decimal_range", c, f"abs({c}) >= {10 ** (precision - scale)}")
        for c, (precision, scale) in table.decimal_limits.items()
    ]
    found += [("decimal_scale", c, f"{c} <> round({c}, {scale})") for c, (_, scale) in table.decimal_limits.items()]
    return [entry for entry in found if entry[0] in kinds and entry[1] in present]


def column_checks(tables: dict[str, DataFrame], kinds: Sequence[str] = COLUMN_CHECKS) -> DataFrame:
    """Bad values per (check, table, column): all checks of a table in one scan of it."""
    parts = []
    for name, df in tables.items():
        conditions = _conditions(TABLES[name], set(df.columns), kinds)
        if not conditions:
            continue
        counts = df.agg(*(F.expr(f"count_if({bad}) AS n{i}") for i, (_, _, bad) in enumerate(conditions)))
        rows = ", ".join(
            f"named_struct('check', '{check}', 'table_name', '{name}', 'column_name', '{column}', 'violations', n{i})"
            for i, (check, column, _) in enumerate(conditions)
        )
        parts.append(counts.selectExpr(f"inline(array({rows}))"))
    return _union(parts)


def minimum_values(tables: dict[str, DataFrame]) -> DataFrame:
    """Smallest value and number of negative values of the columns that must not be negative."""
    return _union([
        df.agg(
            F.min(column).cast("double").alias("minimum"), F.count_if(F.col(column) < 0).alias("violations")
        ).select(F.lit(name).alias("table_name"), F.lit(column).alias("column_name"), "minimum", "violations")
        for name, df in tables.items()
        for column in TABLES[name].non_negative
    ])


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table; a violation is an empty table."""
    return _union([
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count", (F.col("row_count") == 0).cast("int").alias("violations")
        )
        for name, df in tables.items()
    ])


def primary_keys(tables: dict[str, DataFrame]) -> DataFrame:
    """Key values that occur more than once, and the rows they cover. Counts fold before the shuffle."""
    parts = []
    for name, df in tables.items():
        key = list(TABLES[name].key)
        repeated = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
        parts.append(
            repeated.agg(F.count(F.lit(1)).alias("violations"), F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"))
            .select(F.lit(name).alias("table_name"), F.lit(",".join(key)).alias("key_columns"),
                    "violations", "row_count")
        )
    return _union(parts)


def foreign_keys(tables: dict[str, DataFrame], parents: dict[str, DataFrame] | None = None) -> DataFrame:
    """Values without a parent, and the rows that hold them; parents are looked up among the tables themselves
    unless given.

    Child rows are counted per value before the join, so a parent with very many rows costs one row in it. The values of
    all children of one parent go through one join.
    """
    known = tables if parents is None else parents
    relations: dict[tuple[str, str], list[tuple[str, str]]] = {}
    for name in tables:
        for column, parent, parent_column in TABLES[name].references:
            relations.setdefault((parent, parent_column), []).append((name, column))
    parts = []
    for (parent, parent_column), children in relations.items():
        values = _union([
            tables[name].where(F.col(column).isNotNull()).groupBy(F.col(column).alias("v"))
            .agg(F.count(F.lit(1)).alias("n")).select(F.lit(k).alias("child"), "v", "n")
            for k, (name, column) in enumerate(children)
        ])
        orphans = values.join(known[parent].select(F.col(parent_column).alias("v")), "v", "left_anti")
        counts = orphans.agg(*(
            F.expr(f"{f} AS {kind}{k}")
            for k in range(len(children))
            for kind, f in (("v", f"count_if(child = {k})"), ("n", f"coalesce(sum(if(child = {k}, n, 0)), 0L)"))
        ))
        rows = ", ".join(
            f"named_struct('table_name', '{name}', 'column_name', '{column}', 'parent_table', '{parent}', "
            f"'violations', v{k}, 'row_count', n{k})"
            for k, (name, column) in enumerate(children)
        )
        parts.append(counts.selectExpr(f"inline(array({rows}))"))
    return _union(parts)


def feature_matrix(features: DataFrame, active: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: rows, distinct accounts, active accounts without a row, and NULLs over all feature columns."""
    nulls = " + ".join(f"int({c} IS NULL)" for c in columns)
    per_account = features.groupBy("account_id").agg(F.expr("count(1) AS n"), F.expr(f"sum({nulls}) AS nulls"))
    both = active.select("account_id").join(per_account, "account_id", "full")
    return both.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.count("n").alias("accounts"),
        F.count_if(F.col("n").isNull()).alias("missing_accounts"),
        F.coalesce(F.sum("nulls"), F.lit(0)).alias("null_values"),
    )


def scores(scored: DataFrame) -> DataFrame:
    """One row: range of the probabilities, values outside [0, 1] and empty reason texts."""
    p = F.col("churn_probability").cast("double")
    empty = lambda c: F.count_if(F.coalesce(F.length(c), F.lit(0)) == 0)
    return scored.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min(p).alias("min_probability"),
        F.max(p).alias("max_probability"),
        F.count_if(p.isNull() | ~p.between(0.0, 1.0)).alias("out_of_range"),
        empty("primary_churn_driver").alias("empty_primary"),
        empty("secondary_churn_driver").alias("empty_secondary"),
        empty("recommended_action").alias("empty_action"),
    )
