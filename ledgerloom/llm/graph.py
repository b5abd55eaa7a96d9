"""Connected components of a large graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import materialise


def components(edges: DataFrame) -> DataFrame:
    """The smallest node each node of ``edges`` (a, b) is connected with: (node, component).

    Alternates two steps until nothing changes: every node hands its larger neighbours, then its smaller ones, to the
    smallest node it knows. Both fold to one row a node before they join, so a node with many neighbours costs one row
    for each of them and nothing in their square. The folded rows are written as well as the edges, so both sides of a join are plain
    scans and adaptive execution can split the edges of a node with very many. Nodes without an edge to another node are left out; no
    edge gives no row.
    """
    pairs = edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    current = materialise(pairs.distinct(), "edges")
    state = _state(current)
    while state[0]:
        current = materialise(_larger(current).distinct(), "edges")
        current = materialise(_smaller(current).distinct(), "edges")
        after = _state(current)
        if after == state:
            break
        state = after
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def _state(edges: DataFrame) -> tuple:
    """Count and order-free digest of the edges."""
    mixed = F.xxhash64("u", "v")
    row = edges.agg(
        F.count(F.lit(1)), F.sum(mixed.bitwiseAND(0xFFFFFFFF)), F.sum(F.shiftrightunsigned(mixed, 32))
    ).first()
    return tuple(row)


def _larger(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours become neighbours of the smallest node it knows."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    # The written rows keep the join's sides plain, the hint keeps it a merge join, whose hot nodes can be split.
    return both.join(materialise(least, "least").hint("merge"), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _smaller(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours become neighbours of the smallest of them."""
    least = materialise(edges.groupBy("u").agg(F.min("v").alias("m")), "least")
    others = edges.join(least.hint("merge"), "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.unionByName(least.select("u", F.col("m").alias("v")))

