"""Near-duplicate vectors by cosine, with a PCA-ordered tiled comparison.

Unit vectors are turned into their principal components, so leading dimensions hold most of the spread. They are cut into
blocks along the first component; blocks whose leading components and suffix norms rule out the threshold never meet. A
task compares two blocks tile by tile: it adds up products of the leading dimensions, bounds the rest by the product of the
suffix norms, drops what cannot reach the threshold, and goes on with the next dimensions only for what is left. Pairs
close to the threshold are decided on the original numbers in double precision.

Equal vectors are compared once and counted as often as they occur. A task returns counts of links and, for every linked
vector, the smallest one it is connected with inside the task, so no pair leaves a task.

Vectors that are null, empty, zero or hold null or non-finite components link with nothing, nor do rows without id; vectors of
different lengths are not compared. Every row is a vector, also rows that repeat an id. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import all_finite, prepared
from ledgerloom.llm.graph import components
from ledgerloom.llm.links import Links
from ledgerloom.session import materialise

THRESHOLD = 0.9
BLOCK_ROWS = 8192
TILE_ROWS = 1024
# Dimensions after which the bound is checked, and leading components that describe a block.
STOPS = (16, 32, 48)
LEADING = 8
# Cosines of turned vectors are right to much less than this; closer ones are computed again.
ROUNDING = 1e-9
# Below this share of possible pairs a tile goes on pair by pair.
SPARSE = 0.02


def matrix(column) -> np.ndarray:
    """Equally long rows of numbers as a matrix of doubles."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return lists.flatten().to_numpy().astype(np.float64).reshape(len(lists), -1)


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, safe for very large and very small components."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt(np.einsum("ij,ij->i", rows, rows))[:, None]


def suffix_norms(rows: np.ndarray, stops: list[int]) -> np.ndarray:
    """For each stop the norm of what follows it."""
    return np.stack([np.sqrt(np.einsum("ij,ij->i", rows[:, s:], rows[:, s:])) for s in stops])


def linked(
    a: np.ndarray, b: np.ndarray, tail_a: np.ndarray, tail_b: np.ndarray, stops: list[int], threshold: float
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of rows of two tiles whose cosine may reach the threshold, and their cosines.

    tail_a and tail_b are the suffix norms at the stops; the last stop is the full length.
    """
    least = threshold - ROUNDING
    sums = a[:, : stops[0]] @ b[:, : stops[0]].T
    for k, stop in enumerate(stops):
        alive = sums + tail_a[k][:, None] * tail_b[k][None, :] >= least
        count = int(np.count_nonzero(alive))
        if not count:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        if stop == stops[-1] or count < SPARSE * alive.size:
            break
        sums += a[:, stop : stops[k + 1]] @ b[:, stop : stops[k + 1]].T
    i, j = np.nonzero(alive)
    sums = sums[i, j]
    for k in range(k, len(stops) - 1):
        part = slice(stops[k], stops[k + 1])
        sums = sums + np.einsum("ij,ij->i", a[i, part], b[j, part])
        stay = sums + tail_a[k + 1][i] * tail_b[k + 1][j] >= least
        i, j, sums = i[stay], j[stay], sums[stay]
    return i, j, sums


def compare(
    rows: np.ndarray, basis: np.ndarray, weights: np.ndarray, split: int, same: bool, threshold: float
) -> Links:
    """Compare rows before ``split`` with rows from it on, or, if ``same``, all rows with each other."""
    units = unit(rows)
    turned = units @ basis
    length = rows.shape[1]
    stops = [*[s for s in STOPS if s < length], length]
    tails = suffix_norms(turned, stops)
    links = Links(weights)
    left = range(0, len(rows) if same else split, TILE_ROWS)
    for at in left:
        stop = min(at + TILE_ROWS, len(rows) if same else split)
        for other in range(at if same else split, len(rows), TILE_ROWS):
            end = min(other + TILE_ROWS, len(rows))
            i, j, cosine = linked(
                turned[at:stop], turned[other:end], tails[:, at:stop], tails[:, other:end], stops, threshold
            )
            i, j = i + at, j + other
            if other == at and same:
                keep = i < j
                i, j, cosine = i[keep], j[keep], cosine[keep]
            close = np.flatnonzero(np.abs(cosine - threshold) <= 2 * ROUNDING)
            x, y = rows[i[close]], rows[j[close]]
            norms = np.sqrt(np.einsum("ij,ij->i", x, x) * np.einsum("ij,ij->i", y, y))
            with np.errstate(all="ignore"):
                again = np.einsum("ij,ij->i", x, y) / norms
            cosine[close] = np.where(np.isfinite(again), again, cosine[close])
            sure = cosine >= threshold
            if sure.any():
                links.add(i[sure], j[sure])
    return links


def principal_axes(vectors: DataFrame) -> dict[int, np.ndarray]:
    """For each vector length the axes of the unit vectors, the widest first; a few numbers leave each task."""

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            sizes = batch.column(0).value_lengths().to_numpy(zero_copy_only=False)
            for size in np.unique(sizes).tolist():
                rows = unit(matrix(batch.column(0).filter(pa.array(sizes == size))))
                sums[size] = sums.get(size, 0) + rows.T @ rows
        for size, square in sums.items():
            i, j = np.triu_indices(size)
            yield pa.record_batch(
                [pa.array(np.full(len(i), size)), pa.array(i), pa.array(j), pa.array(square[i, j])],
                names=["size", "i", "j", "s"],
            )

    parts = vectors.select("vector").mapInArrow(moments, "size long, i long, j long, s double")
    total = parts.groupBy("size", "i", "j").agg(F.sum("s").alias("s")).toPandas()
    axes = {}
    for size, cells in total.groupby("size"):
        square = np.zeros((int(size), int(size)))
        square[cells["i"], cells["j"]] = square[cells["j"], cells["i"]] = cells["s"]
        axes[int(size)] = np.ascontiguousarray(np.linalg.eigh(square)[1][:, ::-1])
    return axes


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Links among ``vectors`` (vec_id, vector array<double>): (vec_id, n_links, component_id, kept), one row a vector.

    Blocks follow quantiles of the first component, so they are equally large; equal values are dealt out by a hash.
    Only what grows with the number of blocks (a few numbers each) and with the square of the vector length is gathered.
    """
    spark = prepared(vectors.sparkSession)
    context = spark.sparkContext
    sound = F.col("vec_id").isNotNull() & all_finite(F.col("vector")) & F.exists("vector", lambda x: x != 0)
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.when(sound, F.col("vector")).alias("vector")
    )
    distinct = rows.where("vector IS NOT NULL").groupBy("vector").agg(
        F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("weight")
    )
    distinct = materialise(distinct, "vectors")
    axes = context.broadcast(principal_axes(distinct))

    def lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(1).value_lengths().to_numpy(zero_copy_only=False)
            for size in np.unique(sizes).tolist():
                own = batch.filter(pa.array(sizes == size))
                turned = unit(matrix(own.column(1))) @ axes.value[size]
                ahead = np.zeros((len(turned), LEADING + 1))
                ahead[:, : min(LEADING, size)] = turned[:, :LEADING]
                ahead[:, LEADING] = suffix_norms(turned, [min(LEADING, size)])[0]
                yield pa.record_batch(
                    [own.column(0), pa.array(np.full(len(own), size)), *map(pa.array, ahead.T.copy())],
                    names=["rep", "size", *(f"p{k}" for k in range(LEADING)), "tail"],
                )

    ahead_schema = "rep long, size long, " + ", ".join(f"p{k} double" for k in range(LEADING)) + ", tail double"
    ahead = materialise(distinct.select("rep", "vector").mapInArrow(lead, ahead_schema), "leading")
    cuts = {}
    for size, count in ahead.groupBy("size").count().collect():  # one row for each vector length
        shares = [k / (count // BLOCK_ROWS + 1) for k in range(1, count // BLOCK_ROWS + 1)]
        cuts[size] = ahead.where(F.col("size") == size).approxQuantile("p0", shares, 0.1 * BLOCK_ROWS / count) if shares else []
    cut = context.broadcast({size: np.array(values) for size, values in cuts.items()})

    def quantise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, p0 = (batch.column(k).to_numpy(zero_copy_only=False) for k in ("size", "p0"))
            quantile = np.empty(len(size), np.int64)
            for s in np.unique(size).tolist():
                quantile[size == s] = np.searchsorted(cut.value[s], p0[size == s])
            yield batch.append_column("quantile", pa.array(quantile))

    cells = ahead.mapInArrow(quantise, ahead_schema + ", quantile long")
    crowded = cells.groupBy("size", "quantile").count().collect()  # one row for each quantile
    parts = {(r["size"], r["quantile"]): r["count"] // (2 * BLOCK_ROWS) + 1 for r in crowded}
    first, at = {}, 0
    for key in sorted(parts):
        first[key], at = at, at + parts[key]
    cell = context.broadcast((first, parts))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, count = cell.value
        for batch in batches:
            keys = list(zip(batch.column("size").to_pylist(), batch.column("quantile").to_pylist()))
            mixed = (batch.column("rep").to_numpy().astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
            block = [start[key] + m % count[key] for key, m in zip(keys, mixed.tolist())]
            yield batch.append_column("block", pa.array(block, pa.int64()))

    numbered = materialise(cells.mapInArrow(number, ahead_schema + ", quantile long, block long"), "blocks")
    described = numbered.groupBy("block", "size").agg(
        *(f(f"p{k}").alias(f"{n}{k}") for k in range(LEADING) for n, f in (("lo", F.min), ("hi", F.max))),
        F.max("tail").alias("tail"),
    )
    partners = context.broadcast(_partners(described.toPandas(), threshold))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column("block").to_numpy()
            others = [partners.value[b] for b in own.tolist()]
            index = np.repeat(np.arange(len(own)), [len(o) for o in others])
            other, mine = np.concatenate(others) if others else np.zeros(0, np.int64), own[index]
            yield pa.record_batch(
                [batch.column("rep").take(pa.array(index)), *map(pa.array, (mine, np.minimum(mine, other), np.maximum(mine, other)))],
                names=["rep", "block", "x", "y"],
            )

    sent = numbered.select("rep", "block").mapInArrow(meet, "rep long, block long, x long, y long")

    def search(key: tuple[pa.Scalar, ...], found: pa.Table) -> pa.Table:
        x, same = key[0].as_py(), key[0].as_py() == key[1].as_py()
        order = np.lexsort((found.column("rep").to_numpy(), found.column("block").to_numpy() != x))
        rep = found.column("rep").to_numpy()[order]
        links = compare(
            matrix(found.column("vector"))[order],
            axes.value[len(found.column("vector")[0])],
            found.column("weight").to_numpy()[order],
            int((found.column("block").to_numpy() == x).sum()),
            same,
            threshold,
        )
        hit = np.flatnonzero(links.counts)
        return pa.table({"rep": rep[hit], "links": links.counts[hit], "near": rep[links.root[hit]]})

    result = sent.join(distinct, "rep").groupBy("x", "y").applyInArrow(search, "rep long, links long, near long")
    result = materialise(result, "links")
    counts = result.groupBy("rep").agg(F.sum("links").alias("links"))
    groups = components(result.select(F.col("rep").alias("a"), F.col("near").alias("b")))
    classes = distinct.join(counts, "rep", "left").join(groups.withColumnRenamed("node", "rep"), "rep", "left").select(
        F.col("vector").alias("_vector"),
        (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
        F.coalesce("component", "rep").alias("component_id"),
    )
    classes = materialise(classes, "vector-classes")  # so that a value a third of the rows share can be split in the join
    component = F.coalesce("component_id", "vec_id")
    return rows.join(classes, rows["vector"] == classes["_vector"], "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )


def _partners(blocks, threshold: float) -> dict[int, np.ndarray]:
    """For each block those, itself included, that may hold a vector close enough."""
    number, size = blocks["block"].to_numpy(), blocks["size"].to_numpy()
    low = np.stack([blocks[f"lo{k}"] for k in range(LEADING)]).reshape(LEADING, -1)
    high = np.stack([blocks[f"hi{k}"] for k in range(LEADING)]).reshape(LEADING, -1)
    tail, found = blocks["tail"].to_numpy(), {}
    for k in range(len(number)):
        corners = [low[:, k : k + 1] * low, low[:, k : k + 1] * high, high[:, k : k + 1] * low, high[:, k : k + 1] * high]
        bound = np.maximum.reduce(corners).sum(axis=0) + tail[k] * tail
        found[int(number[k])] = number[(bound >= threshold - ROUNDING) & (size == size[k])].astype(np.int64)
    return found
