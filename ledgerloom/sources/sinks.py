"""Warehouse tables, serving tables, exports and the CSV ingestion job."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerloom.schemas import BASE_TABLES, TABLES, Table
from ledgerloom.sources import storage
from ledgerloom.sources.readers import read_csv
from ledgerloom.sources.storage import MONTH

INGEST_BATCH = 10_000
SERVING_BATCH = 5_000


def _laid_out(df: DataFrame, table: Table, buckets: int = 0) -> DataFrame:
    """Facts by month (and bucket), every file sorted by account, so a lookup skips files and row groups.

    Rebalancing splits a large month or bucket by size, whatever its keys, and joins small ones, in one pass over the
    input (ranges would read it once more to sample their bounds). The writer of a bucketed table sorts by month, bucket and account
    itself, so its rows are not sorted here as well.
    """
    by = [MONTH] if table.dated_by is not None else []
    if by:
        df = df.withColumn(MONTH, F.date_format(table.dated_by, "yyyy-MM"))
    if buckets:
        numbered = df.withColumn("_bucket", F.pmod(F.hash("account_id"), F.lit(buckets)))
        return numbered.hint("rebalance", *map(F.col, [*by, "_bucket"])).drop("_bucket")
    if not by:
        return df
    return df.hint("rebalance", F.col(MONTH)).sortWithinPartitions(MONTH, "account_id", table.dated_by)


def write_parquet(df: DataFrame, folder: str, table: Table, buckets: int = 0) -> int:
    """Replace a warehouse table; returns its row count, observed while writing (no second scan).

    The old table is read until the new one is complete. With ``buckets`` the rows of a table with accounts are spread over so many
    buckets by account (``storage``).
    """
    rows = Observation(f"{table.name} rows")
    spark, by_month = df.sparkSession, table.dated_by is not None
    if "account_id" not in table.schema.names:
        buckets = 0
    laid_out = _laid_out(df.select(*table.schema.names), table, buckets).observe(rows, F.count(F.lit(1)).alias("n"))

    def write(path: str) -> None:
        if buckets:
            storage.write_bucketed(laid_out, path, table, buckets)
        else:
            (laid_out.write.partitionBy(MONTH) if by_month else laid_out.write).parquet(path)

    storage.replace(spark, f"{folder}/{table.name}", write, buckets)
    return rows.get["n"]


def write_jdbc(df: DataFrame, url: str, table: Table, batch_size: int = INGEST_BATCH, **options: str) -> None:
    """Replace a table of an external database, in batches, one connection per partition."""
    (
        df.select(*(c for c in table.schema.names if c in df.columns))
        .write.format("jdbc")
        .options(url=url, dbtable=table.name, batchsize=str(batch_size), **options)
        .mode("overwrite")
        .save()
    )


def ingest_csv(
    spark: SparkSession,
    csv_folder: str,
    warehouse: str | None = None,
    jdbc_url: str | None = None,
    buckets: int = 0,
    tables: Iterable[Table] = BASE_TABLES,
    **options: str,
) -> DataFrame:
    """Load the CSV tables (all six, or those named) into the Parquet warehouse, or into an external database if a URL is given.

    All inputs are looked up before the first table is written, and each table is replaced as a whole. Returns (table_name,
    row_count); the count is NULL for a database load.
    """
    frames = [(t, read_csv(spark, csv_folder, t)) for t in tables]
    counts = []
    for table, df in frames:
        if jdbc_url is not None:
            write_jdbc(df, jdbc_url, table, **options)
            counts.append((table.name, None))
        else:
            counts.append((table.name, write_parquet(df, warehouse, table, buckets)))
    return spark.createDataFrame(counts, "table_name string, row_count long")


def write_csv(df: DataFrame, path: str, compression: str = "none") -> None:
    """A CSV export with a header; a sorted frame keeps its order over the part files."""
    df.write.mode("overwrite").option("header", True).option("compression", compression).csv(path)


def write_base_csv(tables: dict[str, DataFrame], folder: str, compression: str = "none") -> None:
    """Tables for ingestion. A compressed part file is read by one task, as it was written by one; it trades CPU time for bytes."""
    for name, df in tables.items():
        write_csv(df.select(*TABLES[name].schema.names), f"{folder}/{name}.csv", compression)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_scores(
    scores: DataFrame, table: Table, folder: str | None = None, jdbc_url: str | None = None, **options: str
) -> None:
    """Replace the serving table in the warehouse or in an external database. Readers see the old scores until all new ones are there."""
    if jdbc_url is not None:
        write_jdbc(scores, jdbc_url, table, SERVING_BATCH, **options)
    else:
        rows = scores.select(*table.schema.names)
        storage.replace(scores.sparkSession, f"{folder}/{table.name}", lambda path: rows.write.parquet(path))
