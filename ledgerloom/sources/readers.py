"""Typed readers of the star schema."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.schemas import BASE_TABLES, TABLES, Table
from ledgerloom.sources import storage
from ledgerloom.sources.storage import MONTH


class MissingTable(FileNotFoundError):
    """A required table has no data at its path."""

    def __init__(self, table: str, path: str):
        super().__init__(f"missing data of table {table}: {path}")
        self.table = table
        self.path = path


def _required(table: Table, path: str, load) -> DataFrame:
    try:
        return load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise MissingTable(table.name, path) from error
        raise


def read_csv(spark: SparkSession, folder: str, table: Table) -> DataFrame:
    """One CSV file (or folder) per table with a header row.

    Types are declared, the header must name the declared columns, and a value that does not fit stops the job.
    """
    reader = (
        spark.read.schema(table.schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
    )
    return _required(table, f"{folder}/{table.name}.csv", reader.csv)


def read_parquet(
    spark: SparkSession, folder: str, table: Table, since: date | None = None, until: date | None = None
) -> DataFrame:
    """The current version of a warehouse table. For a fact, the bounds prune month folders as well as row groups.

    A bucketed version also skips the buckets of other accounts, and needs no shuffle to be grouped or joined by account.
    """
    path = storage.current(spark, f"{folder}/{table.name}")
    df = _required(table, path, lambda found: storage.read_version(spark, found, table, table.dated_by is not None))
    if table.dated_by is not None:
        day = F.col(table.dated_by)
        for bound, keep in ((since, lambda x, y: x >= y), (until, lambda x, y: x <= y)):
            if bound is not None:
                df = df.where(keep(day, F.lit(bound)))
                if MONTH in df.columns:
                    df = df.where(keep(F.col(MONTH), F.lit(bound.strftime("%Y-%m"))))
    return df.select(*table.schema.names)


def read_jdbc(spark: SparkSession, url: str, table: Table, **options: str) -> DataFrame:
    return spark.read.format("jdbc").options(url=url, dbtable=table.name, **options).load()


def load_tables(
    spark: SparkSession,
    source: str,
    kind: str = "parquet",
    tables: Iterable[Table] = BASE_TABLES,
    **options,
) -> dict[str, DataFrame]:
    """The tables by name, from CSV files, a Parquet warehouse or an external database (by its URL)."""
    read = {"csv": read_csv, "parquet": read_parquet, "jdbc": read_jdbc}[kind]
    return {t.name: read(spark, source, t, **options) for t in tables}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A warehouse table by its name."""
    return read_parquet(spark, folder, TABLES[name])
