"""Tables that are replaced safely, and files that are found by account.

A table's folder holds versions and one pointer. A new version is written beside the old one and becomes the table when the pointer is
swapped, so a job that dies leaves the old version, and a reader keeps the version it began with. One version before the current
one stays for such readers.

Bucketed versions spread accounts over files by the hash that Spark's bucketed tables use. They are registered in the session's catalog
under a name made from their path, whose number of buckets is part of the version's name, so that any session can register them.
"""

from __future__ import annotations

import re
import time
import uuid
import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.schemas import Table

POINTER = "_current"
VERSION = re.compile(r"version-(\d+)-b(\d+)-")
ACCOUNT = "account_id"
MONTH = "month"


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _read_text(spark: SparkSession, path: str) -> str | None:
    where, files = _file_system(spark, path)
    if not files.exists(where):
        return None
    stream = files.open(where)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def _swap_pointer(spark: SparkSession, folder: str, version: str) -> None:
    """Write the pointer under another name and rename it over the old one, which file systems do at once."""
    jvm = spark.sparkContext._jvm
    fresh, files = _file_system(spark, f"{folder}/{POINTER}-{uuid.uuid4().hex}")
    stream = files.create(fresh, True)
    stream.write(version.encode("utf-8"))
    stream.close()
    pointer, _ = _file_system(spark, f"{folder}/{POINTER}")
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    over = spark.sparkContext._gateway.new_array(rename, 1)
    over[0] = rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fresh.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(files.makeQualified(fresh), files.makeQualified(pointer), over)


def replace(spark: SparkSession, folder: str, write: Callable[[str], None], buckets: int = 0) -> str:
    """Let ``write`` make a new version at the path it is given, then make it the table; returns its path."""
    version = f"version-{time.time_ns():020d}-b{buckets}-{uuid.uuid4().hex[:8]}"
    before = _read_text(spark, f"{folder}/{POINTER}")
    write(f"{folder}/{version}")
    _swap_pointer(spark, folder, version)
    where, files = _file_system(spark, folder)
    for status in files.listStatus(where):
        name = status.getPath().getName()
        # What is older than the version before belongs to nobody, left by writers that died.
        if VERSION.match(name) and before is not None and name < before:
            files.delete(status.getPath(), True)
    return f"{folder}/{version}"


def current(spark: SparkSession, folder: str) -> str:
    """Path of the table's current version; a folder without a pointer is a table itself."""
    version = _read_text(spark, f"{folder}/{POINTER}")
    return folder if version is None else f"{folder}/{version}"


def buckets_of(path: str) -> int:
    found = VERSION.match(path.rsplit("/", 1)[-1])
    return int(found.group(2)) if found else 0


def catalog_name(path: str, name: str) -> str:
    return f"{name}_{zlib.crc32(path.encode('utf-8')):08x}"


def file_order(table: Table) -> list[str]:
    """The order of the rows in a file of a bucketed table."""
    return [ACCOUNT] if table.dated_by is None else [ACCOUNT, table.dated_by]


def write_bucketed(df: DataFrame, path: str, table: Table, buckets: int) -> None:
    """One folder a month, in it files by bucket of the account, sorted by account and day."""
    writer = df.write.format("parquet").bucketBy(buckets, ACCOUNT).sortBy(*file_order(table)).option("path", path)
    if table.dated_by is not None:
        writer = writer.partitionBy(MONTH)
    writer.saveAsTable(catalog_name(path, table.name))


def read_version(spark: SparkSession, path: str, table: Table, by_month: bool) -> DataFrame:
    """A version as a table; a bucketed one is registered first where this session does not know it."""
    buckets = buckets_of(path)
    if not buckets:
        return spark.read.parquet(path)
    name = catalog_name(path, table.name)
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in table.schema.fields)
        month, parted = (f", {MONTH} string", f"PARTITIONED BY ({MONTH})") if by_month else ("", "")
        spark.sql(
            f"CREATE TABLE {name} ({columns}{month}) USING parquet {parted} "
            f"CLUSTERED BY ({ACCOUNT}) SORTED BY ({', '.join(file_order(table))}) INTO {buckets} BUCKETS LOCATION '{path}'"
        )
        if by_month:
            spark.sql(f"MSCK REPAIR TABLE {name}")
    return spark.table(name)
