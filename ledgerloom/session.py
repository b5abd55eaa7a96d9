"""Session settings and the shared folder for checkpoints and intermediate tables."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings only, so they can be applied to a session somebody else has built.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where the split costs one more exchange afterwards.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Sorted rows take several times their shuffled size; four tasks of an executor then sort without spilling.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32m",
}


def tuned(spark: SparkSession) -> SparkSession:
    """Apply the adaptive-execution settings this package relies on."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str, master: str | None = None, **settings: str) -> SparkSession:
    """A session with the package's settings; cluster settings come from spark-submit."""
    builder = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC")
    if master is not None:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return tuned(builder.getOrCreate())


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Where it is unset, a folder below the session's warehouse. On a cluster that must not be a path of one machine, or executors would
    write where nobody else reads.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is not None:
        return folder
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    own_disk = warehouse.startswith("file:") or "://" not in warehouse
    if own_disk and not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir (or spark.sql.warehouse.dir) to a folder that all executors share")
    return f"{warehouse}/checkpoints"


def use_checkpoints(spark: SparkSession) -> None:
    """Let Spark's own checkpoints go to the shared folder, where the context has no folder yet."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for an intermediate table, below the shared folder and this application's name."""
    return f"{_scratch_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _scratch_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/ledgerloom/{spark.sparkContext.applicationId}"


def clear_scratch(spark: SparkSession) -> None:
    """Remove the intermediate tables of this application, also from the catalog; results that still read them end here."""
    own = f"/ledgerloom/{spark.sparkContext.applicationId}/"
    for found in spark.catalog.listTables():
        if found.tableType == "EXTERNAL":
            row = spark.sql(f"DESCRIBE FORMATTED {found.name}").where("col_name = 'Location'").first()
            if row is not None and own in row.data_type:
                spark.sql(f"DROP TABLE {found.name}")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_scratch_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


# Removes the shuffle files of a query when it ends. Otherwise they wait until the driver collects garbage, which has nothing to do with
# their size, so on large tables those of many steps lie on disk together.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialise(df: DataFrame, name: str = "table") -> DataFrame:
    """Write a table several consumers read into the shared folder, and read it back.

    The lineage ends at the files, so lost executors cost a re-read, and later steps still prune columns. The shuffle files behind the
    table go when it is written; other actions keep theirs, as they may run again.
    """
    spark = df.sparkSession
    path, before = scratch_path(spark, name), spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(written: DataFrame) -> None:
    """Remove the folder of a table that ``materialise`` wrote and no later step reads."""
    spark = written.sparkSession
    for folder in {name.rsplit("/", 1)[0] for name in written.inputFiles()}:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
