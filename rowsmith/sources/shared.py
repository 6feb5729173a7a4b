"""The shared folder of the cluster, and results settled there."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
#: Has Spark remove the shuffle files of a query when it ends, rather than when the driver happens to collect its garbage.
CLEANED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder named by the session. Only a local session without one gets a folder, beside its warehouse."""
    folder = spark.conf.get(SETTING, None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {SETTING} to a folder that all executors can reach")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    spark.sparkContext.setCheckpointDir(f"{warehouse}-shared")
    return spark.sparkContext.getCheckpointDir()


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses. It is removed when the session's process ends."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(place)
    return path


@contextmanager
def _cleaned(spark: SparkSession) -> Iterator[None]:
    """Queries that are run inside leave no shuffle files behind."""
    before = spark.conf.get(CLEANED, None)
    spark.conf.set(CLEANED, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANED)
        else:
            spark.conf.set(CLEANED, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Rows of any number, written once as Parquet in the shared folder and read back from there.

    This cuts the lineage: what is built on the result is not computed again from the start, and a lost
    executor costs nothing, as every executor can read the files. The shuffle files of the writing query go when it ends.
    """
    path = new_path(df.sparkSession, name)
    with _cleaned(df.sparkSession):
        df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.stored_at = path
    return table


def removed(*tables: DataFrame) -> None:
    """Removes the files of tables that stored() gave, once nothing reads them any more."""
    for table in tables:
        spark = table.sparkSession
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table.stored_at)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def settled(df: DataFrame) -> DataFrame:
    """Small intermediate rows computed once and kept in the shared folder.

    Used for per-column and per-table figures that later steps read several times: without it each reader
    would scan the tables again. Lost executors do not matter, the rows are read back from the folder.
    """
    spark = df.sparkSession
    folder = shared_folder(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.coalesce(1).checkpoint()
