"""The folder all executors can reach, and tables written there once for many readers."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; where unset, a folder in its warehouse.

    On a cluster a warehouse on the machine's own disk is refused: tables would lose parts.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    if not spark.sparkContext.master.startswith("local") and _on_own_disk(spark, warehouse):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors reach")
    return os.path.join(warehouse, "wardflow-tables")


def _on_own_disk(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).getUri().getScheme() == "file"


def shared_path(spark: SparkSession, name: str, folder: str | None = None) -> str:
    """A new path below ``folder``, by default the shared one; it goes when the session ends."""
    path = os.path.join(folder or shared_folder(spark), f"wardflow-{name}-{uuid.uuid4().hex}")
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


#: Spark's setting that removes the shuffle files of a query when it has ended.
CLEANED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What is written inside leaves no shuffle files; without this they lie until the driver collects the frame."""
    before = spark.conf.get(CLEANED, None)
    spark.conf.set(CLEANED, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANED) if before is None else spark.conf.set(CLEANED, before)


def materialised(df: DataFrame, folder: str | None = None) -> DataFrame:
    """The frame written once to ``folder``, by default the shared one, and read back.

    For plans that read it several times: the lineage ends at the table, and each reader
    takes only its columns. ``drop_table`` removes it before the session ends. The shuffles
    of the write go with it, so loops of tables hold one round's on the disks.
    """
    spark = df.sparkSession
    path = shared_path(spark, "table", folder)
    with _shuffles_removed(spark):
        df.write.parquet(path)
    return spark.read.parquet(path)


def drop_table(table: DataFrame) -> None:
    """Remove what ``materialised`` wrote; its readers must be done."""
    spark = table.sparkSession
    for folder in {os.path.dirname(f) for f in table.inputFiles()}:
        if os.path.basename(folder).startswith("wardflow-table-"):
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
