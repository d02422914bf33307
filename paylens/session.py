"""Shared-folder helpers: where intermediate tables and checkpoints go."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

_FOLDERS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """This application's folder, which every executor can reach.

    It lies in the folder that ``spark.checkpoint.dir`` names, or else in the
    warehouse folder; no setting is changed. It is removed when the application ends.
    """
    app = spark.sparkContext.applicationId
    if app not in _FOLDERS:
        base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
        folder = f"{base.rstrip('/')}/paylens-{app}"
        jvm, hadoop = spark._jvm, spark._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path(folder)
        files = path.getFileSystem(hadoop)
        files.mkdirs(path)
        files.deleteOnExit(path)
        _FOLDERS[app] = folder
    return _FOLDERS[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for one written table."""
    return f"{shared_dir(spark)}/{uuid.uuid4().hex}/{name}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Let Spark checkpoint into the shared folder, unless it already has a folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


def checkpoint(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: lineage is cut and survives the loss of executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


#: Row groups of a few rows. By default a writer holds 100 rows before it looks at their size, and a reader a whole row group.
_LARGE_ROWS = {"parquet.block.size": str(16 * 2**20), "parquet.page.size.row.check.min": "1"}


def stage_table(df: DataFrame, name: str, partition_by: str | None = None, large_rows: bool = False) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    Later steps then scan only the columns, row groups and partitions they need
    instead of repeating the joins behind the table. ``large_rows`` is for rows of megabytes.
    """
    path = scratch_path(df.sparkSession, name)
    writer = df.write.mode("overwrite").options(**_LARGE_ROWS if large_rows else {})
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)
