"""The folder all executors share, for relations that several plans read."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``; where none is, one in the session's warehouse.

    A warehouse on the machine's own disk serves a session on a single machine only.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    if warehouse.startswith(("file:", "/")) and not context.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    return f"{warehouse.rstrip('/')}/shared"


def new_path(spark: SparkSession) -> str:
    """A new path in the shared folder; what is written there goes when the application ends."""
    folder = f"{shared_folder(spark)}/aprisco/{uuid.uuid4().hex}"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(hadoop)  # only what exists can be marked for deletion
    files.deleteOnExit(hadoop)
    return f"{folder}/data"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write the rows to the shared folder once and return them as read back.

    Several readers then scan the columns they need instead of repeating the plan, and a lost
    executor costs no more than a task.
    """
    path = new_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
