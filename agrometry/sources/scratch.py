"""Where written intermediate tables go."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder in the cluster's shared checkpoint directory.

    The folder is the session's setting, or one set on the context.  Only a local session without either gets a
    folder of this machine; on a cluster that is an error, since executors would not find each other's files.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or _context_folder(spark)
    if shared:
        return f"{shared.rstrip('/')}/{name}-{uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return tempfile.mkdtemp(prefix=f"{name}-")


def _context_folder(spark: SparkSession) -> str | None:
    return spark.sparkContext.getCheckpointDir()


def kept_in_scratch(df: DataFrame, name: str) -> DataFrame:
    """The table written to a new scratch folder and read again, so that no use of it works it out a second time."""
    place = scratch_folder(df.sparkSession, name)
    df.write.mode("overwrite").parquet(place)
    return df.sparkSession.read.schema(df.schema).parquet(place)


def forget_versions(spark: SparkSession, folder: str, keep: int) -> None:
    """Delete all but the last folders, by name, in a folder that only this library writes to."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = sorted((status.getPath() for status in files.listStatus(path)), key=lambda p: p.getName())
    for old in found[:-keep]:
        files.delete(old, True)
