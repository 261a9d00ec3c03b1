"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only where none is set and Spark runs locally."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="agrometry-llm-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Let Python workers take ``rows`` rows at a time: texts can be long, and results do not depend on it."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it again, which cuts its lineage."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
