"""Daily bronze load that reads only new raw files.

Bronze has no aggregation, so the batch operator runs unchanged on a stream.
``availableNow`` takes all files that arrived since the last run and stops;
the checkpoint makes each file count once.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from agrometry.operators.bronze import bronze_climate


def append_new_files(
    spark: SparkSession, raw_path: str, schema: StructType, bronze_path: str, checkpoint: str
) -> StreamingQuery:
    raw = spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(raw_path)
    return (
        bronze_climate(raw)
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start(bronze_path)
    )
