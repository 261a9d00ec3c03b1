"""Settings of the session that queries need."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: HotSpot never compiles a longer method, and interprets it row by row.
COMPILED_BYTES = 8_000


def compiled_methods(spark: SparkSession) -> None:
    """Let Spark split the code of a stage that the JVM would not compile as one method.

    A stage with many parsed or scored columns otherwise runs interpreted, several times slower; results are the same.
    """
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", str(COMPILED_BYTES))
