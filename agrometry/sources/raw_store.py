"""The raw store: text tables by year and hash bucket, replaced file by file.

Rows lie under ``year=<y>/balde=<k>``, where the bucket follows from the source file's name.  So the number of folders
is bounded by years times buckets, however many source files there are, and a run that brings some files again
rewrites only their buckets: it reads a touched bucket, leaves out the old rows of those files, and adds the new ones.

The columns ever written are a small table beside the data, which grows when a run brings a new column.  Reading takes
its schema from there; a column that a file lacks is NULL.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from agrometry.operators.bronze import SOURCE_FILE
from agrometry.operators.joins import join_checked
from agrometry.sources.scratch import kept_in_scratch

BUCKET = "balde"
BUCKETS = 16
# Folder of the list of columns; readers skip names that begin with an underscore.
COLUMNS_FOLDER = "_colunas"
_LISTED = "ordem int, coluna string, baldes int"


def _source(df: DataFrame) -> Column:
    return F.coalesce(F.col(SOURCE_FILE), F.lit("")) if SOURCE_FILE in df.columns else F.lit("")


def _listed(spark: SparkSession, path: str) -> list:
    try:
        return spark.read.schema(_LISTED).json(f"{path}/{COLUMNS_FOLDER}").orderBy("ordem", "coluna").collect()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return []


def store_columns(spark: SparkSession, path: str) -> list[str]:
    """The columns ever written to a store, in the order they came; none for any other folder."""
    return list(dict.fromkeys(r["coluna"] for r in _listed(spark, path)))


def _bucket_count(spark: SparkSession, path: str, wanted: int) -> int:
    return next((r["baldes"] for r in _listed(spark, path)), wanted)


def _add_columns(spark: SparkSession, path: str, columns: list[str], buckets: int) -> None:
    """List new columns before data that has them, so that no reader misses one."""
    known = store_columns(spark, path)
    fresh = [c for c in columns if c not in known]
    if fresh:
        rows = [(len(known) + k, c, buckets) for k, c in enumerate(fresh)]
        spark.createDataFrame(rows, _LISTED).coalesce(1).write.mode("append").json(f"{path}/{COLUMNS_FOLDER}")


def _stored(spark: SparkSession, path: str) -> DataFrame:
    fields = [StructField(c, StringType()) for c in store_columns(spark, path)]
    fields += [StructField("year", StringType()), StructField(BUCKET, IntegerType())]
    return spark.read.schema(StructType(fields)).option("basePath", path).parquet(path)


def read_store(spark: SparkSession, path: str) -> DataFrame:
    return _stored(spark, path).drop(BUCKET)


def replace_files(text: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """Write rows (all text, with ``year``) and replace what the store holds of their source files in the same years.

    A store keeps the number of buckets it was begun with.
    """
    spark = text.sparkSession
    begun = bool(store_columns(spark, path))
    buckets = _bucket_count(spark, path, buckets)
    bucket = lambda df: F.pmod(F.xxhash64(_source(df)), F.lit(buckets)).cast("int")
    rows = text.withColumn(BUCKET, bucket(text))
    _add_columns(spark, path, [c for c in text.columns if c != "year"], buckets)
    if begun:
        brought = kept_in_scratch(rows.select("year", BUCKET, _source(rows).alias("_file")).distinct(), "trocados")
        # at most one row for each year and bucket
        touched = [f"{r[0]}/{r[1]}" for r in brought.select("year", BUCKET).distinct().collect()]
        old = _stored(spark, path).where(F.concat_ws("/", "year", BUCKET).isin(touched))
        old = old.withColumn("_key", F.concat_ws("/", "year", _source(old)))
        gone = brought.select(F.concat_ws("/", "year", "_file").alias("_key"))
        rows = rows.unionByName(join_checked(old, gone, "_key", "left_anti").drop("_key"), allowMissingColumns=True)
    # the hint splits a hot bucket into several files and writes each small one as one file
    rows.hint("rebalance", "year", BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year", BUCKET).parquet(path)
