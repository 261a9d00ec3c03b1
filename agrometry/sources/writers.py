"""File and table sinks."""

from __future__ import annotations

import time
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from agrometry.sources.raw_store import BUCKETS, replace_files
from agrometry.sources.scratch import forget_versions

CHUNK_ROWS = 500_000
# Folder of a schema that holds the rows of its tables, one folder for each load.
VERSIONS_FOLDER = "_versoes"


def as_text(df: DataFrame) -> DataFrame:
    """Every column as a string; missing cells stay NULL, never ``'nan'``."""
    return df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])


def _balanced(df: DataFrame, *keys: str) -> DataFrame:
    """Files of even size per partition value.

    A plain repartition by the value would send a hot year or season to one
    task; the rebalance hint lets the engine split it and merge the small ones.
    """
    return df.hint("rebalance", *keys)


def write_raw(df: DataFrame, path: str, year_column: str = "year", buckets: int = BUCKETS) -> None:
    """All-string Parquet by year in a raw store; rows without a year go to ``raw``.

    Only the source files in ``df`` are replaced; what other runs have written of other files stays.
    """
    text = as_text(df)
    year = F.col(year_column) if year_column in df.columns else F.lit(None).cast("string")
    replace_files(text.withColumn("year", F.coalesce(year.cast("string"), F.lit("raw"))), path, buckets)


def write_layer(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    if partition_by is None:
        df.write.mode("overwrite").parquet(path)
    else:
        _balanced(df, partition_by).write.mode("overwrite").partitionBy(partition_by).parquet(path)


def blank_to_null(df: DataFrame) -> DataFrame:
    """Empty strings are NULL in the warehouse."""
    return df.select(
        *[
            F.nullif(F.col(f"`{f.name}`"), F.lit("")).alias(f.name)
            if isinstance(f.dataType, StringType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def create_schema(spark: SparkSession, schema: str, location: str | None = None) -> None:
    """Create a namespace if it is missing, in the given folder if one is named."""
    where = f" LOCATION '{location}/{schema}.db'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{schema}`{where}")


def _home(spark: SparkSession, schema: str, location: str | None) -> str:
    return f"{location}/{schema}.db" if location else spark.catalog.getDatabase(schema).locationUri


def load_table(df: DataFrame, table: str, schema: str = "bronze", location: str | None = None) -> None:
    """Replace ``schema.table`` in the session catalog, in ``location`` if one is named.

    Rows are written to a folder of their own beside the present ones.  Then one change in the catalog points the table
    there, so readers see the old rows or the new, and a load that fails half-way leaves the old table as it was.  Only
    a table that gets other columns takes two changes.  The version before is kept for its readers, older ones go.
    """
    spark = df.sparkSession
    create_schema(spark, schema, location)
    versions = f"{_home(spark, schema, location)}/{VERSIONS_FOLDER}/{table}"
    place, name = f"{versions}/{time.time_ns():020d}-{uuid4().hex[:8]}", f"`{schema}`.`{table}`"
    rows = blank_to_null(df)
    rows.write.parquet(place)
    known = spark.catalog.tableExists(name)
    if known and spark.table(name).schema.simpleString() == rows.schema.simpleString():
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{place}'")
    else:
        if known:
            spark.sql(f"DROP TABLE {name}")
        spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{place}'")
    spark.catalog.refreshTable(name)
    forget_versions(spark, versions, keep=2)


def load_tables(
    tables: dict[str, DataFrame], only: str = "todas", schema: str = "bronze", location: str | None = None
) -> None:
    """Load the named table, or all of them."""
    if only != "todas" and only not in tables:
        raise ValueError(f"tabela desconhecida: {only}")
    for name, df in tables.items():
        if only in ("todas", name):
            load_table(df, name, schema, location)


def load_jdbc(df: DataFrame, url: str, table: str, schema: str = "bronze", connections: int = 16, **options: str) -> None:
    """Replace a table of an external database.

    Executors insert in parallel over at most ``connections`` connections, in
    batches, so no process ever holds the table.
    """
    (
        blank_to_null(df)
        .write.format("jdbc")
        .mode("overwrite")
        .option("url", url)
        .option("dbtable", f"{schema}.{table}")
        .option("batchsize", CHUNK_ROWS)
        .option("numPartitions", connections)
        .options(**options)
        .save()
    )


def create_view(spark: SparkSession, text: str, name: str, schema: str, location: str | None = None) -> DataFrame:
    """Keep a query in the catalog; every session on it reads the view, always over the present tables."""
    create_schema(spark, schema, location)
    spark.sql(f"CREATE OR REPLACE VIEW `{schema}`.`{name}` AS {text}")
    return spark.table(f"`{schema}`.`{name}`")


def materialize(model: DataFrame | str, name: str, kind: str, schema: str, location: str | None = None, spark: SparkSession | None = None) -> DataFrame:
    """Keep a model as a ``view`` or as a ``table`` of its layer's schema.

    A view is given as SQL over tables and lasts in the catalog; a DataFrame's plan can only be a view of its session.
    """
    if kind not in ("view", "table"):
        raise ValueError(f"materialização desconhecida: {kind}")
    spark = spark or model.sparkSession
    if isinstance(model, str):
        if kind == "view":
            return create_view(spark, model, name, schema, location)
        model = spark.sql(model)
    if kind == "view":
        model.createOrReplaceTempView(f"{schema}_{name}")
        return spark.table(f"{schema}_{name}")
    load_table(model, name, schema, location)
    return spark.table(f"`{schema}`.`{name}`")


def sample_rows(df: DataFrame, rows: int = 20) -> DataFrame:
    return df.limit(rows)
