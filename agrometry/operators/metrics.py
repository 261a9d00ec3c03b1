"""Row counts and ingest metrics, each in one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def counted_on_write(typed: DataFrame, counts: Observation, kept: str = "data IS NOT NULL") -> DataFrame:
    """The rows that a filter keeps; the query that writes them counts all on the way, without a scan of its own."""
    seen = typed.observe(counts, F.count("*").alias("registros_antes"), F.count_if(F.expr(kept)).alias("registros_depois"))
    return seen.where(kept)


def cleaning_facts(counts: Observation) -> dict[str, int]:
    """What was counted, once the writing query has ended."""
    before, after = (counts.get[name] for name in ("registros_antes", "registros_depois"))
    return {"registros_antes": before, "registros_depois": after, "removidos": before - after}


def cleaning_counts(typed: DataFrame, kept: str = "data IS NOT NULL") -> DataFrame:
    """Rows before and after a filter, and how many it removes."""
    before, after = F.count("*"), F.count_if(F.expr(kept))
    return typed.agg(
        before.alias("registros_antes"),
        after.alias("registros_depois"),
        (before - after).alias("removidos"),
    )


def table_not_empty(df: DataFrame) -> DataFrame:
    """One row: does the table hold any row?  Reads one row per task at most."""
    return df.select(F.lit(1).alias("um")).limit(1).agg((F.count("*") > 0).alias("tem_registros"))


def require_rows(df: DataFrame, name: str) -> DataFrame:
    if df.isEmpty():
        raise ValueError(f"tabela {name} está vazia")
    return df


def layer_totals(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows of each source of a layer, with the sum over all of them."""
    counts = None
    for name, df in tables.items():
        one = df.agg(F.count("*").alias("registros")).select(F.lit(name).alias("fonte"), "registros")
        counts = one if counts is None else counts.union(one)
    return counts.rollup("fonte").agg(
        F.sum("registros").alias("registros"), F.grouping("fonte").alias("_all")
    ).select(
        F.when(F.col("_all") == 1, F.lit("total")).otherwise(F.col("fonte")).alias("fonte"),
        "registros",
        F.when(F.col("registros") > 0, F.lit("success")).otherwise(F.lit("failed")).alias("status"),
    )


def ingest_metrics(status: DataFrame) -> DataFrame:
    """Totals over one row per file: ``sucesso``, ``linhas``, ``bytes``."""
    ok, files = F.count_if(F.col("sucesso")), F.count("*")

    def of_good(column: str):
        return F.coalesce(F.sum(F.when(F.col("sucesso"), F.col(column))), F.lit(0))

    return status.agg(
        files.alias("total_arquivos"),
        ok.alias("arquivos_ingeridos"),
        (files - ok).alias("arquivos_com_erro"),
        F.round(ok * 100.0 / F.greatest(files, F.lit(1)), 2).alias("taxa_sucesso"),
        of_good("linhas").alias("linhas_processadas"),
        of_good("bytes").alias("bytes_processados"),
    )


def require_ingested(metrics: DataFrame) -> DataFrame:
    """Fail when an ingest run stored no file."""
    if metrics.first()["arquivos_ingeridos"] == 0:
        raise ValueError("nenhum arquivo foi ingerido")
    return metrics
