"""Lake route end to end: raw to bronze, silver and gold Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from agrometry.operators.metrics import layer_totals
from agrometry.plans import jobs
from agrometry.sources.readers import read_layer
from agrometry.sources.session import compiled_methods


def lake_paths(lake: str) -> dict[str, str]:
    """Where each table of the lake lives."""
    layout = {
        "bronze": ("clima", "culturas"),
        "silver": ("dim_tempo", "clima_diario", "clima_mensal", "clima_estacional", "culturas"),
        "gold": ("fato_risco_climatico", "relatorios"),
    }
    return {f"{layer}.{name}": f"{lake}/{layer}/{name}" for layer, names in layout.items() for name in names}


def bronze_layer(spark: SparkSession, raw_climate: str, raw_crops, lake: str) -> DataFrame:
    """Write both bronze tables; returns their row counts and the total."""
    at = lake_paths(lake)
    return layer_totals(
        {
            "clima": jobs.processar_clima_bronze(spark, raw_climate, at["bronze.clima"]),
            "culturas": jobs.processar_culturas_bronze(spark, raw_crops, at["bronze.culturas"]),
        }
    )


def silver_layer(spark: SparkSession, lake: str) -> None:
    """Write the silver tables, each from the written level below it."""
    at = lake_paths(lake)
    jobs.criar_dim_tempo(spark, read_layer(spark, at["bronze.clima"]), at["silver.dim_tempo"])
    jobs.agregar_clima_diario(spark, at["bronze.clima"], at["silver.clima_diario"])
    jobs.agregar_clima_mensal(spark, at["silver.clima_diario"], at["silver.clima_mensal"])
    jobs.agregar_clima_estacional(spark, at["silver.clima_mensal"], at["silver.clima_estacional"])
    jobs.enriquecer_culturas(spark, at["bronze.culturas"], at["silver.culturas"])


def gold_layer(spark: SparkSession, lake: str) -> None:
    """Write the risk fact by season, and its two reports."""
    at = lake_paths(lake)
    jobs.gerar_fato_risco_climatico(
        spark, at["silver.clima_estacional"], at["silver.culturas"], at["gold.fato_risco_climatico"]
    )
    jobs.gerar_relatorio_resumido(spark, at["gold.fato_risco_climatico"], at["gold.relatorios"])


def run(spark: SparkSession, raw_climate: str, raw_crops, lake: str) -> dict[str, DataFrame]:
    """Whole chain.  Returns the answers: summary, most versatile and riskiest crops.

    Every layer is a written table, which also cuts the lineage: an executor
    lost in a late step never makes an early one run again.
    """
    compiled_methods(spark)
    bronze_layer(spark, raw_climate, raw_crops, lake)
    silver_layer(spark, lake)
    gold_layer(spark, lake)
    return jobs.exibir_resposta_pergunta(spark, lake_paths(lake)["gold.fato_risco_climatico"])
