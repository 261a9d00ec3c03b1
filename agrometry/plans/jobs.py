"""Path-in, path-out form of each lake step, under its public name.

Fixed values: the names of the jobs and of their parameters.

Each job writes its table and returns it read back, so later actions on the
result read the table and never work it out again.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, Observation, SparkSession

from agrometry.operators import bronze, gold, silver
from agrometry.operators.metrics import cleaning_facts
from agrometry.sources.readers import list_files, read_layer, read_raw, read_reference_csv, read_weather_csv
from agrometry.sources.writers import write_layer


def _stored(df: DataFrame, path: str, partition_by: str | None = None) -> DataFrame:
    write_layer(df, path, partition_by)
    return read_layer(df.sparkSession, path)


def _is_csv(spark: SparkSession, path: str) -> bool:
    """A CSV file by its name, or a folder with CSV files at any depth."""
    return path.lower().endswith(".csv") or not list_files(spark, path, "*.[cC][sS][vV]").isEmpty()


def read_climate(spark: SparkSession, path: str) -> DataFrame:
    """Raw weather rows from CSV files or from a raw Parquet tree."""
    return read_weather_csv(spark, path) if _is_csv(spark, path) else read_raw(spark, path)


def read_crops(spark: SparkSession, paths: str | list[str] | tuple[str, ...]) -> list[DataFrame]:
    many = [paths] if isinstance(paths, str) else list(paths)
    return [read_reference_csv(spark, p) if _is_csv(spark, p) else read_raw(spark, p) for p in many]


def processar_clima_bronze(spark: SparkSession, input_path: str, output_path: str) -> DataFrame:
    raw = read_climate(spark, input_path)
    if unused := bronze.unused_weather_headers(raw.columns):
        logging.getLogger(__name__).warning("colunas sem uso na camada bronze: %s", unused)
    counts = Observation("limpeza")
    stored = _stored(bronze.bronze_climate(raw, counts), output_path)
    logging.getLogger(__name__).info("limpeza: %s", cleaning_facts(counts))
    return stored


def processar_culturas_bronze(spark: SparkSession, input_path, output_path: str) -> DataFrame:
    return _stored(bronze.bronze_crops(read_crops(spark, input_path)), output_path)


def criar_dim_tempo(spark: SparkSession, df_clima: DataFrame, output_path: str) -> DataFrame:
    return _stored(silver.time_dimension(df_clima), output_path)


def agregar_clima_diario(spark: SparkSession, bronze_path: str, output_path: str) -> DataFrame:
    daily = silver.daily_climate(read_layer(spark, bronze_path))
    return _stored(bronze.with_layer(daily, "silver"), output_path)


def agregar_clima_mensal(spark: SparkSession, diario_path: str, output_path: str) -> DataFrame:
    return _stored(silver.monthly_climate(read_layer(spark, diario_path)), output_path)


def agregar_clima_estacional(spark: SparkSession, mensal_path: str, output_path: str) -> DataFrame:
    return _stored(silver.seasonal_climate(read_layer(spark, mensal_path)), output_path)


def enriquecer_culturas(spark: SparkSession, bronze_path: str, output_path: str) -> DataFrame:
    return _stored(silver.enrich_crops(read_layer(spark, bronze_path)), output_path)


def gerar_fato_risco_climatico(
    spark: SparkSession, clima_estacional_path: str, culturas_path: str, output_path: str
) -> DataFrame:
    fact = gold.crop_risk_fact(read_layer(spark, clima_estacional_path), read_layer(spark, culturas_path))
    return _stored(bronze.with_layer(fact, "gold").drop("camada"), output_path, partition_by="estacao")


def gerar_relatorio_resumido(spark: SparkSession, gold_path: str, output_path: str) -> DataFrame:
    """Ranking and distribution reports; returns the ranking."""
    fact = read_layer(spark, gold_path)
    write_layer(gold.risk_distribution(fact), f"{output_path}/distribuicao_risco")
    return _stored(gold.crop_ranking(fact), f"{output_path}/ranking_culturas")


def exibir_resposta_pergunta(spark: SparkSession, gold_path: str) -> dict[str, DataFrame]:
    """Summary per season, most versatile and riskiest crops, as tables to show."""
    fact = read_layer(spark, gold_path)
    return {
        "resumo_executivo": silver.in_season_order(gold.executive_summary(fact)),
        "top_versateis": gold.most_versatile_crops(fact),
        "top_arriscadas": gold.riskiest_crops(fact),
    }
