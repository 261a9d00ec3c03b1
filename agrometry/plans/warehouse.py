"""Warehouse route end to end: bronze to staging, intermediate and mart."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from agrometry.operators import warehouse
from agrometry.sources.session import compiled_methods
from agrometry.sources.writers import load_tables, materialize


def risk_mart(bronze_climate: DataFrame, bronze_crops: DataFrame) -> DataFrame:
    """The mart as one lazy plan over the two bronze tables."""
    monthly = warehouse.monthly_climate(warehouse.staged_climate(bronze_climate))
    return warehouse.risk_mart(warehouse.seasonal_climate(monthly), warehouse.staged_crops(bronze_crops))


def build_models(
    spark: SparkSession, climate: DataFrame, crops: DataFrame, location: str | None = None, prefix: str = ""
) -> dict[str, DataFrame]:
    """Load bronze, then keep staging as views and the rest as tables, each in its layer's schema.

    All models are in the catalog, so other sessions read them by name.  ``prefix`` goes before the schemas' names.
    """
    compiled_methods(spark)
    bronze, silver, gold = (prefix + layer for layer in ("bronze", "silver", "gold"))
    load_tables({"clima": climate, "culturas": crops}, schema=bronze, location=location)
    views = {"stg_clima": (warehouse.STAGED_CLIMATE, "clima"), "stg_culturas": (warehouse.STAGED_CROPS, "culturas")}
    models = {}
    for name, (text, source) in views.items():
        over = text.format(bronze=f"`{bronze}`.`{source}`")
        models[name] = materialize(over, name, "view", silver, location, spark)
    monthly = warehouse.monthly_climate(models["stg_clima"])
    models["int_clima_mensal"] = materialize(monthly, "int_clima_mensal", "table", silver, location)
    seasonal = warehouse.seasonal_climate(models["int_clima_mensal"])
    models["int_clima_sazonal"] = materialize(seasonal, "int_clima_sazonal", "table", silver, location)
    mart = warehouse.risk_mart(models["int_clima_sazonal"], models["stg_culturas"])
    mart = mart.sortWithinPartitions(warehouse.RISK_ORDER, ascending=warehouse.RISK_ASCENDING)
    models["fct_risco_climatico"] = materialize(mart, "fct_risco_climatico", "table", gold, location)
    return models
