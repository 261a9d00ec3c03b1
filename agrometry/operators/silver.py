"""Lake route: hour to day, month and season; time and crop dimensions.

Each level averages the level below it, so seasonal means are means of
monthly means.  The seasonal level drops the station on purpose.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agrometry.functions import calendar, crops
from agrometry.functions.numeric import as_double, highest, lowest, mean, total


def time_dimension(climate: DataFrame) -> DataFrame:
    d = F.col("data")
    return climate.select("data").distinct().select(
        d,
        F.year(d).alias("ano"),
        F.month(d).alias("mes"),
        F.dayofmonth(d).alias("dia"),
        F.quarter(d).alias("trimestre"),
        calendar.season(F.month(d)).alias("estacao"),
        calendar.month_name(F.month(d)).alias("nome_mes"),
    )


def daily_climate(bronze: DataFrame) -> DataFrame:
    return bronze.groupBy("data", "estacao_codigo", "estacao_nome", "uf").agg(
        as_double(mean(F.col("temperatura_c"))).alias("temp_media"),
        as_double(lowest(F.col("temp_min_c"))).alias("temp_min"),
        as_double(highest(F.col("temp_max_c"))).alias("temp_max"),
        as_double(total(F.col("precipitacao_mm"))).alias("precipitacao_mm"),
        as_double(mean(F.col("umidade_pct"))).alias("umidade_media"),
        as_double(total(F.col("radiacao_kj_m2"), 0)).alias("radiacao_total"),
        F.count("*").alias("qtd_registros"),
    )


def monthly_climate(daily: DataFrame) -> DataFrame:
    """Per station and month; rainy days are days with a positive total."""
    rainy = F.when(F.col("precipitacao_mm") > 0, 1).otherwise(0)
    return (
        daily.withColumns({"ano": F.year("data"), "mes": F.month("data")})
        .groupBy("ano", "mes", "estacao_codigo")
        .agg(
            as_double(mean(F.col("temp_media"))).alias("temp_media_mensal"),
            as_double(lowest(F.col("temp_min"))).alias("temp_min_absoluta"),
            as_double(highest(F.col("temp_max"))).alias("temp_max_absoluta"),
            as_double(total(F.col("precipitacao_mm"))).alias("precipitacao_total_mm"),
            as_double(mean(F.col("umidade_media"))).alias("umidade_media_mensal"),
            F.sum(rainy).alias("dias_chuva"),
            F.count("*").alias("dias_no_mes"),
        )
        .withColumn("estacao", calendar.season(F.col("mes")))
    )


def seasonal_climate(monthly: DataFrame, keep_station: bool = False) -> DataFrame:
    """Per year and season over all stations.

    ``keep_station`` keeps one row per station, for risk by place.
    """
    keys = ["ano", "estacao"] + (["estacao_codigo"] if keep_station else [])
    return monthly.groupBy(*keys).agg(
        as_double(mean(F.col("temp_media_mensal"))).alias("temp_media"),
        as_double(lowest(F.col("temp_min_absoluta"))).alias("temp_min"),
        as_double(highest(F.col("temp_max_absoluta"))).alias("temp_max"),
        as_double(total(F.col("precipitacao_total_mm"))).alias("precipitacao_total_mm"),
        as_double(mean(F.col("umidade_media_mensal"))).alias("umidade_media"),
        F.sum("dias_chuva").alias("dias_chuva"),
    )


def in_season_order(df: DataFrame) -> DataFrame:
    """Summer, autumn, winter, spring; years and the rest break ties."""
    rest = [c for c in ("ano", "estacao", "estacao_codigo") if c in df.columns]
    return df.orderBy(calendar.season_order(F.col("estacao")), *rest)


def in_date_order(df: DataFrame) -> DataFrame:
    """By date, then station."""
    return df.orderBy("data", *[c for c in ("estacao_codigo", "estacao_nome", "uf") if c in df.columns])


def in_month_order(df: DataFrame) -> DataFrame:
    return df.orderBy("ano", "mes", *[c for c in ("estacao_codigo",) if c in df.columns])


def enrich_crops(bronze: DataFrame) -> DataFrame:
    low, high = F.col("temp_min_ideal"), F.col("temp_max_ideal")
    middle = crops.midpoint(low, high)
    return bronze.withColumns(
        {
            "temp_media_ideal": middle,
            "perfil_temperatura": crops.thermal_profile(middle),
            "amplitude_termica": high - low,
            "score_rusticidade": crops.hardiness(
                F.col("tolerante_seca"), F.col("tolerante_frio"), F.col("necessidade_agua_score")
            ),
        }
    )
