"""Warehouse route: staging, monthly and seasonal climate, risk mart.

Unlike the lake route it keeps the station at every level, counts rainy hours
where the column says days, and uses labels without accents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agrometry.functions import calendar, risk
from agrometry.functions.numeric import as_numeric, highest, lowest, mean, total
from agrometry.operators.bronze import MEASURES
from agrometry.operators.joins import pair_all

STATION = ("estacao_codigo", "estacao_nome", "uf")


_DAY = "CAST(data AS date)"
_CLIMATE = {
    **{c: c for c in STATION}, "data": _DAY, "hora_utc": "hora_utc", "ano": f"year({_DAY})", "mes": f"month({_DAY})",
    **{c: f"CAST({c} AS double)" for c in MEASURES},
}
_CROPS = {
    **{c: c for c in ("cultura", "categoria", "clima_ideal")},
    **{c: f"CAST({c} AS int)" for c in ("temp_min_ideal", "temp_max_ideal")},
    "necessidade_de_agua": "necessidade_de_agua",
    "necessidade_agua_score": "CAST(necessidade_agua_score AS int)",
    **{c: f"CAST({c} AS boolean)" for c in ("tolerante_seca", "tolerante_frio", "sensivel_frio", "sensivel_calor")},
}


def _selected(columns: dict[str, str]) -> str:
    return ", ".join(f"{value} AS {name}" for name, value in columns.items())


# Both staging models as SQL over ``{bronze}``: a table's name makes a view, a DataFrame a plan.
STAGED_CLIMATE = f"SELECT DISTINCT {_selected(_CLIMATE)} FROM {{bronze}} WHERE data IS NOT NULL AND coalesce(temperatura_c BETWEEN -40 AND 60, true)"
STAGED_CROPS = f"SELECT {_selected(_CROPS)} FROM {{bronze}} WHERE cultura IS NOT NULL"


def staged_climate(bronze: DataFrame) -> DataFrame:
    """Typed hourly rows with a date and a possible temperature, each once."""
    return bronze.sparkSession.sql(STAGED_CLIMATE, bronze=bronze)


def staged_crops(bronze: DataFrame) -> DataFrame:
    return bronze.sparkSession.sql(STAGED_CROPS, bronze=bronze)


def monthly_climate(staged: DataFrame) -> DataFrame:
    temp, high, low = (F.col(c) for c in ("temperatura_c", "temp_max_c", "temp_min_c"))
    rain, humidity = F.col("precipitacao_mm"), F.col("umidade_pct")
    return staged.groupBy(*STATION, "ano", "mes").agg(
        as_numeric(mean(temp)).alias("temp_media_c"),
        as_numeric(highest(high)).alias("temp_max_c"),
        as_numeric(lowest(low)).alias("temp_min_c"),
        as_numeric(mean(high)).alias("temp_max_media_c"),
        as_numeric(mean(low)).alias("temp_min_media_c"),
        as_numeric(total(rain)).alias("precipitacao_total_mm"),
        F.count_if(rain > 0).alias("dias_com_chuva"),
        as_numeric(mean(humidity)).alias("umidade_media_pct"),
        as_numeric(lowest(humidity)).alias("umidade_min_pct"),
        as_numeric(mean(F.col("vento_velocidade_ms"))).alias("vento_medio_ms"),
        F.count("*").alias("total_medicoes"),
    )


def seasonal_climate(monthly: DataFrame) -> DataFrame:
    """Per station, year and season; a whole season has three months."""
    return (
        monthly.withColumn("estacao_ano", calendar.warehouse_season(F.col("mes")))
        .groupBy(*STATION, "ano", "estacao_ano")
        .agg(
            *[
                as_numeric(how(F.col(c))).alias(c)
                for c, how in (
                    ("temp_media_c", mean),
                    ("temp_max_c", highest),
                    ("temp_min_c", lowest),
                    ("temp_max_media_c", mean),
                    ("temp_min_media_c", mean),
                    ("precipitacao_total_mm", total),
                )
            ],
            F.sum("dias_com_chuva").alias("dias_com_chuva"),
            as_numeric(mean(F.col("umidade_media_pct"))).alias("umidade_media_pct"),
            as_numeric(lowest(F.col("umidade_min_pct"))).alias("umidade_min_pct"),
            F.count("*").alias("meses_no_periodo"),
        )
    )


def risk_mart(seasonal: DataFrame, staged: DataFrame) -> DataFrame:
    """Drought, cold and heat risk of every station season for every crop."""
    climate = (
        "temp_media_c", "temp_max_c", "temp_min_c",
        "precipitacao_total_mm", "dias_com_chuva", "umidade_media_pct",
    )
    limits = (
        "temp_min_ideal", "temp_max_ideal", "necessidade_agua_score",
        "tolerante_seca", "tolerante_frio", "sensivel_frio", "sensivel_calor",
    )
    # What depends on one side only is worked out before the rows multiply.
    dry = risk.dryness(F.col("precipitacao_total_mm")).alias("_seca")
    thirsty = risk.thirst(F.col("necessidade_agua_score"), F.col("tolerante_seca")).alias("_sede")
    pairs = pair_all(
        seasonal.select(*STATION, "ano", "estacao_ano", *climate, dry),
        staged.select("cultura", "categoria", *limits, thirsty),
    )
    parts = [F.col(c) for c in ("risco_seca", "risco_frio", "risco_calor")]
    return (
        pairs.withColumns(
            {
                "risco_seca": risk.drought_risk(F.col("_seca"), F.col("_sede")),
                "risco_frio": risk.cold_risk(
                    F.col("temp_min_c"), F.col("temp_min_ideal"), F.col("tolerante_frio"), F.col("sensivel_frio")
                ),
                "risco_calor": risk.heat_risk(
                    F.col("temp_max_c"), F.col("temp_max_ideal"), F.col("sensivel_calor")
                ),
            }
        )
        .withColumns(
            {"risco_total": risk.total_risk(*parts), "classificacao_risco": risk.risk_class(*parts)}
        )
        .select(
            *STATION, "ano", "estacao_ano", "cultura", "categoria", *climate, *limits,
            "risco_seca", "risco_frio", "risco_calor", "risco_total", "classificacao_risco",
        )
    )


# Highest risk first; the keys after the risk make the order total.
RISK_ORDER = ["risco_total", "estacao_codigo", "ano", "estacao_ano", "cultura"]
RISK_ASCENDING = [False, True, True, True, True]


def by_risk(mart: DataFrame) -> DataFrame:
    """The mart in its order, for reading.

    Files are written sorted each in itself: a sort of the whole mart would work out the product twice.
    """
    return mart.orderBy(RISK_ORDER, ascending=RISK_ASCENDING)


def top_risks(mart: DataFrame, best: int = 20) -> DataFrame:
    return (
        mart.where(F.col("classificacao_risco").isin("Alto", "Critico"))
        .orderBy(
            F.col("risco_total").desc(), "cultura", "uf", "estacao_codigo", "ano", "estacao_ano"
        )
        .limit(best)
        .select("cultura", "uf", "estacao_ano", "risco_total", "classificacao_risco")
    )


def rows_per_station(climate: DataFrame) -> DataFrame:
    return (
        climate.groupBy(*STATION)
        .agg(F.count("*").alias("registros"))
        .orderBy(F.col("registros").desc(), *STATION)
    )
