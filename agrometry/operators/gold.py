"""Lake route: the crop risk fact and its reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from agrometry.functions import suitability
from agrometry.operators.joins import pair_all

CROP_COLUMNS = (
    "cultura", "categoria", "temp_min_ideal", "temp_max_ideal", "necessidade_de_agua",
    "tolerante_seca", "tolerante_frio", "sensivel_frio", "sensivel_calor",
)


def score_temperature(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "score_temperatura",
        suitability.temperature_score(F.col("temp_media"), F.col("temp_min_ideal"), F.col("temp_max_ideal")),
    )


RAIN_BAND = ("_chuva_min", "_chuva_max", "_chuva_critica")


def with_rain_band(crops: DataFrame) -> DataFrame:
    """The rain a crop needs, picked once per crop and not once per season."""
    return crops.withColumns(dict(zip(RAIN_BAND, suitability.rain_band(F.col("necessidade_de_agua")))))


def score_rain(df: DataFrame) -> DataFrame:
    band = tuple(map(F.col, RAIN_BAND)) if set(RAIN_BAND) <= set(df.columns) else None
    return df.withColumn(
        "score_precipitacao",
        suitability.rain_score(
            F.col("precipitacao_total_mm"), F.col("necessidade_de_agua"), F.col("dias_chuva"), band
        ),
    )


def classify(df: DataFrame) -> DataFrame:
    temp, rain = F.col("score_temperatura"), F.col("score_precipitacao")
    flags = [F.col(c) for c in CROP_COLUMNS[-4:]]
    return df.withColumns(
        {
            "score_final": suitability.final_score(temp, rain),
            "risco_geral": suitability.overall_risk(temp, rain, *flags),
        }
    ).withColumn("recomendacao", suitability.advice(F.col("risco_geral")))


def crop_risk_fact(seasonal: DataFrame, crops: DataFrame) -> DataFrame:
    """Every season scored for every crop.

    A seasonal table that keeps its station gives one row per station too.
    """
    station = [c for c in ("estacao_codigo",) if c in seasonal.columns]
    scored = (
        pair_all(seasonal, crops.select(*CROP_COLUMNS).transform(with_rain_band))
        .transform(score_temperature)
        .transform(score_rain)
        .transform(classify)
    )
    return scored.select(
        "cultura",
        "categoria",
        *station,
        "ano",
        "estacao",
        F.col("temp_media").alias("temp_real"),
        F.col("temp_min").alias("temp_min_real"),
        F.col("temp_max").alias("temp_max_real"),
        F.col("precipitacao_total_mm").alias("precipitacao_mm"),
        "dias_chuva",
        "umidade_media",
        *CROP_COLUMNS[2:],
        "score_temperatura",
        "score_precipitacao",
        "score_final",
        "risco_geral",
        "recomendacao",
    )


# Pairs that a row of counts stands for; a fact row stands for one.
PAIRS = "pares"
_NEEDS = tuple(suitability.RAIN_BANDS)


def risk_counts(seasonal: DataFrame, crops: DataFrame, *by: str) -> DataFrame:
    """How many pairs of a season and a crop fall into each risk class, by season and crop columns.

    A class depends on little: of a season, its temperature and the score of its rain for each water need; of a crop,
    its range, need and tolerances.  Both sides are first counted by these profiles, so the product grows with the
    number of different profiles and not with stations and years.
    """
    rain = {
        f"_chuva_{k}": suitability.rain_score(F.col("precipitacao_total_mm"), F.lit(need), F.col("dias_chuva"))
        for k, need in enumerate(_NEEDS)
    }
    seasons = seasonal.withColumns(rain).groupBy("estacao", "temp_media", *rain).agg(F.count("*").alias("_estacoes"))
    need = F.col("necessidade_de_agua")
    common = F.when(need.isNotNull(), F.when(need.isin(*_NEEDS), need).otherwise(suitability.RAIN_BAND_OTHER))
    known = crops.select(*dict.fromkeys((*by, *CROP_COLUMNS[2:]))).withColumn("necessidade_de_agua", common)
    known = known.groupBy(*known.columns).agg(F.count("*").alias("_culturas"))
    score = F.when(F.col("necessidade_de_agua").isNull(), suitability.UNKNOWN)
    for k, name in enumerate(_NEEDS):
        score = score.when(F.col("necessidade_de_agua") == name, F.col(f"_chuva_{k}"))
    scored = pair_all(seasons, known).transform(score_temperature).withColumn("score_precipitacao", score).transform(classify)
    return scored.groupBy("estacao", *by, "risco_geral").agg(F.sum(F.col("_estacoes") * F.col("_culturas")).alias(PAIRS))


def _pairs(fact: DataFrame):
    return F.col(PAIRS) if PAIRS in fact.columns else F.lit(1).cast("bigint")


def crop_ranking(fact: DataFrame, best: int = 10) -> DataFrame:
    """Best crops of each season.

    Catalyst keeps only ``best`` rows per season in every map task before the
    shuffle, so four seasons do not mean four overloaded tasks.  Name, year
    and station break ties.
    """
    ties = [F.col(c).asc() for c in ("cultura", "ano", "estacao_codigo") if c in fact.columns]
    order = Window.partitionBy("estacao").orderBy(F.col("score_final").desc(), *ties)
    return (
        fact.withColumn("ranking", F.row_number().over(order))
        .where(F.col("ranking") <= best)
        .select(
            "estacao", "ranking", "cultura", "categoria", "score_final", "risco_geral", "recomendacao"
        )
    )


def in_crop_order(fact: DataFrame) -> DataFrame:
    """By crop and season name, then year and station."""
    return fact.orderBy("cultura", "estacao", *[c for c in ("ano", "estacao_codigo") if c in fact.columns])


def risk_distribution(fact: DataFrame) -> DataFrame:
    """Pairs of each season and class, of a fact or of ``risk_counts``."""
    return fact.groupBy("estacao", "risco_geral").agg(F.sum(_pairs(fact)).alias("count"))


def executive_summary(fact: DataFrame) -> DataFrame:
    """Counts and shares of each risk class per season, in one pass over a fact or its ``risk_counts``."""
    every = F.sum(_pairs(fact))
    classes = {"baixo": "BAIXO", "medio": "MÉDIO", "alto": "ALTO", "critico": "CRÍTICO"}
    counts = {n: F.sum(F.when(F.col("risco_geral") == label, _pairs(fact)).otherwise(0)) for n, label in classes.items()}
    return fact.groupBy("estacao").agg(
        every.alias("total"),
        *[c.alias(n) for n, c in counts.items()],
        *[(c * 100.0 / F.nullif(every, F.lit(0))).alias(f"pct_{n}") for n, c in counts.items()],
    )


def _most_frequent_crops(fact: DataFrame, risks: tuple[str, ...], best: int) -> DataFrame:
    return (
        fact.where(F.col("risco_geral").isin(*risks))
        .groupBy("cultura", "categoria")
        .agg(F.sum(_pairs(fact)).alias("count"))
        .orderBy(F.col("count").desc(), "cultura", "categoria")
        .limit(best)
    )


def most_versatile_crops(fact: DataFrame, best: int = 5) -> DataFrame:
    return _most_frequent_crops(fact, ("BAIXO",), best)


def riskiest_crops(fact: DataFrame, best: int = 5) -> DataFrame:
    return _most_frequent_crops(fact, ("ALTO", "CRÍTICO"), best)
