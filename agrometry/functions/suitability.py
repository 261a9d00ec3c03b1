"""Crop suitability scores of the lake route, 0 (bad) to 100 (good).

All native expressions: they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Score levels, rain bands (minimum, maximum, critical) per
# water need, risk classes and their advice.
UNKNOWN = 50
IDEAL_TEMPERATURE = 95
TEMPERATURE_STEPS = ((3, 70), (6, 45))
TEMPERATURE_FAR = 20
RAIN_BANDS = {"Alta": (200, 500, 100), "Média": (100, 350, 50), "Baixa": (30, 200, 15)}
RAIN_BAND_OTHER = "Média"
WELL_SPREAD_DAYS = 15
RISK_CLASSES = ((80, "BAIXO"), (60, "MÉDIO"), (40, "ALTO"))
RISK_WORST = "CRÍTICO"
RISK_UNKNOWN = "INDEFINIDO"
ADVICE = {
    "BAIXO": "✅ IDEAL PARA PLANTIO",
    "MÉDIO": "⚠️ POSSÍVEL COM CUIDADOS",
    "ALTO": "⚠️ ALTO RISCO - EVITAR",
    "CRÍTICO": "❌ NÃO RECOMENDADO",
}
ADVICE_OTHER = "❓ DADOS INSUFICIENTES"


def temperature_score(temp: Column, ideal_min: Column, ideal_max: Column) -> Column:
    degrees_off = (
        F.when(temp < ideal_min, ideal_min - temp)
        .when(temp > ideal_max, temp - ideal_max)
        .otherwise(0)
    )
    known = temp.isNotNull() & ideal_min.isNotNull() & ideal_max.isNotNull()
    score = F.when(~known, UNKNOWN).when(degrees_off == 0, IDEAL_TEMPERATURE)
    for limit, points in TEMPERATURE_STEPS:
        score = score.when(degrees_off <= limit, points)
    return score.otherwise(TEMPERATURE_FAR)


def rain_band(need: Column) -> tuple[Column, Column, Column]:
    """Least, most and critical rain for a water need; unknown needs are average."""

    def pick(position: int) -> Column:
        table = F.create_map(*[F.lit(x) for k, band in RAIN_BANDS.items() for x in (k, band[position])])
        return F.coalesce(F.try_element_at(table, need), F.lit(RAIN_BANDS[RAIN_BAND_OTHER][position]))

    return pick(0), pick(1), pick(2)


def rain_score(
    rain_mm: Column,
    need: Column,
    rainy_days: Column,
    band: tuple[Column, Column, Column] | None = None,
) -> Column:
    """Score of a season's rain; ``band`` takes bounds that were picked before."""
    rain_mm = rain_mm.cast("double")
    low, high, critical = band or rain_band(need)
    return (
        F.when(rain_mm.isNull() | need.isNull() | F.isnan(rain_mm), UNKNOWN)
        .when(rain_mm < critical, 15)
        .when(rain_mm < low, 50)
        .when(rain_mm > high + 300, 30)
        .when(rain_mm > high, 60)
        .when(rainy_days >= WELL_SPREAD_DAYS, 95)
        .otherwise(80)
    )


def _weighted_tenths(temp_score: Column, rain: Column) -> Column:
    # 60 % temperature, 40 % rain, kept as whole tenths.
    return temp_score * 6 + rain * 4


def final_score(temp_score: Column, rain: Column) -> Column:
    """Weighted score alone; tolerance adjustments only move the class."""
    return F.round(_weighted_tenths(temp_score, rain) / 10, 0).cast("int")


def overall_risk(
    temp_score: Column,
    rain: Column,
    drought_tolerant: Column,
    cold_tolerant: Column,
    cold_sensitive: Column,
    heat_sensitive: Column,
) -> Column:
    adjustment = sum(
        (
            F.when(flag & hit, points).otherwise(0)
            for flag, hit, points in (
                (drought_tolerant, rain < 50, 15),
                (cold_tolerant, temp_score < 60, 15),
                (cold_sensitive, temp_score < 70, -20),
                (heat_sensitive, temp_score < 70, -20),
            )
        ),
        F.lit(0),
    )
    tenths = _weighted_tenths(temp_score, rain) + adjustment * 10
    risk = F.when(temp_score.isNull() | rain.isNull(), RISK_UNKNOWN)
    for limit, label in RISK_CLASSES:
        risk = risk.when(tenths >= limit * 10, label)
    return risk.otherwise(RISK_WORST)


def advice(risk: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in ADVICE.items() for x in pair])
    return F.coalesce(F.try_element_at(table, risk), F.lit(ADVICE_OTHER))
