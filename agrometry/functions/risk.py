"""Drought, cold and heat risk of the warehouse route.

Inputs are one-decimal ``DECIMAL`` measures, so every product and comparison
is exact.  The drought score is ten times the 0-10 scale of the other two
(0-100), and missing rain scores as the worst drought, because ``greatest`` and
``least`` skip NULLs; both are the defined results.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from agrometry.functions.numeric import first_below

# Class limits on the mean of the three scores.
RISK_CLASSES = ((2.0, "Baixo"), (4.5, "Medio"), (7.0, "Alto"))
RISK_WORST = "Critico"

_SCORE = "decimal(6,1)"


def _dec(value, kind: str) -> Column:
    return F.lit(value).cast(kind)


def dryness(rain_mm: Column) -> Column:
    """Missing share of 300 mm of rain; belongs to a season, whatever the crop.

    A decimal(18,0) divisor makes Spark keep 20 digits of the quotient, as
    many as the warehouse engine keeps; ties at the last digit depend on it.
    """
    return _dec(1, "decimal(1,0)") - rain_mm.cast("decimal(9,1)") / _dec(300, "decimal(18,0)")


def thirst(water: Column, drought_tolerant: Column) -> Column:
    """Weight of dryness for a crop, whatever the season: tenfold, less 30 % if tolerant."""
    relief = F.when(drought_tolerant, _dec(7, "decimal(2,0)")).otherwise(_dec(10, "decimal(2,0)"))
    return water.cast("decimal(3,0)") * relief


def drought_risk(dry: Column, thirsty: Column) -> Column:
    weighted = dry * thirsty
    clamped = F.greatest(_dec(0, "decimal(3,0)"), F.least(_dec(100, "decimal(3,0)"), weighted))
    return F.round(clamped, 1).cast(_SCORE)


def _excess(degrees: Column, sensitive: Column) -> Column:
    weight = F.when(sensitive, _dec("1.5", "decimal(2,1)")).otherwise(_dec(1, "decimal(2,1)"))
    capped = F.least(_dec(10, "decimal(2,0)"), degrees.cast("decimal(9,1)") * weight)
    return F.when(degrees > 0, F.round(capped, 1)).otherwise(0).cast(_SCORE)


def cold_risk(temp_min: Column, ideal_min: Column, cold_tolerant: Column, cold_sensitive: Column) -> Column:
    exempt = F.coalesce(cold_tolerant, F.lit(False))
    return F.when(exempt, 0).otherwise(_excess(ideal_min - temp_min, cold_sensitive)).cast(_SCORE)


def heat_risk(temp_max: Column, ideal_max: Column, heat_sensitive: Column) -> Column:
    return _excess(temp_max - ideal_max, heat_sensitive)


def total_risk(drought: Column, cold: Column, heat: Column) -> Column:
    return F.round((drought + cold + heat) / _dec(3, "decimal(1,0)"), 1).cast(_SCORE)


def risk_class(drought: Column, cold: Column, heat: Column) -> Column:
    """Class of the mean before it is rounded."""
    limits = [(_dec(str(limit * 3), "decimal(4,1)"), name) for limit, name in RISK_CLASSES]
    return first_below(drought + cold + heat, limits, RISK_WORST)
