"""Crop reference attributes read from free text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from agrometry.functions.numeric import first_below

# Water need and thermal profile.
WATER_SCORE = {"Alta": 3, "Média": 2, "Baixa": 1}
WATER_SCORE_OTHER = 2
THERMAL_PROFILES = ((15, "frio"), (22, "ameno"), (28, "quente"))
THERMAL_PROFILE_OTHER = "muito_quente"


def ideal_minimum(text: Column) -> Column:
    return F.regexp_extract(text, r"(\d+)-\d+", 1).try_cast("int")


def ideal_maximum(text: Column) -> Column:
    return F.regexp_extract(text, r"\d+-(\d+)", 1).try_cast("int")


def water_score(need: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in WATER_SCORE.items() for x in pair])
    return F.coalesce(F.try_element_at(table, need), F.lit(WATER_SCORE_OTHER))


def mentions(text: Column, *groups: tuple[str, ...]) -> Column:
    """True when every group has a word in the text; missing text mentions nothing."""
    low = F.lower(text)
    found = F.lit(True)
    for words in groups:
        any_word = F.lit(False)
        for word in words:
            any_word = any_word | low.contains(word)
        found = found & any_word
    return F.coalesce(found, F.lit(False))


def tolerance_flags(notes: Column) -> dict[str, Column]:
    return {
        "tolerante_seca": mentions(notes, ("tolerante",), ("seca",)),
        "tolerante_frio": mentions(notes, ("tolerante", "resistente"), ("frio",)),
        "sensivel_frio": mentions(notes, ("sensível",), ("frio",)),
        "sensivel_calor": mentions(notes, ("sensível",), ("calor",)),
    }


def midpoint(low: Column, high: Column) -> Column:
    return (low + high) / 2


def thermal_profile(mid: Column) -> Column:
    """A crop without an ideal range counts as the hottest profile."""
    return first_below(mid, THERMAL_PROFILES, THERMAL_PROFILE_OTHER)


def hardiness(drought_tolerant: Column, cold_tolerant: Column, water: Column) -> Column:
    bonus = [F.when(flag, 2).otherwise(0) for flag in (drought_tolerant, cold_tolerant)]
    return bonus[0] + bonus[1] + (4 - water)
