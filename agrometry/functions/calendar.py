"""Southern-hemisphere seasons and Portuguese month names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels of the two routes, summer first.
SEASONS = ("Verão", "Outono", "Inverno", "Primavera")
WAREHOUSE_SEASONS = ("Verao", "Outono", "Inverno", "Primavera")
MONTHS = (
    "Janeiro", "Fevereiro", "Março", "Abril", "Maio", "Junho",
    "Julho", "Agosto", "Setembro", "Outubro", "Novembro", "Dezembro",
)


def _labels(names) -> Column:
    return F.array(*[F.lit(n) for n in names])


def _season_index(month: Column) -> Column:
    # December opens the summer quarter, so shift it to zero: 12,1,2 -> 0.
    return F.floor(month % 12 / 3).cast("int")


def season(month: Column) -> Column:
    """Accented label of the lake route; a missing month falls into the last one."""
    return F.coalesce(F.get(_labels(SEASONS), _season_index(month)), F.lit(SEASONS[-1]))


def warehouse_season(month: Column) -> Column:
    """Plain label of the warehouse route; a missing month has no season."""
    return F.get(_labels(WAREHOUSE_SEASONS), _season_index(month))


def season_order(label: Column) -> Column:
    """1 for summer up to 4 for spring (and for anything unknown)."""
    place = F.array_position(_labels(SEASONS), label)
    return F.when(place > 0, place).otherwise(len(SEASONS)).cast("int")


def month_name(month: Column) -> Column:
    return F.coalesce(F.get(_labels(MONTHS), month - 1), F.lit(MONTHS[-1]))
