"""Rule sets of the three sources and of the warehouse."""

from __future__ import annotations

from agrometry.quality.rules import WARNING, KeywordRange, NotEmpty, NotNull, RequiredColumns

# Rule names, keywords, limits and severities.
TEMPERATURE = KeywordRange(
    "temperatura_valida", ("TEMP",), -15, 50, "fora do range (-15°C a 50°C)", WARNING
)
HUMIDITY = KeywordRange("umidade_valida", ("UMID",), 0, 100, "fora do range (0-100%)")
AREA = KeywordRange("area_valida", ("AREA", "HECTARE"), 0, None, "negativos")
PRODUCTION = KeywordRange(
    "producao_valida",
    ("PRODUCAO", "PRODUTIVIDADE", "RENDIMENTO", "SAFRA", "COLHEITA", "TONELADA"),
    0, None, "negativos",
)
YEAR = KeywordRange("ano_valido", ("ANO", "YEAR"), 1900, 2100, "fora do range (1900-2100)")
QUANTITY = KeywordRange(
    "quantidade_valida", ("QUANTIDADE", "QTD", "QTDE", "VOLUME", "PESO"), 0, None, "negativos"
)
PH = KeywordRange("ph_valido", ("PH",), 0, 14, "fora do range (0-14)")
DEPTH = KeywordRange(
    "profundidade_valida", ("PROF", "DEPTH"), 0, 500, "fora do range (0-500 cm)", WARNING
)
PERCENTAGE = KeywordRange(
    "percentual_valido",
    ("AREIA", "ARGILA", "SILTE", "SAND", "CLAY", "SILT", "MATERIA_ORGANICA", "MO", "UMIDADE"),
    0, 100, "fora do range (0-100%)",
)

WEATHER_KEYS = ("Data", "Hora UTC")
CLIMATE = (
    NotEmpty(), RequiredColumns(WEATHER_KEYS), NotNull(WEATHER_KEYS), TEMPERATURE, HUMIDITY
)
AGRICULTURE = (NotEmpty(), AREA, PRODUCTION, YEAR, QUANTITY)
SOILS = (NotEmpty(), PH, DEPTH, PERCENTAGE)

WAREHOUSE_CLIMATE = (NotNull(("data",)),)
WAREHOUSE_CROPS = (NotNull(("cultura",), severity=WARNING),)
