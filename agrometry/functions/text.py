"""Parsing of raw text cells, headers and file names."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Cell texts that a CSV reader takes as missing.
MISSING_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
)

# Exact and pattern-based header names of weather files.  Each
# pattern row is (column, words that must occur, words that must not).
EXACT_HEADERS = {"Data": "data", "Hora UTC": "hora_utc"}
HEADER_PATTERNS = (
    ("precipitacao_mm", ("precipita", "total"), ()),
    ("temperatura_c", ("temperatura", "bulbo seco"), ()),
    ("temp_max_c", ("temperatura", "xima"), ("orvalho",)),
    ("temp_min_c", ("temperatura", "nima"), ("orvalho",)),
    ("umidade_pct", ("umidade relativa do ar", "horaria"), ()),
    ("pressao_mb", ("pressao atmosferica ao nivel",), ()),
    ("radiacao_kj_m2", ("radiacao global",), ()),
    ("vento_velocidade_ms", ("vento", "velocidade"), ()),
)

# Parts of a station file name,
# INMET_<region>_<UF>_<code>_<name>_<dd-mm-yyyy>_A_<dd-mm-yyyy>.
FILE_UF = r"INMET_[A-Z]+_([A-Z]{2})_"
FILE_UF_STATION = r"INMET_[A-Z]+_([A-Z]{2}_[A-Z]\d+)_"
FILE_STATION = r"INMET_[A-Z]+_[A-Z]{2}_([A-Z]\d+)_"
FILE_STATION_NAME = r"INMET_[A-Z]+_[A-Z]{2}_[A-Z]\d+_(.+?)_\d{2}-\d{2}-\d{4}"


def fold_accents(name: str) -> str:
    parts = unicodedata.normalize("NFD", name)
    return "".join(p for p in parts if not unicodedata.combining(p))


def weather_column(header: str) -> str | None:
    """Canonical name of one weather header, or None when it is not used."""
    if header in EXACT_HEADERS:
        return EXACT_HEADERS[header]
    if header in EXACT_HEADERS.values():
        return header
    low = fold_accents(header.lower())
    for column, needed, banned in HEADER_PATTERNS:
        if header == column:
            return column
        if all(w in low for w in needed) and not any(w in low for w in banned):
            return column
    return None


# The accented letters of crop headers and their plain forms.
HEADER_ACCENTS = str.maketrans("áéíóúãõç", "aeiouaoc")


def snake_case(header: str) -> str:
    """Lower case, underscores, and plain letters."""
    return header.lower().replace(" ", "_").translate(HEADER_ACCENTS)


def missing_to_null(cell: Column) -> Column:
    return F.when(~cell.isin(*MISSING_TEXTS), cell)


def blank_to_null(cell: Column) -> Column:
    return F.nullif(cell, F.lit(""))


def decimal_comma(cell: Column) -> Column:
    """``"23,5"`` to 23.5; blanks, a lone comma, ``nan`` and junk give NULL.

    The usual empty cells are sorted out before the cast, because a failing
    cast costs far more than a comparison.
    """
    filled = F.when(~F.trim(cell).isin("", ",", "nan", "NaN"), cell)
    number = F.replace(filled, F.lit(","), F.lit(".")).try_cast("float")
    return F.nanvl(number, F.lit(None).cast("float"))


def day(cell: Column) -> Column:
    """A date written ``yyyy/MM/dd``, and nothing else.

    The cell is named once, since a filter on dates carries the cell's own expression down with this one.
    """
    return F.replace(F.regexp_extract(cell, r"^\d{4}/\d{2}/\d{2}$", 0), F.lit("/"), F.lit("-")).try_cast("date")


def decoded_path(path: Column) -> Column:
    """Plain form of a file path that Spark reports URL-encoded."""
    plain = F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.when(path.contains("%"), F.coalesce(plain, path)).otherwise(path)


def station_label(path: Column) -> Column:
    """The part of a decoded file path that names a station in full, or an empty text."""
    return F.regexp_extract(path, FILE_STATION_NAME, 0)


def station_columns(path: Column, label: Column) -> dict[str, Column]:
    """State, code and name of the station that a decoded file path and its ``station_label`` name.

    Only paths without a full label are searched for each part.
    """
    full = label != ""
    name = F.substr(label, F.length(F.substring_index(label, "_", 4)) + 2)
    return {
        "uf": F.when(full, F.split_part(label, F.lit("_"), F.lit(3))).otherwise(
            F.coalesce(F.nullif(F.substring(F.regexp_extract(path, FILE_UF_STATION, 1), 1, 2), F.lit("")), F.regexp_extract(path, FILE_UF, 1))
        ),
        "estacao_codigo": F.when(full, F.split_part(label, F.lit("_"), F.lit(4))).otherwise(F.regexp_extract(path, FILE_STATION, 1)),
        # the label ends in an underscore and a date of ten signs
        "estacao_nome": F.when(full, F.substr(name, F.lit(1), F.length(name) - 11)).otherwise(F.lit("")),
    }


# What reads as a number; Java would also take "1d" and "1f".
NUMBER = r"(?i)^\s*[-+]?((\d+\.?\d*|\.\d+)(e[-+]?\d+)?|inf(inity)?)\s*$"


def number(cell: Column, decimal_comma_text: bool = False) -> Column:
    """Text cell as a double, or NULL when it does not read as a number."""
    if decimal_comma_text:
        cell = F.replace(cell, F.lit(","), F.lit("."))
    return F.when(cell.rlike(NUMBER), cell.try_cast("double"))
