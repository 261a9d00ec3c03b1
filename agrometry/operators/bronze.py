"""Raw text to typed bronze tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from agrometry.functions import crops, text
from agrometry.operators.metrics import counted_on_write

SOURCE_FILE = "arquivo_origem"

MEASURES = (
    "precipitacao_mm", "temperatura_c", "temp_max_c", "temp_min_c",
    "umidade_pct", "pressao_mb", "radiacao_kj_m2", "vento_velocidade_ms",
)
CLIMATE_COLUMNS = ("data", "hora_utc") + MEASURES


def rename_weather_columns(df: DataFrame) -> DataFrame:
    """Long weather headers to canonical names; unknown headers stay.

    Files of other years spell a header in other ways, and each row has a cell under the spelling of its own file.
    So a canonical column takes the first filled cell of all headers that fit it, the leftmost first.
    """
    fits: dict[str, list[str]] = {}
    for header in df.columns:
        fits.setdefault(text.weather_column(header) or header, []).append(header)
    return df.select(
        *[F.coalesce(*[F.col(f"`{h}`") for h in headers]).alias(name) for name, headers in fits.items()]
    )


def unused_weather_headers(columns: list[str]) -> list[str]:
    """Headers that bronze does not take up."""
    return [h for h in columns if h != SOURCE_FILE and text.weather_column(h) is None]


def select_climate_columns(df: DataFrame, *keep: str) -> DataFrame:
    """The fixed bronze projection; a measure the files lack is a typed NULL, a missing date is an error."""
    if "data" not in df.columns:
        raise ValueError(f"nenhuma coluna de data em {df.columns}")
    absent = F.lit(None).cast("string")
    return df.select(
        *[F.col(c) if c in df.columns else absent.alias(c) for c in CLIMATE_COLUMNS], *keep
    )


def type_climate_columns(df: DataFrame) -> DataFrame:
    """Dates and decimal-comma measures; unreadable cells become NULL."""
    typed = {c: text.decimal_comma(F.col(c)) for c in MEASURES if c in df.columns}
    return df.withColumns({"data": text.day(F.col("data")), **typed})


def drop_undated(df: DataFrame) -> DataFrame:
    return df.where(F.col("data").isNotNull())


def with_layer(df: DataFrame, layer: str) -> DataFrame:
    return df.withColumns({"processado_em": F.current_timestamp(), "camada": F.lit(layer)})


def with_source_file(df: DataFrame) -> DataFrame:
    """Name of the file each row came from, decoded.

    Raw tables written by this library carry it as a column, because Spark
    names its own output files; other Parquet files tell it by their path.
    """
    if SOURCE_FILE in df.columns:
        return df
    return df.withColumn(SOURCE_FILE, text.decoded_path(F.col("_metadata.file_path")))


def with_station(df: DataFrame, path_column: str = SOURCE_FILE) -> DataFrame:
    """Add state, station code and name, all read from the file name.

    Path and label are columns of their own, so each row decodes and matches once.
    """
    decoded = df.withColumn("_path", text.decoded_path(F.col(path_column)))
    labelled = decoded.withColumn("_label", text.station_label(F.col("_path")))
    return labelled.withColumns(text.station_columns(F.col("_path"), F.col("_label"))).drop("_path", "_label")


def bronze_climate(raw: DataFrame, counts: Observation | None = None) -> DataFrame:
    """Raw weather rows to the bronze climate table; ``counts`` observes rows before and after cleaning."""
    typed = (
        with_source_file(raw)
        .transform(rename_weather_columns)
        .transform(select_climate_columns, SOURCE_FILE)
        .transform(type_climate_columns)
    )
    dated = drop_undated(typed) if counts is None else counted_on_write(typed, counts)
    return (
        dated.transform(with_station)
        .drop(SOURCE_FILE)
        .transform(with_layer, "bronze")
    )


def snake_case_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[text.snake_case(c) for c in df.columns])


def union_sources(frames: list[DataFrame]) -> DataFrame:
    """Union by name; a column that one source lacks is NULL there."""
    first, *rest = frames
    for other in rest:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def crop_attributes(df: DataFrame) -> DataFrame:
    """Ideal range, water score and tolerances from the text columns."""
    ideal = F.col("clima_ideal")
    return df.withColumns(
        {
            "temp_min_ideal": crops.ideal_minimum(ideal),
            "temp_max_ideal": crops.ideal_maximum(ideal),
            "necessidade_agua_score": crops.water_score(F.col("necessidade_de_agua")),
            **crops.tolerance_flags(F.col("observacoes_praticas")),
        }
    )


def bronze_crops(raw: DataFrame | list[DataFrame]) -> DataFrame:
    """Raw crop rows (one table or several) to the bronze crop table."""
    frames = raw if isinstance(raw, (list, tuple)) else [raw]
    return (
        union_sources(list(frames))
        .transform(snake_case_columns)
        .transform(crop_attributes)
        .transform(with_layer, "bronze")
    )
