"""Named queries over the shared sample tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from agrometry.functions.calendar import season_order as season_place
from agrometry.functions.numeric import as_numeric, highest, lowest, mean, total
from agrometry.functions.suitability import advice
from agrometry.operators import bronze, gold, metrics, silver, warehouse
from agrometry.plans import inputs, jobs
from agrometry.plans.ingest import ingest_source
from agrometry.plans.inputs import HUMIDITY, RAIN, TEMPERATURE, TEMPERATURE_MAX
from agrometry.plans.warehouse import build_models
from agrometry.sources.scratch import scratch_folder
from agrometry.sources.session import compiled_methods
from agrometry.quality import rulesets
from agrometry.quality.rules import Check, DataType, NoDuplicates, NotEmpty, NotNull, NumericRange, RequiredColumns, Rule
from agrometry.quality.runner import (
    file_errors, isolated_lines, profile, report, split_by_file, stored_summary, validate_file,
)
from agrometry.sources import readers, writers

Query = Callable[[SparkSession, str], DataFrame]


def decimals_as_doubles(df: DataFrame) -> DataFrame:
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, DecimalType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def _unstamped(df: DataFrame) -> DataFrame:
    return df.drop("processado_em")


# Lake route ---------------------------------------------------------------


def dated(spark, folder):
    return bronze.drop_undated(inputs.hourly(spark, folder))


def daily(spark, folder):
    return silver.daily_climate(dated(spark, folder))


def monthly(spark, folder):
    return silver.monthly_climate(daily(spark, folder))


def seasonal(spark, folder):
    return silver.seasonal_climate(monthly(spark, folder))


def season_order(spark, folder):
    place = season_place(F.col("estacao")).alias("ordem")
    return seasonal(spark, folder).transform(silver.in_season_order).select(place, "ano", "estacao")


def fact(spark, folder):
    return gold.crop_risk_fact(
        seasonal(spark, folder), silver.enrich_crops(inputs.crops(spark, folder))
    )


def station_fact(spark, folder):
    by_station = silver.seasonal_climate(monthly(spark, folder), keep_station=True)
    return gold.crop_risk_fact(by_station, silver.enrich_crops(inputs.crops(spark, folder)))


def station_counts(spark, folder, *by):
    by_station = silver.seasonal_climate(monthly(spark, folder), keep_station=True)
    return gold.risk_counts(by_station, silver.enrich_crops(inputs.crops(spark, folder)), *by)


def temperature_scores(spark, folder):
    return station_fact(spark, folder).select(
        "cultura", "estacao_codigo", "ano", "estacao", "temp_real", "temp_min_ideal", "temp_max_ideal",
        "score_temperatura",
    )


def rain_scores(spark, folder):
    return station_fact(spark, folder).select(
        "cultura", "estacao_codigo", "ano", "estacao", "precipitacao_mm", "necessidade_de_agua", "dias_chuva",
        "score_precipitacao",
    )


def overall_risks(spark, folder):
    return station_fact(spark, folder).select(
        "cultura", "estacao_codigo", "ano", "estacao", "score_temperatura", "score_precipitacao", "score_final",
        "risco_geral",
    )


def advices(spark, folder):
    advised = station_counts(spark, folder).withColumn("recomendacao", advice(F.col("risco_geral")))
    return advised.groupBy("risco_geral", "recomendacao").agg(F.sum(gold.PAIRS).alias("linhas"))


# Bronze -------------------------------------------------------------------


def bronze_climate(spark, folder):
    return _unstamped(bronze.bronze_climate(inputs.raw_weather(spark, folder)))


def renamed_weather(spark, folder):
    return (
        inputs.raw_weather(spark, folder)
        .transform(bronze.rename_weather_columns)
        .transform(bronze.select_climate_columns)
    )


def bronze_crops(spark, folder):
    return _unstamped(bronze.bronze_crops(inputs.raw_crops(spark, folder)))


def united_sources(spark, folder):
    sources = [inputs.raw_crops(spark, folder), inputs.raw_soils(spark, folder)]
    return bronze.snake_case_columns(bronze.union_sources(sources))


def stations_from_files(spark, folder):
    files = inputs.raw_weather(spark, folder).groupBy(bronze.SOURCE_FILE).agg(F.count("*").alias("linhas"))
    plain = F.url_decode(bronze.SOURCE_FILE)
    return bronze.with_station(files).withColumn(bronze.SOURCE_FILE, plain)


def cleaning_counts(spark, folder):
    typed = (
        inputs.raw_weather(spark, folder)
        .transform(bronze.rename_weather_columns)
        .transform(bronze.type_climate_columns)
    )
    return metrics.cleaning_counts(typed)


# Warehouse route ----------------------------------------------------------


def staged(spark, folder):
    return warehouse.staged_climate(inputs.hourly(spark, folder))


def warehouse_monthly(spark, folder):
    return warehouse.monthly_climate(staged(spark, folder))


def warehouse_seasonal(spark, folder):
    return warehouse.seasonal_climate(warehouse_monthly(spark, folder))


def staged_crops(spark, folder):
    return warehouse.staged_crops(inputs.crops(spark, folder))


def mart(spark, folder):
    return warehouse.risk_mart(warehouse_seasonal(spark, folder), staged_crops(spark, folder))


# Data quality -------------------------------------------------------------


def _quality(source: Query, *rules) -> Query:
    def run(spark, folder):
        return report(source(spark, folder), rules, samples=False).select(
            "rule", "column", "severity", "rows_affected"
        )

    return run


def not_empty(spark, folder):
    """Stations without a reading (a join that finds none) beside those with readings."""
    stations, items = inputs.table(spark, folder, "supplier"), _line_items(spark, folder)
    idle = stations.join(items, stations["s_suppkey"] == items["l_suppkey"], "left_anti")
    busy = stations.join(items, stations["s_suppkey"] == items["l_suppkey"], "left_semi")
    shown = ("rule", "column", "severity", "rows_affected")
    told = [report(df, [NotEmpty()], samples=False).select(F.lit(name).alias("tabela"), *shown) for name, df in (("sem_leituras", idle), ("com_leituras", busy))]
    return told[0].union(told[1])


class _Failing(Rule):
    """A rule that raises in the data: on the first date it meets."""

    name = "regra_quebrada"

    def checks(self, df):
        dated = F.when(F.col("Data").contains("/"), F.raise_error(F.lit("valor impossível")).cast("int"))
        return [Check(self.name, "Data", lambda n: F.lit("nunca"), affected=F.count(dated))]


def rule_crash(spark, folder):
    rules = [NotNull(rulesets.WEATHER_KEYS), _Failing(), rulesets.TEMPERATURE, rulesets.HUMIDITY]
    lines = isolated_lines(inputs.raw_weather(spark, folder), rules, samples=False)
    rows = [(k["rule"], k["column"], k["severity"], k["rows_affected"]) for k in lines]
    return spark.createDataFrame(rows, "rule string, column string, severity string, rows_affected bigint")


def validated_file(spark, folder):
    """A Parquet file judged by its path: the result's lines, with its totals."""
    path = scratch_folder(spark, "julgado")
    inputs.raw_weather(spark, folder).write.parquet(path)
    found = validate_file(spark, path, rulesets.CLIMATE, fail_on_error=False).to_dict()
    totals = (found["is_valid"], found["total_rows"], found["error_count"], found["warning_count"])
    rows = [(kind, k["rule"], k["column"], k["rows_affected"], *totals) for kind in ("errors", "warnings") for k in found[kind]]
    return spark.createDataFrame(rows, "tipo string, rule string, column string, rows_affected bigint, is_valid boolean, total_rows bigint, error_count bigint, warning_count bigint")


def _line_items(spark, folder):
    return inputs.table(spark, folder, "lineitem")


def data_types(spark, folder):
    rules = [DataType(TEMPERATURE, "numeric"), DataType("Data", "datetime"), DataType("Hora UTC", "string")]
    return report(inputs.raw_weather(spark, folder), rules).select(
        "rule", "column", "severity", "rows_affected", F.array_join("sample_values", "|").alias("amostra")
    )


def _decoded_files(df):
    return df.withColumn(bronze.SOURCE_FILE, F.url_decode(bronze.SOURCE_FILE))


def rejected_files(spark, folder):
    bad = file_errors(inputs.raw_weather(spark, folder), rulesets.CLIMATE, bronze.SOURCE_FILE)
    return _decoded_files(bad).drop("message")


def _gated(side: int) -> Query:
    def run(spark, folder):
        rows = inputs.raw_weather(spark, folder)
        summary = stored_summary(rows, rulesets.CLIMATE, bronze.SOURCE_FILE)
        parts = split_by_file(rows, summary, bronze.SOURCE_FILE)
        return _decoded_files(parts[side]).select(
            bronze.SOURCE_FILE, F.col("Data").alias("data"), F.col("Hora UTC").alias("hora_utc")
        )

    return run


def warehouse_not_null(spark, folder):
    shown = ("rule", "column", "severity", "rows_affected")
    climate = report(inputs.hourly(spark, folder), rulesets.WAREHOUSE_CLIMATE).select(*shown)
    crops = report(united_sources(spark, folder), rulesets.WAREHOUSE_CROPS).select(*shown)
    return climate.unionByName(crops)


def layer_totals(spark, folder):
    return metrics.layer_totals({"clima": dated(spark, folder), "culturas": inputs.raw_crops(spark, folder)})


def table_not_empty(spark, folder):
    return metrics.table_not_empty(inputs.hourly(spark, folder))


# Round trips through files and tables -------------------------------------


def _written_raw(spark, folder):
    path = scratch_folder(spark, "raw")
    rows = _decoded_files(inputs.raw_weather(spark, folder))
    writers.write_raw(rows.withColumn("year", F.substring("Data", 1, 4)), path)
    return path


def _raw_columns(df):
    return df.select(
        "year", F.col("Data").alias("data"), F.col("Hora UTC").alias("hora_utc"),
        F.col(f"`{TEMPERATURE}`").alias("temperatura"), bronze.SOURCE_FILE,
    )


def raw_roundtrip(spark, folder):
    return _raw_columns(readers.read_raw(spark, _written_raw(spark, folder)))


def year_filter_scan(spark, folder):
    return _raw_columns(readers.read_raw(spark, _written_raw(spark, folder), year="1997"))


def gold_partition_roundtrip(spark, folder):
    path = scratch_folder(spark, "fato")
    writers.write_layer(fact(spark, folder), path, partition_by="estacao")
    return (
        readers.read_layer(spark, path)
        .where(F.col("estacao") == "Verão")
        .select("cultura", "ano", "estacao", "score_final", "risco_geral")
    )


# Other spellings of the rain header; they mean the same column.
RAIN_SPELLINGS = (RAIN, "PRECIPITACAO TOTAL HORARIO", "Precipitação Total (mm)")


def _station_number():
    # the fourth part of the name, as in file:/raw/1997/INMET_SE_AB_A000000001_...
    return F.substring_index(F.substring_index(bronze.SOURCE_FILE, "_", 4), "_A", -1).cast("bigint")


def _csv_lines(rows: DataFrame, *folders: str) -> DataFrame:
    """Rows as lines of a file for each of ``folders``: (folders, kind, value), where kind 2 is a line of data."""
    names = [c for c in rows.columns if c not in (bronze.SOURCE_FILE, *folders)]
    cells = F.concat_ws(";", *[F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in names])
    return rows.select(*folders, F.lit(2).alias("kind"), cells.alias("value"))


def _write_lines(lines: DataFrame, path: str, *folders: str) -> str:
    """One file a folder, in the order of kinds."""
    dealt = lines.repartition(*folders).sortWithinPartitions(*folders, "kind").drop("kind")
    dealt.write.partitionBy(*folders).text(path)
    return path


def _station_group():
    """Ten stations a group, and a hundred from the thousandth on, so that files of large tables are not all small."""
    number = _station_number()
    return F.when(number < 1000, F.floor(number / 10)).otherwise(90 + F.floor(number / 100))


def _station_files(spark, folder, spellings) -> str:
    """A file for each group of stations: a preamble line, a header, rows; by turns the header spells rain in three ways."""
    rows = inputs.raw_weather(spark, folder).withColumn("part", _station_group())
    head = ";".join(c for c in rows.columns if c not in (bronze.SOURCE_FILE, "part"))
    heads = F.get(F.array(*[F.lit(head.replace(RAIN, k)) for k in spellings]), F.pmod("part", F.lit(3)))
    tops = F.array(F.struct(F.lit(0).alias("kind"), F.concat(F.lit("ESTACAO;"), "part").alias("value")), F.struct(F.lit(1).alias("kind"), heads.alias("value")))
    groups = inputs.weather_files(spark, folder).select(_station_group().alias("part")).distinct()
    return _write_lines(_csv_lines(rows, "part").union(groups.select("part", F.inline(tops))), scratch_folder(spark, "csv"), "part")


def _station_tree(spark, folder) -> str:
    """Weather files by ten stations and year.  Every third ten keeps rows without a date or with a false humidity."""
    rows = inputs.raw_weather(spark, folder).withColumns(
        {"part": F.floor(_station_number() / 10), "year": F.regexp_extract(bronze.SOURCE_FILE, "/raw/([0-9]+)/", 1)}
    )
    sound = (F.col("Data") != "nan") & F.col(f"`{HUMIDITY}`").cast("int").between(0, 100)
    rows = rows.where((F.col("part") % 3 == 1) | F.coalesce(sound, F.lit(False)))
    head = ";".join(c for c in rows.columns if c not in (bronze.SOURCE_FILE, "part", "year"))
    tops = F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(v).alias("value")) for k, v in enumerate(("ESTACOES", head))])
    tops = rows.select("part", "year").distinct().select("part", "year", F.inline(tops))
    return _write_lines(_csv_lines(rows, "part", "year").union(tops), scratch_folder(spark, "csv"), "part", "year")


def ingest_metrics(spark, folder):
    """All weather files judged and stored."""
    return ingest_source(spark, "clima", _station_tree(spark, folder), scratch_folder(spark, "raw"), encoding="UTF-8")


def ingest_filtered(spark, folder):
    """One year's files of every second ten stations."""
    tree, raw = _station_tree(spark, folder), scratch_folder(spark, "raw")
    even = lambda path: path.rlike("part=[0-9]*[02468]/")
    return ingest_source(spark, "clima", tree, raw, year="1997", file_filter=even, encoding="UTF-8")


def ingest_stored(spark, folder):
    """What an ingest leaves in the raw store: rows by year and file."""
    raw = scratch_folder(spark, "raw")
    ingest_source(spark, "clima", _station_tree(spark, folder), raw, encoding="UTF-8")
    part = F.regexp_extract(bronze.SOURCE_FILE, "part=([0-9]+)/", 1).cast("bigint").alias("part")
    return readers.read_raw(spark, raw).groupBy("year", part).agg(F.count("*").alias("linhas"))


def csv_weather_scan(spark, folder):
    """Write station files with a preamble, read them back."""
    path = _station_files(spark, folder, (RAIN,) * 3)
    return readers.read_weather_csv(spark, path, encoding="UTF-8").select(
        F.col("Data").alias("data"), F.col("Hora UTC").alias("hora_utc"),
        F.col(f"`{RAIN}`").alias("chuva"), F.col(f"`{HUMIDITY}`").alias("umidade"),
    )


def csv_mixed_layouts(spark, folder):
    """Station files of three header spellings end in one bronze column."""
    found = readers.read_weather_csv(spark, _station_files(spark, folder, RAIN_SPELLINGS), encoding="UTF-8")
    return bronze.bronze_climate(found).select("data", "hora_utc", "precipitacao_mm", "umidade_pct")


def csv_crop_scan(spark, folder):
    path = scratch_folder(spark, "csv")
    inputs.raw_crops(spark, folder).write.option("header", True).csv(path)
    return bronze.snake_case_columns(readers.read_reference_csv(spark, path).drop(bronze.SOURCE_FILE))


def csv_quoted_cells(spark, folder):
    """Crop files with separators and line breaks inside quoted cells."""
    path = scratch_folder(spark, "csv")
    noted = inputs.raw_crops(spark, folder).withColumn("Categoria", F.concat("Categoria", F.lit(", a\nb, "), "Cultura"))
    noted.write.option("header", True).option("quoteAll", True).option("escape", '"').csv(path)
    return bronze.snake_case_columns(readers.read_reference_csv(spark, path)).select("cultura", "categoria")


def _yearly(spark, folder):
    rows = _decoded_files(inputs.raw_weather(spark, folder))
    return rows.withColumn("year", F.substring("Data", 1, 4))


def ingest_two_runs(spark, folder):
    """A second run of one year replaces that year's files and keeps the rest."""
    path = _written_raw(spark, folder)
    again = _yearly(spark, folder).where(F.col("year") == "1997")
    writers.write_raw(again.withColumn(HUMIDITY, F.lit("0")), path)
    return _raw_columns(readers.read_raw(spark, path)).groupBy("year").agg(F.count("*").alias("linhas"))


def raw_mixed_schemas(spark, folder):
    """A column that only one year's files have is read for all."""
    path = scratch_folder(spark, "raw")
    rows = _yearly(spark, folder)
    recent = F.coalesce(F.col("year") >= "1996", F.lit(False))
    writers.write_raw(rows.where(~recent).drop(HUMIDITY), path)
    writers.write_raw(rows.where(recent), path)
    return readers.read_raw(spark, path).groupBy("year").agg(F.count("*").alias("linhas"), F.count(F.col(f"`{HUMIDITY}`")).alias("com_umidade"))


def _place(spark) -> tuple[str, str]:
    """A new folder for tables, and a prefix for the names of new schemas."""
    place = scratch_folder(spark, "tabelas")
    return place, "carga_" + place.rsplit("-", 1)[-1][:12]


def load_table(spark, folder):
    """Load with some blank states, which the table holds as NULL."""
    uf = F.when(F.col("uf") == "U07", "").otherwise(F.col("uf"))
    place, schema = _place(spark)
    writers.load_table(dated(spark, folder).withColumn("uf", uf), "clima_horario", schema, location=place)
    loaded = readers.read_relation(spark, f"{schema}.clima_horario")
    return warehouse.rows_per_station(loaded)


def load_again(spark, folder):
    """A second load replaces the rows; a third one breaks half-way and changes nothing."""
    place, schema = _place(spark)
    rows = dated(spark, folder)
    tables = {"clima": rows, "culturas": inputs.raw_crops(spark, folder)}
    writers.load_tables(tables, "clima", schema, location=place)
    writers.load_tables(tables | {"clima": rows.where("hora_utc <> '0100 UTC'")}, "todas", schema, location=place)
    broken = F.when(F.col("hora_utc") == "0200 UTC", F.raise_error(F.lit("linha quebrada")).cast("string")).otherwise(F.col("uf"))
    try:
        writers.load_table(rows.withColumn("uf", broken), "clima", schema, location=place)
    except PySparkException:
        pass
    return warehouse.rows_per_station(readers.read_relation(spark, f"{schema}.clima"))


def warehouse_models(spark, folder):
    """The mart as a table of its layer, built from stored models, read by another session."""
    place, prefix = _place(spark)
    build_models(spark, inputs.hourly(spark, folder), inputs.crops(spark, folder), place, prefix + "_")
    return spark.newSession().table(f"{prefix}_gold.fct_risco_climatico")


def lasting_view(spark, folder):
    """A staging view in another session; it follows its table, which is loaded again after the view was made."""
    place, prefix = _place(spark)
    rows = inputs.hourly(spark, folder)
    writers.load_table(rows.where("uf <> 'U07'"), "clima", prefix, location=place)
    writers.create_view(spark, warehouse.STAGED_CLIMATE.format(bronze=f"`{prefix}`.clima"), "stg_clima", prefix, place)
    writers.load_table(rows, "clima", prefix, location=place)
    return warehouse.rows_per_station(spark.newSession().table(f"{prefix}.stg_clima"))


def cleaned_on_write(spark, folder):
    """Rows before and after cleaning, counted by the query that writes bronze."""
    counts = Observation("limpeza")
    writers.write_layer(bronze.bronze_climate(inputs.raw_weather(spark, folder), counts), scratch_folder(spark, "bronze"))
    return spark.createDataFrame([metrics.cleaning_facts(counts)], "registros_antes bigint, registros_depois bigint, removidos bigint")


def stored_layers(spark, folder):
    """Silver tables from written Parquet files, each level from the one below."""
    place = scratch_folder(spark, "camadas")
    writers.write_layer(dated(spark, folder), f"{place}/bronze")
    jobs.agregar_clima_diario(spark, f"{place}/bronze", f"{place}/diario")
    jobs.agregar_clima_mensal(spark, f"{place}/diario", f"{place}/mensal")
    return jobs.agregar_clima_estacional(spark, f"{place}/mensal", f"{place}/estacional")


def previews(spark, folder):
    """The first rows of three tables in their orders of display."""
    shown = lambda df, name, *c: writers.sample_rows(df, 20).select(F.lit(name).alias("tabela"), *[F.col(k).cast("string").alias(f"c{i}") for i, k in enumerate(c)])
    return (
        shown(silver.in_date_order(daily(spark, folder)), "diario", "data", "estacao_codigo", "qtd_registros")
        .union(shown(silver.in_month_order(monthly(spark, folder)), "mensal", "ano", "mes", "estacao_codigo"))
        .union(shown(gold.in_crop_order(fact(spark, folder)), "fato", "cultura", "estacao", "ano"))
    )


def extreme_means(spark, folder):
    """Means, limits and totals of values just under a tie, and of values beyond what a long holds."""
    kind = F.pmod(F.substring("estacao_codigo", 2, 9).cast("bigint"), F.lit(4))
    value = F.when(kind == 0, 0.0499999).when(kind == 1, 2.0**77).when(kind == 2, 2e15).otherwise(F.col("temperatura_c"))
    measured = inputs.hourly(spark, folder).withColumn("v", value)
    return measured.groupBy("estacao_codigo").agg(
        as_numeric(mean(F.col("v"))).alias("media"), as_numeric(lowest(F.col("v"))).alias("minimo"),
        as_numeric(highest(F.col("v"))).alias("maximo"), as_numeric(total(F.col("v"))).alias("total"),
    )


def queries() -> dict[str, Query]:
    weather, farms, soils = inputs.raw_weather, inputs.farms, inputs.soils
    found: dict[str, Query] = {
        "fct_risco_climatico": mart,
        "int_clima_mensal": warehouse_monthly,
        "int_clima_sazonal": warehouse_seasonal,
        "stg_clima": staged,
        "stg_culturas": staged_crops,
        "top_riscos_mart": lambda s, f: warehouse.top_risks(mart(s, f)),
        "registros_por_estacao": lambda s, f: warehouse.rows_per_station(dated(s, f)),
        "bronze_clima_typed": bronze_climate,
        "bronze_culturas": bronze_crops,
        "bronze_rename_rules": renamed_weather,
        "bronze_union_sources": united_sources,
        "station_from_filename": stations_from_files,
        "clean_counts": cleaning_counts,
        "dim_tempo": lambda s, f: silver.time_dimension(dated(s, f)),
        "clima_diario": daily,
        "clima_mensal": monthly,
        "clima_estacional": seasonal,
        "season_order": season_order,
        "silver_culturas": lambda s, f: silver.enrich_crops(inputs.crops(s, f)),
        "score_temperatura": temperature_scores,
        "score_precipitacao": rain_scores,
        "risco_geral": overall_risks,
        "recomendacao": advices,
        "fato_risco_climatico": fact,
        "fato_risco_por_estacao": station_fact,
        "ranking_culturas": lambda s, f: gold.crop_ranking(fact(s, f)),
        "ranking_por_estacao": lambda s, f: gold.crop_ranking(station_fact(s, f)),
        "distribuicao_risco": lambda s, f: gold.risk_distribution(station_counts(s, f)),
        "resumo_executivo": lambda s, f: gold.executive_summary(station_counts(s, f)),
        "top_versateis": lambda s, f: gold.most_versatile_crops(station_counts(s, f, "cultura", "categoria")),
        "top_arriscadas": lambda s, f: gold.riskiest_crops(station_counts(s, f, "cultura", "categoria")),
        "dq_not_empty": not_empty,
        "dq_rule_crash": rule_crash,
        "dq_validate_file": validated_file,
        "dq_required_columns": _quality(weather, RequiredColumns(("Data", "Hora UTC", "Estacao"))),
        "dq_not_null": _quality(weather, NotNull(rulesets.WEATHER_KEYS)),
        "dq_numeric_range": _quality(weather, NumericRange(TEMPERATURE_MAX, 15, 50)),
        "dq_no_duplicates": _quality(_line_items, NoDuplicates(("l_orderkey", "l_linenumber"))),
        "dq_no_duplicates_all_columns": _quality(inputs.hourly, NoDuplicates()),
        "dq_data_type": data_types,
        "dq_temperatura": _quality(weather, rulesets.TEMPERATURE),
        "dq_umidade": _quality(weather, rulesets.HUMIDITY),
        "dq_area": _quality(farms, rulesets.AREA),
        "dq_producao": _quality(farms, rulesets.PRODUCTION),
        "dq_ano": _quality(farms, rulesets.YEAR),
        "dq_quantidade": _quality(farms, rulesets.QUANTITY),
        "dq_ph": _quality(soils, rulesets.PH),
        "dq_profundidade": _quality(soils, rulesets.DEPTH),
        "dq_percentual": _quality(soils, rulesets.PERCENTAGE),
        "dq_report_clima": _quality(weather, *rulesets.CLIMATE),
        "dq_report_agricultura": _quality(farms, *rulesets.AGRICULTURE),
        "dq_report_solos": _quality(soils, *rulesets.SOILS),
        "dq_profile": lambda s, f: profile(inputs.hourly(s, f)),
        "dq_quarantine_files": rejected_files,
        "dq_clean_rows": _gated(0),
        "dq_rejected_rows": _gated(1),
        "dq_warehouse_not_null": warehouse_not_null,
        "layer_totals": layer_totals,
        "table_not_empty": table_not_empty,
        "ingest_metrics": ingest_metrics,
        "raw_roundtrip": raw_roundtrip,
        "year_filter_scan": year_filter_scan,
        "gold_partition_roundtrip": gold_partition_roundtrip,
        "csv_weather_scan": csv_weather_scan,
        "csv_crop_scan": csv_crop_scan,
        "csv_mixed_layouts": csv_mixed_layouts,
        "csv_quoted_cells": csv_quoted_cells,
        "ingest_two_runs": ingest_two_runs,
        "raw_mixed_schemas": raw_mixed_schemas,
        "ingest_filtered": ingest_filtered,
        "ingest_stored": ingest_stored,
        "load_table": load_table,
        "load_again": load_again,
        "warehouse_models": warehouse_models,
        "lasting_view": lasting_view,
        "clean_counts_on_write": cleaned_on_write,
        "stored_layers": stored_layers,
        "previews": previews,
        "extreme_means": extreme_means,
    }
    return {name: _plain(query) for name, query in found.items()}


def _plain(query: Query) -> Query:
    def run(spark, folder):
        compiled_methods(spark)
        return decimals_as_doubles(query(spark, folder))

    return run
