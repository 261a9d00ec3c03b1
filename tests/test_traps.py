"""Semantics that are easy to get wrong, and the two routes' differences."""

import datetime
import math

import pytest
from pyspark.sql import functions as F

from agrometry.functions import calendar, crops, numeric, text
from agrometry.operators import bronze, gold, metrics, silver, warehouse


def values(spark, rows, kind, expression):
    df = spark.createDataFrame([(r,) for r in rows], f"c {kind}")
    return [r[0] for r in df.select(expression(F.col("c"))).collect()]


def test_measure_cells(spark):
    cells = ["23,5", "-1,0", " 7 ", "12", "", " ", ",", "nan", "NaN", "1.234,5", "abc", None]
    assert values(spark, cells, "string", text.decimal_comma) == [23.5, -1.0, 7.0, 12.0] + [None] * 8


def test_nan_does_not_poison_aggregates(spark):
    got = spark.createDataFrame([(1.0,), (math.nan,), (math.inf,), (None,), (2.0,)], "v double").agg(
        numeric.mean(F.col("v")), numeric.total(F.col("v")), numeric.highest(F.col("v")), numeric.lowest(F.col("v"))
    ).first()
    assert [float(x) for x in got] == [1.5, 3.0, 2.0, 1.0]


def test_days_are_strict(spark):
    day = datetime.date(2025, 1, 5)
    assert values(spark, ["2025/01/05", "2025/01/05xx", "2025-01-05", "nan", None], "string", text.day) == [day] + [None] * 4


def test_rounding_is_half_up_on_exact_means(spark):
    df = spark.createDataFrame([(0.3,), (0.4,)], "v float")
    assert float(df.agg(numeric.mean(F.col("v"))).first()[0]) == 0.4  # 0.35
    df = spark.createDataFrame([(-0.3,), (-0.4,)], "v float")
    assert float(df.agg(numeric.mean(F.col("v"))).first()[0]) == -0.4


@pytest.mark.parametrize("values,want", [
    ([0.0499999, 0.0499999], (0.0, 0.0, 0.0, 0.1)), ([0.04999999999], (0.0, 0.0, 0.0, 0.0)), ([0.05, 0.05], (0.1, 0.1, 0.1, 0.1)), ([0.1, 0.2], (0.2, 0.1, 0.2, 0.3)),
    ([-0.1, -0.2], (-0.2, -0.2, -0.1, -0.3)), ([1e23, 3e23], (2e23, 1e23, 3e23, 4e23)), ([2e15], (2e15,) * 4), ([123456.35], (123456.4,) * 4), ([999999999.75], (999999999.8,) * 4),
    ([2e15, 0.25], (1000000000000000.1, 0.3, 2e15, 2000000000000000.2)), ([], (None,) * 4), ([1e300], (1e300,) * 4), ([1e-320], (0.0,) * 4),
])
def test_values_are_rounded_once(spark, values, want):
    v = F.col("v")
    df = spark.createDataFrame([(float(x),) for x in values], "v double")
    assert tuple(df.agg(numeric.mean(v), numeric.lowest(v), numeric.highest(v), numeric.total(v)).first()) == want


def test_warehouse_measures_have_any_size(spark):
    df = spark.createDataFrame([(2e15,), (3e23,), (-0.25,)], "v double").select(numeric.as_numeric(numeric.rounded(F.col("v"))).alias("v"))
    assert [float(r.v) for r in df.collect()] == [2e15, 3e23, -0.3]


def test_means_do_not_depend_on_partitioning(spark):
    df = spark.range(10_000).select((F.rand(7) * 50).cast("float").alias("v"))
    df = spark.createDataFrame(df.collect(), df.schema)
    got = {str(df.repartition(n).agg(numeric.mean(F.col("v"), 4), numeric.total(F.col("v"), 4)).first()) for n in (1, 3, 8)}
    assert len(got) == 1


def test_encoded_paths(spark):
    assert values(spark, ["a%20b+c", "plain", "50%"], "string", text.decoded_path) == ["a b+c", "plain", "50%"]


def test_unmatched_file_name_gives_blanks(spark):
    df = bronze.with_station(spark.createDataFrame([("x.parquet",)], "arquivo_origem string"))
    assert tuple(df.first())[1:] == ("", "", "")


def test_rename_rules_first_match_wins(spark):
    names = [
        "Data", "Hora UTC", "PRECIPITAÇÃO TOTAL, HORÁRIO (mm)", "PRESSAO ATMOSFERICA AO NIVEL DA ESTACAO, HORARIA (mB)",
        "PRESSÃO ATMOSFERICA MAX.NA HORA ANT. (AUT) (mB)", "RADIACAO GLOBAL (Kj/m²)", "TEMPERATURA DO AR - BULBO SECO, HORARIA (°C)",
        "TEMPERATURA DO PONTO DE ORVALHO (°C)", "TEMPERATURA MÁXIMA NA HORA ANT. (AUT) (°C)", "TEMPERATURA MÍNIMA NA HORA ANT. (AUT) (°C)",
        "TEMPERATURA ORVALHO MAX. NA HORA ANT. (AUT) (°C)", "UMIDADE REL. MAX. NA HORA ANT. (AUT) (%)",
        "UMIDADE RELATIVA DO AR, HORARIA (%)", "VENTO, DIREÇÃO HORARIA (gr) (° (gr))", "VENTO, RAJADA MAXIMA (m/s)",
        "VENTO, VELOCIDADE HORARIA (m/s)", "Precipitacao total 2",
    ]
    df = bronze.rename_weather_columns(spark.createDataFrame([tuple("x" * len(names))], names))
    assert len(set(df.columns)) == len(df.columns) == len(names) - 1  # two spellings of rain are one column
    assert [c for c in df.columns if c in bronze.CLIMATE_COLUMNS] == [
        "data", "hora_utc", "precipitacao_mm", "pressao_mb", "radiacao_kj_m2", "temperatura_c",
        "temp_max_c", "temp_min_c", "umidade_pct", "vento_velocidade_ms",
    ]
    assert bronze.unused_weather_headers(names[-4:]) == ["VENTO, DIREÇÃO HORARIA (gr) (° (gr))", "VENTO, RAJADA MAXIMA (m/s)"]
    assert bronze.select_climate_columns(df.select("data")).columns == list(bronze.CLIMATE_COLUMNS)


def test_snake_case_keeps_other_accents():
    assert text.snake_case("Necessidade de Água") == "necessidade_de_agua"
    assert text.snake_case("Observações Práticas") == "observacoes_praticas"
    assert text.snake_case("Mês Ângulo") == "mês_ângulo"


def test_crop_text(spark):
    df = spark.createDataFrame(
        [("A", "20-35°C; pleno sol", "Alta", "Tolerante à SECA"), ("B", "pleno sol", "Outra", None), (None, None, None, "Resistente ao frio, sensível ao calor")],
        "`Cultura` string, `Clima Ideal` string, `Necessidade de Água` string, `Observações Práticas` string",
    )
    rows = bronze.bronze_crops(df).collect()
    shown = ("temp_min_ideal", "temp_max_ideal", "necessidade_agua_score", "tolerante_seca", "tolerante_frio", "sensivel_frio", "sensivel_calor")
    assert [tuple(r[c] for c in shown) for r in rows] == [
        (20, 35, 3, True, False, False, False), (None, None, 2, False, False, False, False),
        # words of different clauses combine, as the rules say
        (None, None, 2, False, True, True, True),
    ]


def test_nameless_crops_stay_in_the_lake_and_leave_the_warehouse(spark):
    soils = spark.createDataFrame([("arenoso",)], "`Tipo` string")
    crops_raw = spark.createDataFrame([("A", "g", "1-2", "Alta", "x")], "Cultura string, Categoria string, `Clima Ideal` string, `Necessidade de Água` string, `Observações Práticas` string")
    both = bronze.bronze_crops([crops_raw, soils])
    assert both.count() == 2 and warehouse.staged_crops(both).count() == 1


def test_missing_ideal_range_is_the_hottest_profile(spark):
    assert values(spark, [14.9, 15.0, 21.9, 22.0, 28.0, None], "double", crops.thermal_profile) == [
        "frio", "ameno", "ameno", "quente", "muito_quente", "muito_quente",
    ]


def test_calendar(spark):
    months = list(range(1, 13))
    want = ["Verão"] * 2 + ["Outono"] * 3 + ["Inverno"] * 3 + ["Primavera"] * 3 + ["Verão"]
    assert values(spark, [*months, None], "int", calendar.season) == [*want, "Primavera"]
    plain = [w.replace("ã", "a") for w in want]
    assert values(spark, [*months, None], "int", calendar.warehouse_season) == [*plain, None]
    assert values(spark, [1, 3, 12], "int", calendar.month_name) == ["Janeiro", "Março", "Dezembro"]
    assert values(spark, ["Primavera", "Verão", "x"], "string", calendar.season_order) == [4, 1, 4]


@pytest.fixture
def two_stations(spark):
    rows = []
    for station, base in (("A1", 10.0), ("A2", 30.0)):
        for day in (1, 2):
            for hour in range(3):
                rows.append((station, station, "SP", datetime.date(2024, 1, day), f"{hour:02d}00 UTC", 1.0 if day == 1 else 0.0, base, base + 2, base - 2, 50.0, 900.0, 10.0, 1.0))
    rows.append(rows[0])
    return spark.createDataFrame(
        rows,
        "estacao_codigo string, estacao_nome string, uf string, data date, hora_utc string, precipitacao_mm double, temperatura_c double, "
        "temp_max_c double, temp_min_c double, umidade_pct double, pressao_mb double, radiacao_kj_m2 double, vento_velocidade_ms double",
    )


def test_routes_differ(two_stations):
    lake = silver.seasonal_climate(silver.monthly_climate(silver.daily_climate(two_stations))).collect()
    assert len(lake) == 1 and lake[0].estacao == "Verão"
    # one rainy day per station; the repeated hour counts, as nothing removes it
    assert lake[0].temp_media == 20.0 and lake[0].precipitacao_total_mm == 7.0 and lake[0].dias_chuva == 2
    house = warehouse.seasonal_climate(warehouse.monthly_climate(warehouse.staged_climate(two_stations))).orderBy("estacao_codigo").collect()
    assert [(r.estacao_codigo, float(r.temp_media_c), float(r.precipitacao_total_mm), r.dias_com_chuva) for r in house] == [
        ("A1", 10.0, 3.0, 3), ("A2", 30.0, 3.0, 3)
    ]
    assert {r.estacao_ano for r in house} == {"Verao"}


def test_staging_filters(spark, two_stations):
    odd = two_stations.limit(1)
    rows = odd.withColumn("temperatura_c", F.explode(F.array(*[F.lit(v) for v in (-40.0, 60.0, 60.1, -40.1, math.nan)], F.lit(None).cast("double"))))
    rows = rows.unionByName(odd.withColumn("data", F.lit(None).cast("date")))
    got = {r.temperatura_c for r in warehouse.staged_climate(rows).collect()}
    assert got == {-40.0, 60.0, None}


def test_shares_of_an_empty_season(spark):
    fact = spark.createDataFrame([("Verão", "BAIXO"), ("Verão", "ALTO")], "estacao string, risco_geral string")
    row = gold.executive_summary(fact).first()
    assert (row.total, row.baixo, row.pct_baixo, row.pct_critico) == (2, 1, 50.0, 0.0)
    assert gold.executive_summary(fact.limit(0)).count() == 0


def test_ranking_breaks_ties_by_name_and_year(spark):
    fact = spark.createDataFrame(
        [("Verão", c, "g", 70, 2020 + y, "MÉDIO", "r") for c in "fedcba" for y in (1, 0)],
        "estacao string, cultura string, categoria string, score_final int, ano int, risco_geral string, recomendacao string",
    )
    rows = gold.crop_ranking(fact, 3).orderBy("ranking").collect()
    assert [r.cultura for r in rows] == ["a", "a", "b"]


def test_class_and_score_may_disagree(spark):
    df = spark.createDataFrame([(45, 15, True, True, False, False)], "score_temperatura int, score_precipitacao int, tolerante_seca boolean, tolerante_frio boolean, sensivel_frio boolean, sensivel_calor boolean")
    row = gold.classify(df).first()
    assert row.score_final == 33 and row.risco_geral == "MÉDIO"


def test_orderings(spark):
    mart = spark.createDataFrame([(s, 2000, "Verao", "c", float(v)) for s, v in (("a", 1), ("b", 3), ("c", 3))], "estacao_codigo string, ano int, estacao_ano string, cultura string, risco_total double")
    assert [r.estacao_codigo for r in warehouse.by_risk(mart).collect()] == ["b", "c", "a"]
    seasons = spark.createDataFrame([(2001, "Inverno"), (2000, "Primavera"), (2001, "Verão"), (2000, "Verão")], "ano int, estacao string")
    assert [tuple(r) for r in silver.in_season_order(seasons).collect()] == [(2000, "Verão"), (2001, "Verão"), (2001, "Inverno"), (2000, "Primavera")]


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "sucesso boolean, linhas bigint, bytes bigint")
    row = metrics.ingest_metrics(empty).first()
    assert tuple(row) == (0, 0, 0, 0.0, 0, 0)
    with pytest.raises(ValueError):
        metrics.require_ingested(metrics.ingest_metrics(empty))
    assert metrics.table_not_empty(empty).first()[0] is False
    with pytest.raises(ValueError):
        metrics.require_rows(empty, "clima")
    assert metrics.require_rows(spark.range(1), "x").count() == 1
    totals = {r.fonte: (r.registros, r.status) for r in metrics.layer_totals({"a": spark.range(3), "b": empty}).collect()}
    assert totals == {"a": (3, "success"), "b": (0, "failed"), "total": (3, "success")}
