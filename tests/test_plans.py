"""End-to-end chains, and the shape of physical plans."""

import datetime
import tempfile

import pytest
from pyspark.sql import functions as F

from agrometry.operators import bronze, gold
from agrometry.plans import catalogue, inputs, jobs, medallion, warehouse
from agrometry.sources import readers, writers
from agrometry.sources.scratch import scratch_folder
from agrometry.streaming.bronze import append_new_files

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("raw")
    weather = inputs.raw_weather(spark, FOLDER).withColumn("year", F.substring("Data", 1, 4))
    writers.write_raw(weather, str(root / "clima"))
    writers.write_raw(inputs.raw_crops(spark, FOLDER).limit(40), str(root / "agricultura"))
    writers.write_raw(inputs.raw_soils(spark, FOLDER).limit(3), str(root / "solos"))
    return root


def test_medallion_chain(spark, raw, tmp_path):
    answers = medallion.run(spark, str(raw / "clima"), (str(raw / "agricultura"), str(raw / "solos")), str(tmp_path))
    at = medallion.lake_paths(str(tmp_path))
    reports = at.pop("gold.relatorios")
    at.update({f"gold.{n}": f"{reports}/{n}" for n in ("ranking_culturas", "distribuicao_risco")})
    tables = {name: readers.read_layer(spark, path) for name, path in at.items()}
    dated = tables["bronze.clima"].count()
    assert dated == catalogue.bronze_climate(spark, FOLDER).count()
    assert tables["bronze.culturas"].count() == 43
    seasons = tables["silver.clima_estacional"].count()
    fact = tables["gold.fato_risco_climatico"]
    # crops without a name stay on this route
    assert fact.count() == seasons * 43
    assert tables["silver.clima_diario"].agg(F.sum("qtd_registros")).first()[0] == dated
    assert tables["gold.ranking_culturas"].count() == 40
    assert tables["gold.distribuicao_risco"].agg(F.sum("count")).first()[0] == fact.count()
    assert [r.estacao for r in answers["resumo_executivo"].collect()] == ["Verão", "Outono", "Inverno", "Primavera"]
    assert answers["top_arriscadas"].count() == 5
    # running again replaces, never appends
    medallion.gold_layer(spark, str(tmp_path))
    assert readers.read_layer(spark, at["gold.fato_risco_climatico"]).count() == seasons * 43


def test_medallion_reads_csv_too(spark, tmp_path):
    path = tmp_path / "INMET_SE_SP_A001_X_01-01-2024_A_31-12-2024.CSV"
    path.write_text("UF:;SP\nData;Hora UTC;PRECIPITACAO TOTAL\n2024/01/01;0000 UTC;1,5\n", encoding="latin1")
    row = bronze.bronze_climate(jobs.read_climate(spark, str(path))).first()
    assert (row.uf, row.estacao_codigo, row.precipitacao_mm, row.temperatura_c) == ("SP", "A001", 1.5, None)


def test_warehouse_chain_matches_the_lazy_mart(spark, tmp_path):
    climate, crops = inputs.hourly(spark, FOLDER), inputs.crops(spark, FOLDER)
    models = warehouse.build_models(spark, climate, crops, location=str(tmp_path))
    lazy = warehouse.risk_mart(climate, crops)
    stored = readers.read_relation(spark, "gold.fct_risco_climatico").select(*lazy.columns)
    assert stored.count() == lazy.count() > 0
    assert stored.exceptAll(lazy).count() == 0 and set(models) == {
        "stg_clima", "stg_culturas", "int_clima_mensal", "int_clima_sazonal", "fct_risco_climatico",
    }


def test_scratch_uses_the_shared_folder_when_there_is_one(spark):
    class Session:
        def __init__(self, shared, master="local[2]", context=None):
            self.conf = self.sparkContext = self
            self.shared, self.master, self.context = shared, master, context

        def get(self, name, default):
            return self.shared if name == "spark.checkpoint.dir" and self.shared else default

        def getCheckpointDir(self):
            return self.context

    assert scratch_folder(Session("hdfs://shared/dir/"), "x").startswith("hdfs://shared/dir/x-")
    assert scratch_folder(Session(None, context="hdfs://other"), "x").startswith("hdfs://other/x-")
    assert scratch_folder(Session(None), "x").startswith(tempfile.gettempdir())
    with pytest.raises(ValueError):
        scratch_folder(Session(None, "spark://host:1"), "x")
    assert scratch_folder(spark, "x") != scratch_folder(spark, "x")


def test_products_are_hash_joins_and_scans_are_pruned(spark):
    for name in ("fct_risco_climatico", "fato_risco_por_estacao"):
        text = plan(catalogue.queries()[name](spark, FOLDER))
        assert "CartesianProduct" not in text and "NestedLoop" not in text and "Python" not in text
    text = plan(catalogue.queries()["int_clima_mensal"](spark, FOLDER))
    assert "l_linestatus" not in text.split("FileScan parquet")[1].split("Batched")[0]


def test_top_k_is_cut_before_the_shuffle(spark):
    text = plan(catalogue.queries()["ranking_por_estacao"](spark, FOLDER))
    assert "WindowGroupLimit" in text and "Partial" in text
    assert "TakeOrderedAndProject" in plan(catalogue.queries()["top_riscos_mart"](spark, FOLDER))


def test_no_query_uses_python_rows_or_products(spark):
    for name in ("bronze_clima_typed", "bronze_culturas", "dq_report_clima", "clima_estacional", "resumo_executivo"):
        text = plan(catalogue.queries()[name](spark, FOLDER))
        assert "EvalPython" not in text and "CartesianProduct" not in text, name


def test_season_filter_prunes_partitions(spark, tmp_path):
    writers.write_layer(catalogue.fact(spark, FOLDER), str(tmp_path / "g"), partition_by="estacao")
    text = plan(readers.read_layer(spark, str(tmp_path / "g")).where(F.col("estacao") == "Verão"))
    assert "PartitionFilters: [isnotnull(estacao" in text


def test_stream_appends_only_new_files(spark, tmp_path):
    def drop_file(day):
        row = (f"2024/01/{day:02d}", "0000 UTC", "1,5", "INMET_SE_SP_A001_X_01-01-2024_A_31-12-2024.CSV")
        df = spark.createDataFrame([row], "`Data` string, `Hora UTC` string, `PRECIPITACAO TOTAL` string, arquivo_origem string")
        df.write.mode("append").parquet(str(tmp_path / "raw" / "year=2024"))
        return df.schema

    def load(schema):
        append_new_files(spark, str(tmp_path / "raw"), schema, str(tmp_path / "bronze"), str(tmp_path / "ck")).awaitTermination()
        return spark.read.parquet(str(tmp_path / "bronze")).collect()

    assert len(load(drop_file(1))) == 1
    rows = load(drop_file(2))
    assert {r.data for r in rows} == {datetime.date(2024, 1, 1), datetime.date(2024, 1, 2)} and len(rows) == 2


def test_fact_columns(spark):
    assert gold.crop_risk_fact(catalogue.seasonal(spark, FOLDER), inputs.crops(spark, FOLDER)).columns == [
        "cultura", "categoria", "ano", "estacao", "temp_real", "temp_min_real", "temp_max_real", "precipitacao_mm",
        "dias_chuva", "umidade_media", "temp_min_ideal", "temp_max_ideal", "necessidade_de_agua", "tolerante_seca",
        "tolerante_frio", "sensivel_frio", "sensivel_calor", "score_temperatura", "score_precipitacao", "score_final",
        "risco_geral", "recomendacao",
    ]


def test_reports_over_counts_equal_those_over_the_fact(spark):
    seasons = catalogue.seasonal(spark, FOLDER)
    crops = inputs.crops(spark, FOLDER).withColumn("necessidade_de_agua", F.when(F.col("tolerante_frio"), F.lit(None)).otherwise(F.col("necessidade_de_agua")))
    fact, counts = gold.crop_risk_fact(seasons, crops), gold.risk_counts(seasons, crops, "cultura", "categoria")
    for report in (gold.risk_distribution, gold.executive_summary, gold.most_versatile_crops, gold.riskiest_crops):
        assert sorted(map(tuple, report(fact).collect())) == sorted(map(tuple, report(counts).collect()))


def test_cleaning_is_counted_by_the_writing_query(spark, tmp_path):
    from pyspark.sql import Observation

    from agrometry.operators import metrics

    counts = Observation()
    rows = bronze.bronze_climate(inputs.raw_weather(spark, FOLDER), counts)
    assert plan(rows).count("FileScan") == 1
    writers.write_layer(rows, str(tmp_path / "b"))
    facts = metrics.cleaning_facts(counts)
    assert facts == metrics.cleaning_counts(inputs.raw_weather(spark, FOLDER).transform(bronze.rename_weather_columns).transform(bronze.type_climate_columns)).first().asDict()
    assert facts["registros_depois"] == spark.read.parquet(str(tmp_path / "b")).count()


def test_dates_and_paths_are_worked_out_once(spark):
    text = plan(bronze.bronze_climate(inputs.raw_weather(spark, FOLDER)))
    assert text.count("date_format") <= 2 and text.count("regexp_extract(l_shipdate") == 0
