"""Station, crop and raw files, written and read back."""

import pytest
from pyspark.sql import functions as F

from agrometry.operators.bronze import SOURCE_FILE, bronze_climate
from agrometry.quality import rulesets
from agrometry.plans.ingest import ingest, ingest_source
from agrometry.sources import readers, writers

HEADER = "Data;Hora UTC;PRECIPITAÇÃO TOTAL, HORÁRIO (mm);TEMPERATURA DO AR - BULBO SECO, HORARIA (°C)"
PREAMBLE = ["REGIAO:;SE", "UF:;SP", "ESTACAO:;SÃO PAULO", "CODIGO (WMO):;A771", "LATITUDE:;-23", "LONGITUDE:;-46", "ALTITUDE:;771", "DATA DE FUNDACAO:;20/11/2018"]
NAME = "INMET_SE_SP_A771_SAO PAULO - INTERLAGOS_01-01-2025_A_31-12-2025"


def station_file(path, rows, header=HEADER):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes("\n".join([*PREAMBLE, header, *rows, ""]).encode("latin1"))


@pytest.fixture
def weather(tmp_path):
    station_file(
        tmp_path / "2025" / f"{NAME}.CSV",
        ["2025/01/01;0000 UTC;0,2;23,5", "2025/01/01;0100 UTC;;", "2025/01/01;0200 UTC;1;2;3;4", "2025/01/02;0300 UTC", "lixo;0400 UTC;nan;NA"],
    )
    return tmp_path


def test_weather_csv(spark, weather):
    df = readers.read_weather_csv(spark, str(weather))
    assert df.columns == [*HEADER.split(";"), SOURCE_FILE]
    rows = {r["Hora UTC"]: r for r in df.collect()}
    assert sorted(rows) == ["0000 UTC", "0100 UTC", "0300 UTC", "0400 UTC"]  # too long: gone; short: padded
    assert tuple(rows["0000 UTC"])[2:4] == ("0,2", "23,5")
    for hour in ("0100 UTC", "0300 UTC", "0400 UTC"):
        assert tuple(rows[hour])[2:4] == (None, None)
    assert NAME in rows["0000 UTC"][SOURCE_FILE]


def test_weather_csv_given_columns_and_pruned(spark, weather):
    df = readers.read_weather_csv(spark, str(weather), columns=HEADER.split(";"))
    assert df.select("Data").count() == 4


def test_weather_csv_layouts_are_united(spark, weather):
    station_file(weather / "2018" / f"{NAME.replace('2025', '2018')}.CSV", ["2018/05/01;0000 UTC;7"], "Data;Hora UTC;UMIDADE RELATIVA DO AR, HORARIA (%)")
    df = readers.read_weather_csv(spark, str(weather))
    assert "UMIDADE RELATIVA DO AR, HORARIA (%)" in df.columns and df.count() == 5
    bronze = bronze_climate(df)
    years = {(r.ano, r.umidade_pct, r.estacao_nome) for r in bronze.select(F.year("data").alias("ano"), "umidade_pct", "estacao_nome").collect()}
    assert years == {(2018, 7.0, "SAO PAULO - INTERLAGOS"), (2025, None, "SAO PAULO - INTERLAGOS")}


def test_no_header_is_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x;y\n1;2\n")
    with pytest.raises(ValueError):
        readers.read_weather_csv(spark, str(tmp_path))


def test_reference_csv(spark, tmp_path):
    (tmp_path / "c.csv").write_text('Cultura,Clima Ideal,Observações Práticas\nCafé,"18-23°C; sombra",Sensível\nMilho\nSoja,1,2,3\n', encoding="utf-8")
    rows = readers.read_reference_csv(spark, str(tmp_path)).orderBy("Cultura").collect()
    assert [tuple(r)[:3] for r in rows] == [("Café", "18-23°C; sombra", "Sensível"), ("Milho", None, None)]


def test_reference_csv_layouts_are_united(spark, tmp_path):
    (tmp_path / "a.csv").write_text("\ufeffCultura,Categoria\nCafé,grão\n", encoding="utf-8")
    (tmp_path / "b.csv").write_text('Categoria,"Solo, tipo",Cultura\nfruta,arenoso,Manga\n', encoding="utf-8")
    df = readers.read_reference_csv(spark, str(tmp_path))
    rows = {(r.Cultura, r.Categoria, r["Solo, tipo"]) for r in df.collect()}
    assert rows == {("Café", "grão", None), ("Manga", "fruta", "arenoso")}


def test_listing_years_and_flat_files(spark, weather):
    (weather / "solto.CSV").write_text("a;b")
    listing = readers.list_files(spark, str(weather), "*.CSV")
    years = {r[SOURCE_FILE].rsplit("/", 1)[-1]: r.year for r in listing.collect()}
    assert years == {f"{NAME}.CSV": "2025", "solto.CSV": "raw"}
    assert readers.list_files(spark, str(weather), year="2025").count() == 1
    assert listing.where(F.col("bytes") < 10).count() == 1


def test_ingest_rejects_whole_files(spark, tmp_path):
    src = tmp_path / "src"
    station_file(src / "2025" / f"{NAME}.CSV", ["2025/01/01;0000 UTC;0,2;23,5", "2025/01/02;0000 UTC;0,2;23,5"])
    station_file(src / "2024" / f"{NAME.replace('2025', '2024')}.CSV", ["2024/01/01;0000 UTC;0,2;23,5", ";0100 UTC;1;2"])
    station_file(src / "2023" / f"{NAME.replace('2025', '2023')}.CSV", [])
    rows = readers.read_weather_csv(spark, str(src))
    metrics = ingest(spark, rows, str(src), str(tmp_path / "raw"), rulesets.CLIMATE).first()
    assert (metrics.total_arquivos, metrics.arquivos_ingeridos, metrics.arquivos_com_erro) == (3, 1, 2)
    assert metrics.linhas_processadas == 2 and metrics.taxa_sucesso == 33.33 and metrics.bytes_processados > 100
    raw = readers.read_raw(spark, str(tmp_path / "raw"))
    assert {r.year for r in raw.collect()} == {"2025"} and set(t for _, t in raw.dtypes) == {"string"}
    with pytest.raises(ValueError):
        ingest_source(spark, "clima", str(src), str(tmp_path / "raw2"), year="2024")


def test_raw_round_trip_keeps_year_and_nulls(spark, tmp_path):
    df = spark.createDataFrame([("2024", "a", 1.5), ("2025", None, None), (None, "c", 2.0)], "year string, v string, n double")
    writers.write_raw(df, str(tmp_path / "r"))
    back = readers.read_raw(spark, str(tmp_path / "r"))
    assert {tuple(r) for r in back.select("year", "v", "n").collect()} == {("2024", "a", "1.5"), ("2025", None, None), ("raw", "c", "2.0")}
    one = readers.read_raw(spark, str(tmp_path / "r"), year="2024")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert one.count() == 1 and "PartitionFilters: [isnotnull(year" in plan


def test_numeric_years_stay_strings(spark, tmp_path):
    writers.write_raw(spark.createDataFrame([(2024, 1)], "year int, v int"), str(tmp_path / "r"))
    assert readers.read_raw(spark, str(tmp_path / "r")).first().year == "2024"


def test_raw_many_unites_by_name(spark, tmp_path):
    spark.createDataFrame([(1, "x")], "a int, b string").write.parquet(str(tmp_path / "p1"))
    spark.createDataFrame([("y",)], "b string").write.parquet(str(tmp_path / "p2"))
    df = readers.read_raw_many(spark, [str(tmp_path / "p1"), str(tmp_path / "p2")])
    assert {tuple(r) for r in df.collect()} == {(1, "x"), (None, "y")}


def test_station_from_real_file_path(spark, tmp_path):
    df = spark.createDataFrame([("2025/01/01", "0000 UTC", "21,5")], "`Data` string, `Hora UTC` string, `TEMPERATURA DO AR - BULBO SECO` string")
    df.coalesce(1).write.parquet(str(tmp_path / "w"))
    part = next((tmp_path / "w").glob("part-*.parquet"))
    (tmp_path / "raw" / "year=2025").mkdir(parents=True)
    (tmp_path / "raw" / "year=2025" / f"{NAME}.parquet").write_bytes(part.read_bytes())
    row = bronze_climate(readers.read_raw(spark, str(tmp_path / "raw"))).first()
    assert (row.uf, row.estacao_codigo, row.estacao_nome) == ("SP", "A771", "SAO PAULO - INTERLAGOS")
    assert row.temperatura_c == 21.5 and row.camada == "bronze" and row.processado_em is not None


def test_layers_by_season_overwrite(spark, tmp_path):
    df = spark.createDataFrame([("Verão", 1), ("Inverno", 2)], "estacao string, v int")
    for _ in range(2):
        writers.write_layer(df, str(tmp_path / "g"), partition_by="estacao")
    assert sorted(p.name[:7] for p in (tmp_path / "g").glob("estacao=*")) == ["estacao", "estacao"]
    assert readers.read_layer(spark, str(tmp_path / "g")).count() == 2


def test_tables_load_blank_as_null(spark):
    df = spark.createDataFrame([("", 1), ("SP", 2)], "uf string, v int")
    writers.load_tables({"t1": df, "t2": df}, only="t1", schema="carga")
    assert {r.uf for r in readers.read_relation(spark, "carga.t1").collect()} == {None, "SP"}
    assert not spark.catalog.tableExists("carga.t2")
    writers.load_tables({"t1": df.limit(1), "t2": df}, schema="carga")
    assert readers.read_relation(spark, "carga.t1").count() == 1 and spark.catalog.tableExists("carga.t2")
    with pytest.raises(ValueError):
        writers.load_tables({"t1": df}, only="outra")


def test_materialize_kinds(spark):
    df = spark.range(3)
    assert writers.materialize(df, "m", "view", "silver").count() == 3
    assert writers.materialize(df, "m", "table", "silver").count() == 3
    assert readers.read_relation(spark, "silver.m").count() == 3
    with pytest.raises(ValueError):
        writers.materialize(df, "m", "outro", "silver")


def test_sample_rows(spark):
    assert writers.sample_rows(spark.range(50), 5).count() == 5


def test_files_without_a_header_are_told(spark, weather):
    (weather / "2025" / "nada.CSV").write_text("x;y\n1;2\n")
    with pytest.raises(Exception, match="nenhum cabe"):
        readers.read_weather_csv(spark, str(weather)).collect()
    marked = readers.read_weather_csv(spark, str(weather), strict=False)
    assert marked.where(readers.NO_HEADER).count() == 2 and marked.where(f"not {readers.NO_HEADER}").count() == 4


def test_many_layouts_and_odd_rows(spark, tmp_path):
    for k in range(30):
        station_file(tmp_path / "2025" / f"f{k}.CSV", [f"2025/01/01;0000 UTC;{k}", "obs:;0100 UTC;7"], f"Data;Hora UTC;Medida {k}")
    (tmp_path / "2025" / "f0.CSV").write_bytes("REGIAO;SE\nData;Hora UTC;Medida 0\n2025/01/01;0000 UTC;0\nobs:;0100 UTC;7\n".encode("latin1"))
    df = readers.read_weather_csv(spark, str(tmp_path))
    assert len(df.columns) == 33 and df.count() == 60
    assert df.where("Data = 'obs:'").count() == 30
    assert df.where("`Medida 7` = '7' and Data <> 'obs:'").count() == 1


def test_spellings_of_one_column_meet(spark):
    df = spark.createDataFrame([("2025/01/01", "0 UTC", "1", None), ("2025/01/02", "0 UTC", None, "2,5")], "Data string, `Hora UTC` string, `PRECIPITACAO TOTAL` string, `precipitação total (mm)` string")
    got = bronze_climate(df.withColumn(SOURCE_FILE, F.lit(f"{NAME}.CSV"))).select("precipitacao_mm").collect()
    assert sorted(r[0] for r in got) == [1.0, 2.5]
    with pytest.raises(ValueError):
        bronze_climate(df.drop("Data").withColumn(SOURCE_FILE, F.lit("x")))


def test_quoted_separators_and_line_breaks(spark, tmp_path):
    (tmp_path / "c.csv").write_text('Cultura,Categoria\n"Cafe, milho, soja, uva",grao\n"Linha\nquebrada","diz ""a"""\nLonga,1,2\nCurta\n', encoding="utf-8")
    rows = readers.read_reference_csv(spark, str(tmp_path)).collect()
    assert {tuple(r)[:2] for r in rows} == {("Cafe, milho, soja, uva", "grao"), ("Linha\nquebrada", 'diz "a"'), ("Curta", None)}


def _files(folder):
    return [f for f in folder.rglob("*.parquet")]


def test_raw_store_has_a_bounded_number_of_files(spark, tmp_path):
    rows = [(str(2000 + k % 3), f"file:/x/{k}.csv", str(k)) for k in range(900)]
    df = spark.createDataFrame(rows, f"year string, {SOURCE_FILE} string, v string").repartition(8)
    writers.write_raw(df, str(tmp_path / "r"), buckets=4)
    assert len(_files(tmp_path / "r")) <= 12
    writers.write_raw(df.where("v < '5'"), str(tmp_path / "r"), buckets=99)
    assert len(_files(tmp_path / "r")) <= 12 and readers.read_raw(spark, str(tmp_path / "r")).count() == 900


def test_changed_files_and_removed_rows(spark, tmp_path):
    path, schema = str(tmp_path / "r"), f"year string, {SOURCE_FILE} string, v string"
    held = {("2024", f"f{k}", f"{k}.{i}") for k in range(40) for i in range(3)} | {("2025", "f1", "z"), ("2024", None, "n")}
    writers.write_raw(spark.createDataFrame(sorted(held, key=str), schema), path, buckets=3)
    brought = {("2024", "f1", "1.0"), ("2024", "f7", "7.0"), ("2024", "f7", "new"), ("2026", "f7", "y"), ("2024", None, "m")}
    writers.write_raw(spark.createDataFrame(sorted(brought, key=str), schema), path)
    keys = {r[:2] for r in brought}
    want = {r for r in held if r[:2] not in keys} | brought
    assert sorted(map(str, (tuple(r) for r in readers.read_raw(spark, path).select("year", SOURCE_FILE, "v").collect()))) == sorted(map(str, want))


def test_a_store_is_read_without_its_footers(spark, tmp_path):
    path, schema = tmp_path / "r", f"year string, {SOURCE_FILE} string, v string"
    writers.write_raw(spark.createDataFrame([("2024", "a", "1"), ("2025", "b", "2")], schema), str(path))
    writers.write_raw(spark.createDataFrame([("2025", "c", "3", "w")], schema + ", extra string"), str(path))
    for part in (path / "year=2024").rglob("*.parquet"):
        part.write_bytes(b"broken")
    for check in path.rglob(".*.crc"):
        check.unlink()
    back = readers.read_raw(spark, str(path), year="2025")
    assert {(r.v, r.extra) for r in back.collect()} == {("2", None), ("3", "w")}


def test_raw_writes_replace_only_their_files(spark, tmp_path):
    path = str(tmp_path / "raw")
    rows = [("2023", "a", "1"), ("2024", "b", "2"), ("2024", "c", "3")]
    writers.write_raw(spark.createDataFrame(rows, f"year string, {SOURCE_FILE} string, v string"), path)
    writers.write_raw(spark.createDataFrame([("2024", "b", "9", "w")], f"year string, {SOURCE_FILE} string, v string, extra string"), path)
    back = readers.read_raw(spark, path)
    assert {(r.year, r[SOURCE_FILE], r.v, r.extra) for r in back.collect()} == {("2023", "a", "1", None), ("2024", "b", "9", "w"), ("2024", "c", "3", None)}


def test_ingest_of_one_source_filters_files(spark, tmp_path):
    src = tmp_path / "src"
    for year in ("2024", "2025"):
        station_file(src / year / f"{NAME.replace('2025', year)}.CSV", [f"{year}/01/01;0000 UTC;0,2;23,5"])
    (src / "2025" / "nada.CSV").write_text("x;y\n1;2\n")
    raw = str(tmp_path / "raw")
    first = ingest_source(spark, "clima", str(src), raw).first()
    assert (first.total_arquivos, first.arquivos_ingeridos, first.arquivos_com_erro) == (3, 2, 1)
    second = ingest_source(spark, "clima", str(src), raw, file_filter=lambda name: name.contains("2024"))
    assert second.first().total_arquivos == 1
    assert {r.year for r in readers.read_raw(spark, raw).collect()} == {"2024", "2025"}


def test_files_that_are_not_chosen_are_never_opened(spark, tmp_path):
    src = tmp_path / "src"
    for year in ("2024", "2025"):
        station_file(src / year / f"{NAME.replace('2025', year)}.CSV", [f"{year}/01/01;0000 UTC;0,2;23,5"])
    (src / "2025" / "quebrado.csv.gz").write_bytes(b"\x1f\x8bno gzip at all")
    (src / "2025" / "outro.csv.gz").write_bytes(b"\x1f\x8bno gzip either")
    with pytest.raises(Exception, match="gz"):
        ingest_source(spark, "clima", str(src), str(tmp_path / "raw"))
    chosen = ingest_source(spark, "clima", str(src), str(tmp_path / "raw"), year="2024").first()
    assert (chosen.total_arquivos, chosen.arquivos_ingeridos) == (1, 1)
    named = ingest_source(spark, "clima", str(src), str(tmp_path / "raw"), year="2025", file_filter=lambda path: path.endswith(".CSV"))
    assert named.first().total_arquivos == 1
    assert readers.read_reference_csv(spark, str(src), encoding="ISO-8859-1", files=lambda path: path.contains("2024")).count() > 0


def test_ingest_scans_the_lines_once(spark, tmp_path):
    station_file(tmp_path / "2025" / f"{NAME}.CSV", ["2025/01/01;0000 UTC;0,2;23,5"])
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    once = plan(readers.read_weather_csv(spark, str(tmp_path), strict=False, scan_once=True))
    assert " text" not in once and once.count("Relation [") <= 2
    assert plan(readers.read_weather_csv(spark, str(tmp_path), strict=False)).count(" text") == 1


def test_a_load_that_fails_leaves_the_old_rows(spark, tmp_path):
    load = lambda df: writers.load_table(df, "t", "troca", str(tmp_path))
    load(spark.range(5))
    reader = spark.newSession()
    broken = spark.range(100).select(F.when(F.col("id") > 90, F.raise_error(F.lit("parou")).cast("bigint")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="parou"):
        load(broken)
    assert reader.table("troca.t").count() == 5
    for rows in (7, 8, 9):
        load(spark.range(rows))
        assert spark.table("troca.t").count() == rows and spark.newSession().table("troca.t").count() == rows
    assert len(list((tmp_path / "troca.db" / writers.VERSIONS_FOLDER / "t").iterdir())) == 2
    load(spark.range(3).withColumn("mais", F.lit("x")))
    assert spark.newSession().table("troca.t").columns == ["id", "mais"]


def test_views_last_and_follow_their_tables(spark, tmp_path):
    writers.load_table(spark.range(5), "base", "visto", str(tmp_path))
    writers.materialize("SELECT id * 2 AS dobro FROM visto.base", "v", "view", "visto", str(tmp_path), spark)
    other = spark.newSession()
    assert other.table("visto.v").agg(F.sum("dobro")).first()[0] == 20
    writers.load_table(spark.range(3), "base", "visto", str(tmp_path))
    assert spark.newSession().table("visto.v").count() == 3
    writers.materialize("SELECT id FROM visto.base", "copia", "table", "visto", str(tmp_path), spark)
    assert spark.newSession().table("visto.copia").count() == 3
