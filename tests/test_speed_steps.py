"""Steps that took most of the time on large tables: same results, and the shape that makes them fast."""

import random
import re
from decimal import Decimal
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from agrometry.functions import numeric
from agrometry.operators import bronze
from agrometry.plans import catalogue, inputs
from agrometry.sources import readers
from agrometry.sources.readers import year_folder
from agrometry.sources.session import COMPILED_BYTES


def test_year_folders_are_cut_without_a_pattern(spark):
    paths = ["file:/a/csv/part=1/year=1997/x.txt", "/a/csv/x.txt", "/a/csv/2024/x.csv", "/x.csv", "x.csv", "/a//x.csv", "", None, "/a/b/year=/x"]
    rows = spark.createDataFrame([(p,) for p in paths], "p string")
    plain = F.regexp_extract("p", r"([^/]+)/[^/]+$", 1)
    want = F.when(plain == "csv", "raw").otherwise(F.regexp_replace(plain, "^year=", ""))
    found = rows.select(year_folder(F.col("p"), "/a/csv/").alias("y"), want.alias("w"))
    assert [r["y"] for r in found.collect()] == [r["w"] for r in found.collect()]
    assert "regexp" not in rows.select(year_folder(F.col("p"), "/a/csv")).drop("w")._jdf.queryExecution().toString()


def test_queries_keep_methods_within_what_the_jvm_compiles(spark, folder="/root/testdata/sf0.001"):
    spark.conf.unset("spark.sql.codegen.hugeMethodLimit")
    catalogue.queries()["bronze_clima_typed"](spark, folder)
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) == COMPILED_BYTES


def test_means_are_divided_without_decimals(spark):
    """Every group of every roll-up is divided; decimals took half the time of a daily roll-up."""
    plan = spark.range(1).select(F.col("id").cast("double").alias("v")).agg(numeric.mean(F.col("v")))._jdf.queryExecution().analyzed().toString()
    assert " div " in plan and not re.search(r"count\(.{0,200}?as decimal\(20,0\)", plan)


@pytest.mark.parametrize("places", [0, 1, 2, 3])
def test_means_and_totals_are_rounded_from_the_exact_quotient(spark, places):
    draw = random.Random(places)
    groups = [[draw.choice([-1, 1]) * round(draw.random() * 10 ** draw.randrange(-2, 9), draw.randrange(8)) for _ in range(draw.randrange(1, 6))] for _ in range(400)]
    groups += [[0.05], [-0.05], [0.15, 0.15], [-0.25], [0.04999999], [-0.04999999], [-0.0500000001], [0.5], [-0.5], [-1e-9, -1e-9], [-0.0005], [9.9e8] * 40, [-9.9e8] * 40 + [0.05]]
    rows = [(k, float(v)) for k, held in enumerate(groups) for v in held]
    how = [numeric.mean(F.col("v"), places).alias("mean"), numeric.total(F.col("v"), places).alias("total")]
    found = {r.k: r for r in spark.createDataFrame(rows, "k int, v double").groupBy("k").agg(*how).collect()}
    step = 10**places

    def rounded(value):
        steps = (2 * abs(value) * step + 1) // 2
        return float((-steps if value < 0 else steps) / step)

    # a value counts with twelve decimals under a thousand, nine under a million, six from there on
    kept = lambda v: Fraction(str(round(Decimal(repr(v)), 12 if abs(v) < 1e3 else 9 if abs(v) < 1e6 else 6)))
    for k, held in enumerate(groups):
        exact = sum(kept(float(v)) for v in held)
        assert found[k].total == rounded(exact), (held, found[k])
        assert found[k].mean == rounded(exact / len(held)), (held, found[k])


@pytest.fixture(scope="module")
def many_stations(spark, tmp_path_factory, folder="/root/testdata/sf0.001"):
    """Line items of five thousand stations."""
    place = str(tmp_path_factory.mktemp("stations"))
    items = inputs.line_items(spark, folder)
    items.withColumn("l_suppkey", (F.col("l_orderkey") * 7 + F.col("l_linenumber") * 1013) % 5000).write.parquet(f"{place}/lineitem.parquet")
    return place


def test_files_of_large_tables_hold_more_stations(spark, many_stations):
    """A file for ten stations each made 36 000 folders at 6 GB, and opening them took a third of the tasks' time."""
    path = catalogue._station_files(spark, many_stations, catalogue.RAIN_SPELLINGS)
    assert readers.list_files(spark, path).count() <= 140
    columns = ["data", "hora_utc", "precipitacao_mm", "umidade_pct"]
    found = catalogue.csv_mixed_layouts(spark, many_stations).select(columns)
    want = bronze.bronze_climate(inputs.raw_weather(spark, many_stations)).select(columns)
    assert found.count() == want.count() > 5000 and found.exceptAll(want).isEmpty() and want.exceptAll(found).isEmpty()


def test_station_files_are_named_once_a_station_and_year(spark, many_stations):
    rows = inputs.raw_weather(spark, many_stations).select(bronze.SOURCE_FILE)
    assert sorted(inputs.weather_files(spark, many_stations).collect()) == sorted(rows.distinct().collect())
    number = F.regexp_extract(bronze.SOURCE_FILE, "_A([0-9]+)_", 1).cast("bigint")
    assert rows.where(~catalogue._station_number().eqNullSafe(number)).isEmpty()


def test_headers_and_line_ends_are_those_of_the_patterns(spark, tmp_path):
    lines = ["Data;Hora UTC", '\ufeff"DATA (x)" ; "Hora', "data;hora", "xdata;hora", "DATA: x;Hora", "ESTACAO;data;hora", "Data", "", '"dATA;\t"hORA', "2024/01/01;data;hora"]
    rows = spark.createDataFrame([(line,) for line in lines], "line string")
    found = rows.select(readers._is_header(F.col("line")).alias("f"), F.col("line").rlike(readers.WEATHER_HEADER).alias("w")).collect()
    assert [r["f"] for r in found] == [r["w"] for r in found] and sum(r["w"] for r in found) == 4
    (tmp_path / "a.txt").write_bytes("a;ç\r\nb;\n\n\u2028c".encode())
    assert [r["line"] for r in readers._lines(spark, str(tmp_path), "UTF-8", None).collect()] == ["a;ç", "b;", "", "\u2028c"]
    (tmp_path / "a.txt").write_bytes("a;ç\nb\x85".encode("ISO-8859-1"))
    assert [r["line"] for r in readers._lines(spark, str(tmp_path), "ISO-8859-1", None).collect()] == ["a;ç", "b\x85"]
