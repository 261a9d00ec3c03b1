"""The shared sample tables, seen as weather, crop and soil data.

Line items are hourly observations of a station (their supplier), parts are
crop and soil records, orders are farm records.  Every row of a table is used.
Some cells are made dirty by a rule on their keys, so that cleaning has work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agrometry.operators.bronze import SOURCE_FILE

# Long headers as weather files have them.
RAIN = "PRECIPITAÇÃO TOTAL, HORÁRIO (mm)"
TEMPERATURE = "TEMPERATURA DO AR - BULBO SECO, HORARIA (°C)"
TEMPERATURE_MAX = "TEMPERATURA MÁXIMA NA HORA ANT. (AUT) (°C)"
DEW_MAX = "TEMPERATURA ORVALHO MAX. NA HORA ANT. (AUT) (°C)"
HUMIDITY = "UMIDADE RELATIVA DO AR, HORARIA (%)"
TEMPERATURE_MIN = "TEMPERATURA MÍNIMA NA HORA ANT. (AUT) (°C)"
PRESSURE = "PRESSAO ATMOSFERICA AO NIVEL DA ESTACAO, HORARIA (mB)"
RADIATION = "RADIACAO GLOBAL (Kj/m²)"
WIND = "VENTO, VELOCIDADE HORARIA (m/s)"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def line_items(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem")


def hourly(spark: SparkSession, folder: str) -> DataFrame:
    """Typed hourly observations; some rows occur twice, some lack a date."""
    items = line_items(spark, folder)
    stations = table(spark, folder, "supplier")
    copies = F.explode(F.sequence(F.lit(1), F.when(F.col("l_returnflag") == "A", 2).otherwise(1)))
    half = F.col("l_quantity") * 0.5
    hot = F.when(F.col("l_linenumber") == 7, 40).otherwise(0)
    key = F.col("l_suppkey") % 10
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    rain = (
        F.when((key == 3) | (F.col("l_returnflag") == "R"), None)
        .when(F.col("l_linenumber") == 1, 0.0)
        .otherwise(F.floor(cents * key / 100) / 10000)
    )
    return (
        items.withColumn("_copy", copies)
        .join(stations, items.l_suppkey == stations.s_suppkey)
        .select(
            F.concat(F.lit("A"), F.lpad(F.col("l_suppkey").cast("string"), 9, "0")).alias("estacao_codigo"),
            F.col("s_name").alias("estacao_nome"),
            F.concat(F.lit("U"), F.lpad(F.col("s_nationkey").cast("string"), 2, "0")).alias("uf"),
            F.when(F.col("l_orderkey") % 97 != 0, F.col("l_shipdate").cast("date")).alias("data"),
            F.concat(F.lpad(F.col("l_linenumber").cast("string"), 2, "0"), F.lit("00 UTC")).alias("hora_utc"),
            rain.alias("precipitacao_mm"),
            F.when(~((F.col("l_linenumber") == 6) & (F.col("l_tax") == 0)), 10 + half + hot).alias("temperatura_c"),
            (10 + half + F.col("l_tax") * 20).alias("temp_max_c"),
            (10 + half - F.col("l_discount") * 20).alias("temp_min_c"),
            (F.col("l_discount") * 1000).alias("umidade_pct"),
            (900 + F.col("l_quantity")).alias("pressao_mb"),
            (cents / 10000).alias("radiacao_kj_m2"),
            (F.col("l_tax") * 100).alias("vento_velocidade_ms"),
        )
    )


def _weather_file():
    """The file of a line item, by station and year."""
    code = F.lpad(F.col("l_suppkey").cast("string"), 9, "0")
    year = F.year("l_shipdate").cast("string")
    uf = F.concat(F.chr(65 + F.col("l_suppkey") % 26), F.chr(65 + F.floor(F.col("l_suppkey") / 26) % 26))
    return F.concat(
        F.lit("file:/raw/"), year, F.lit("/INMET_SE_"), uf, F.lit("_A"), code,
        F.lit("_SERRA%20"), code, F.lit("%20-%20SUL_01-01-"), year, F.lit("_A_31-12-"), year,
        F.lit(".parquet"),
    )


def weather_files(spark: SparkSession, folder: str) -> DataFrame:
    """The distinct files of ``raw_weather``; names are made from distinct stations and years, not for every row."""
    seen = line_items(spark, folder).select("l_suppkey", F.trunc("l_shipdate", "year").alias("l_shipdate")).distinct()
    return seen.select(_weather_file().alias(SOURCE_FILE)).distinct()


def raw_weather(spark: SparkSession, folder: str) -> DataFrame:
    """Text observations under long headers, with the file each row came from."""
    q, line = F.col("l_quantity"), F.col("l_linenumber")
    reading = (10 + q * 0.5).cast("decimal(10,1)").cast("string")
    return line_items(spark, folder).select(
        F.when(F.col("l_orderkey") % 97 == 0, None)
        .when(F.col("l_orderkey") % 89 == 0, "nan")
        .otherwise(F.date_format("l_shipdate", "yyyy/MM/dd"))
        .alias("Data"),
        F.concat(
            F.lpad(((F.col("l_orderkey") * 7 + line) % 24).cast("string"), 2, "0"), F.lit("00 UTC")
        ).alias("Hora UTC"),
        F.replace((F.col("l_tax") * 100).cast("decimal(10,1)").cast("string"), F.lit("."), F.lit(",")).alias(RAIN),
        F.when(line == 7, "")
        .when(line == 6, " ")
        .when(line == 5, ",")
        .when(line == 4, "nan")
        .when(line == 3, reading)
        .otherwise(F.replace(reading, F.lit("."), F.lit(",")))
        .alias(TEMPERATURE),
        (10 + q * 0.5 + F.col("l_tax") * 500).cast("decimal(10,1)").cast("string").alias(TEMPERATURE_MAX),
        (5 + q * 0.5).cast("decimal(10,1)").cast("string").alias(DEW_MAX),
        (F.round(F.col("l_discount") * 1000) + F.when((q == 50) & (line == 1), 50).otherwise(0))
        .cast("int").cast("string").alias(HUMIDITY),
        (10 + q * 0.5 - F.col("l_discount") * 100).cast("decimal(10,1)").cast("string").alias(TEMPERATURE_MIN),
        F.replace((900 + q).cast("decimal(10,1)").cast("string"), F.lit("."), F.lit(",")).alias(PRESSURE),
        F.when(line != 2, F.floor("l_extendedprice").cast("string")).alias(RADIATION),
        F.replace((F.col("l_tax") * 100).cast("decimal(10,1)").cast("string"), F.lit("."), F.lit(",")).alias(WIND),
        _weather_file().alias(SOURCE_FILE),
    )


def crops(spark: SparkSession, folder: str) -> DataFrame:
    """Typed crop reference: one crop per part name, from all parts of that name."""
    size, keys = F.col("tamanho"), F.col("chaves")
    need = F.col("chaves") % 4
    ideal = size % 11 != 0
    return (
        table(spark, folder, "part")
        .groupBy("p_name")
        .agg(
            F.min("p_type").alias("categoria"),
            (F.sum("p_size") % 50).alias("tamanho"),
            F.sum("p_partkey").alias("chaves"),
        )
        .select(
            F.col("p_name").alias("cultura"),
            "categoria",
            F.concat((8 + size % 14).cast("string"), F.lit("-"), (22 + size % 16).cast("string"), F.lit("°C")).alias("clima_ideal"),
            F.when(ideal, 8 + size % 14).cast("int").alias("temp_min_ideal"),
            F.when(ideal, 22 + size % 16).cast("int").alias("temp_max_ideal"),
            F.when(need == 0, "Alta").when(need == 1, "Média").when(need == 2, "Baixa").otherwise("Variável").alias("necessidade_de_agua"),
            F.when(need == 0, 3).when(need == 2, 1).otherwise(2).alias("necessidade_agua_score"),
            (keys % 5 == 0).alias("tolerante_seca"),
            (keys % 7 == 0).alias("tolerante_frio"),
            (size % 4 == 0).alias("sensivel_frio"),
            (keys % 6 == 0).alias("sensivel_calor"),
        )
    )


def raw_crops(spark: SparkSession, folder: str) -> DataFrame:
    """Text crop reference, one row per part, under accented headers."""
    size = F.col("p_size")
    notes = [
        "Tolerante à seca", "Resistente ao frio", "Sensível ao frio", "Sensível ao calor",
        "Tolerante ao frio; sensível à seca", "Rústica",
    ]
    return table(spark, folder, "part").select(
        F.concat(F.lit("C"), F.lpad(F.col("p_partkey").cast("string"), 9, "0"), F.lit(" "), F.col("p_name")).alias("Cultura"),
        F.col("p_type").alias("Categoria"),
        F.when(size % 11 == 0, "pleno sol")
        .otherwise(
            F.concat((8 + size % 14).cast("string"), F.lit("-"), (22 + size % 16).cast("string"), F.lit("°C; pleno sol"))
        )
        .alias("Clima Ideal"),
        F.get(F.array(*[F.lit(n) for n in ("Alta", "Média", "Baixa", "Variável")]), size % 4).alias("Necessidade de Água"),
        F.get(F.array(*[F.lit(n) for n in notes]), size % 7).alias("Observações Práticas"),
    )


def raw_soils(spark: SparkSession, folder: str) -> DataFrame:
    """Soil records, one per supplier; no crop columns."""
    return table(spark, folder, "supplier").select(
        F.col("s_name").alias("Tipo de Solo"),
        F.col("s_nationkey").cast("string").alias("Profundidade"),
    )


def farms(spark: SparkSession, folder: str) -> DataFrame:
    """Farm records, one per order, with some values out of range."""
    return table(spark, folder, "orders").select(
        (F.col("o_custkey") - 20).alias("AREA_HECTARE"),
        F.when(F.col("o_orderpriority").startswith("5"), -F.col("o_totalprice"))
        .otherwise(F.col("o_totalprice")).alias("Producao_t"),
        (F.year("o_orderdate") - F.when(F.col("o_orderstatus") == "P", 200).otherwise(0)).alias("Ano"),
        F.when(F.col("o_orderkey") % 13 == 0, F.lit("sem dado"))
        .otherwise((F.col("o_custkey") - 5).cast("string")).alias("qtd_sacas"),
    )


def soils(spark: SparkSession, folder: str) -> DataFrame:
    """Soil analyses, one per part, with some values out of range."""
    size = F.col("p_size")
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("AMOSTRA"),
        (size / 3).alias("PH_agua"),
        (size * 11).alias("profundidade_cm"),
        (size * 2.5 - 5).alias("argila"),
    )
