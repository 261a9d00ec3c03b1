"""Native scores against plain restatements of their rules."""

import itertools
import math

from pyspark.sql import functions as F

from agrometry.functions import risk, suitability


def temperature(temp, low, high):
    if None in (temp, low, high):
        return 50
    off = low - temp if temp < low else temp - high
    if low <= temp <= high:
        return 95
    return 70 if off <= 3 else 45 if off <= 6 else 20


def test_temperature_score_grid(spark):
    grid = list(
        itertools.product([None, math.nan, -5.0, 8.9, 11.9, 12.0, 15.0, 20.0, 20.1, 23.0, 26.0, 26.1], [None, 15, 22], [None, 20, 18])
    )
    df = spark.createDataFrame(grid, "t double, lo int, hi int").withColumn(
        "s", suitability.temperature_score(F.col("t"), F.col("lo"), F.col("hi"))
    )
    for row in df.collect():
        assert row.s == temperature(row.t, row.lo, row.hi), row


def rain(mm, need, days):
    if mm is None or need is None or math.isnan(mm):
        return 50
    low, high, critical = {"Alta": (200, 500, 100), "Baixa": (30, 200, 15)}.get(need, (100, 350, 50))
    if low <= mm <= high:
        return 95 if days and days >= 15 else 80
    if mm < critical:
        return 15
    if mm < low:
        return 50
    return 30 if mm - high > 300 else 60


def test_rain_score_grid(spark):
    edges = [0.0, 14.9, 15.0, 29.9, 30.0, 49.9, 50.0, 99.9, 100.0, 199.9, 200.0, 200.1, 350.0, 350.1, 500.0, 500.1, 650.0, 650.1, 800.0, 800.1]
    grid = list(
        itertools.product([None, math.nan, *edges], [None, "Alta", "Média", "Baixa", "Variável"], [None, 0, 14, 15, 90])
    )
    df = spark.createDataFrame(grid, "mm double, need string, days bigint").withColumn(
        "s", suitability.rain_score(F.col("mm"), F.col("need"), F.col("days"))
    )
    for row in df.collect():
        assert row.s == rain(row.mm, row.need, row.days), row


def overall(temp, rained, dry, cold, frost, heat):
    if temp is None or rained is None:
        return "INDEFINIDO"
    points = temp * 0.6 + rained * 0.4
    points += 15 * bool(dry and rained < 50) + 15 * bool(cold and temp < 60)
    points -= 20 * bool(frost and temp < 70) + 20 * bool(heat and temp < 70)
    points = min(100, max(0, points))
    return "BAIXO" if points >= 80 else "MÉDIO" if points >= 60 else "ALTO" if points >= 40 else "CRÍTICO"


def test_overall_risk_grid(spark):
    flags = [None, True, False]
    grid = list(itertools.product([None, 20, 45, 50, 70, 95], [None, 15, 30, 50, 60, 80, 95], flags, flags, flags, flags))
    df = spark.createDataFrame(grid, "t int, r int, a boolean, b boolean, c boolean, d boolean").withColumn(
        "s", suitability.overall_risk(*[F.col(c) for c in "trabcd"])
    )
    df = df.withColumns({"text": suitability.advice(F.col("s")), "final": suitability.final_score(F.col("t"), F.col("r"))})
    for row in df.collect():
        assert row.s == overall(*row[:6]), row
        assert (row.text == "❓ DADOS INSUFICIENTES") == (row.s == "INDEFINIDO")
        if row.t is not None and row.r is not None:
            assert row.final == round(row.t * 0.6 + row.r * 0.4)
    odd = spark.sql("select cast(null as string) r union all select 'outro'").select(suitability.advice(F.col("r")))
    assert {r[0] for r in odd.collect()} == {"❓ DADOS INSUFICIENTES"}


def _drought(spark, rows):
    df = spark.createDataFrame(rows, "mm string, water int, tolerant boolean")
    dry = risk.dryness(F.col("mm").cast("decimal(16,1)"))
    score = risk.drought_risk(dry, risk.thirst(F.col("water"), F.col("tolerant")))
    return [float(r[0]) for r in df.select(score).collect()]


def test_drought_risk(spark):
    assert _drought(spark, [("0", 3, False), ("0", 1, True), ("300", 3, False), ("450", 3, False), ("150", 2, None)]) == [
        30.0, 7.0, 0.0, 0.0, 10.0,
    ]


def test_missing_rain_is_the_worst_drought(spark):
    assert _drought(spark, [(None, 1, False)]) == [100.0]


def test_drought_ties_follow_twenty_digit_quotients(spark):
    # 29.95 exactly in real numbers; the kept quotient is rounded up for 0.5
    # (so the score falls short of the tie) and is exact for 1.5.
    assert _drought(spark, [("0.5", 3, False), ("1.5", 3, False), ("2.5", 3, False)]) == [29.9, 29.9, 29.8]


def test_cold_and_heat_risk(spark):
    df = spark.createDataFrame(
        [("8.0", 10, False, True), ("8.0", 10, True, True), ("8.0", None, False, True), ("-9.0", 10, False, False), (None, 10, False, False), ("9.7", 10, None, True)],
        "t string, ideal int, tolerant boolean, sensitive boolean",
    )
    temp = F.col("t").cast("decimal(16,1)")
    cold = risk.cold_risk(temp, F.col("ideal"), F.col("tolerant"), F.col("sensitive"))
    assert [float(r[0]) for r in df.select(cold).collect()] == [3.0, 0.0, 0.0, 10.0, 0.0, 0.5]
    heat = risk.heat_risk(-temp, -F.col("ideal"), F.col("sensitive"))
    assert [float(r[0]) for r in df.select(heat).collect()] == [3.0, 3.0, 0.0, 10.0, 0.0, 0.5]


def test_class_limits_are_exact(spark):
    df = spark.createDataFrame([("5.9",), ("6.0",), ("13.4",), ("13.5",), ("20.9",), ("21.0",)], "s string")
    zero = F.lit(0).cast("decimal(6,1)")
    label = risk.risk_class(F.col("s").cast("decimal(6,1)"), zero, zero)
    assert [r[0] for r in df.select(label).collect()] == ["Baixo", "Medio", "Medio", "Alto", "Alto", "Critico"]
