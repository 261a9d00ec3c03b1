"""Rules on small frames: pass and fail pairs, severities, isolation, one scan."""

import math
from dataclasses import dataclass

import pytest
from pyspark.sql import functions as F

from agrometry.quality import rules, rulesets, runner
from agrometry.quality.rules import (
    WARNING, Check, DataType, KeywordRange, NoDuplicates, NotEmpty, NotNull, NumericRange, RequiredColumns, Rule,
)
from agrometry.quality.runner import (
    ValidationFailed, file_errors, file_status, file_summary, profile, report, split_by_file, stored_summary, validate, validate_file,
)


def found(df, *rules):
    rows = sorted(report(df, rules).collect(), key=lambda r: r.position)
    return [(r.rule, r.column, r.severity, r.rows_affected) for r in rows]


def numbers(spark, name, values, kind="bigint"):
    return spark.createDataFrame([(v,) for v in values], f"`{name}` {kind}")


def test_not_empty(spark):
    assert found(spark.createDataFrame([], "col1 int"), NotEmpty()) == [("not_empty", None, "ERROR", 0)]
    assert found(numbers(spark, "col1", [1, 2, 3]), NotEmpty()) == []


def test_required_columns(spark):
    df = numbers(spark, "col1", [1])
    assert found(df, RequiredColumns(("col1", "col2"))) == [("required_columns", None, "ERROR", 1)]
    assert found(df, RequiredColumns(("col1",))) == []
    assert found(df.limit(0), RequiredColumns(("x", "y"))) == [("required_columns", None, "ERROR", 0)]


def test_not_null_counts_null_and_nan(spark):
    df = numbers(spark, "col1", [1.0, None, math.nan, 3.0], "double")
    assert found(df, NotNull(("col1", "absent"))) == [("not_null", "col1", "ERROR", 2)]
    assert found(numbers(spark, "col1", [1, 2, 3]), NotNull(("col1",))) == []


def test_text_nan_is_not_null(spark):
    assert found(numbers(spark, "c", ["nan", None], "string"), NotNull(("c",))) == [("not_null", "c", "ERROR", 1)]


def test_numeric_range_reports_both_sides(spark):
    df = numbers(spark, "temp", [-50, 10, 100])
    assert found(df, NumericRange("temp", -15, 50)) == [
        ("numeric_range", "temp", "ERROR", 1), ("numeric_range", "temp", "ERROR", 1)
    ]
    messages = [r.message for r in report(df, [NumericRange("temp", -15, 50)]).orderBy("position").collect()]
    assert messages == [
        "Coluna 'temp' tem 1 valores abaixo de -15", "Coluna 'temp' tem 1 valores acima de 50"
    ]
    assert found(numbers(spark, "temp", [10, 20, 30]), NumericRange("temp", -15, 50)) == []


def test_ranges_ignore_what_does_not_read_as_a_number(spark):
    df = numbers(spark, "TEMP", ["99,5", "1d", "nan", "x", "", None, " 70 ", "1e2"], "string")
    assert found(df, NumericRange("TEMP", 0, 50)) == [("numeric_range", "TEMP", "ERROR", 2)]
    assert found(df, NumericRange("TEMP", 0, 50, decimal_comma=True)) == [("numeric_range", "TEMP", "ERROR", 3)]
    assert found(numbers(spark, "TEMP", [math.nan], "double"), NumericRange("TEMP", 0, 50)) == []


def test_duplicates(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (None, "c"), (None, "c")], "k int, v string")
    assert found(df, NoDuplicates(("k",))) == [("no_duplicates", None, "ERROR", 3)]
    assert found(df, NoDuplicates()) == [("no_duplicates", None, "ERROR", 2)]
    assert found(df.distinct(), NoDuplicates()) == []


def test_data_types_with_samples(spark):
    df = spark.createDataFrame(
        [(str(v), d) for v, d in zip("1 2 x y z q r s".split(), ["2024-01-01", "nan", None, "2024/02/30", "2024/02/28", "a", "b", "c"])],
        "n string, d string",
    )
    rows = report(df, [DataType("n", "numeric"), DataType("d", "datetime"), DataType("n", "string"), DataType("zz", "numeric")]).orderBy("position").collect()
    assert [(r.column, r.rows_affected) for r in rows] == [("n", 6), ("d", 5)]
    assert rows[0].sample_values == ["q", "r", "s", "x", "y"]
    assert rows[1].sample_values == ["2024/02/30", "a", "b", "c", "nan"]


def test_keywords_match_inside_names(spark):
    df = spark.createDataFrame([(1, 2)], "plano int, ano int")
    assert [c for _, c, _, _ in found(df, rulesets.YEAR)] == ["plano", "ano"]
    exact = KeywordRange("ano_valido", ("ANO",), 1900, 2100, "fora", whole_words=True)
    assert [c for _, c, _, _ in found(df, exact)] == ["ano"]


@pytest.mark.parametrize(
    "rule, column, good, bad, severity",
    [
        (rulesets.TEMPERATURE, "TEMPERATURA", [-15, 50, None], [-15.1, 50.1], "WARNING"),
        (rulesets.HUMIDITY, "umidade", [0, 100], [-1, 101], "ERROR"),
        (rulesets.AREA, "Hectares", [0, 9e9], [-0.5], "ERROR"),
        (rulesets.PRODUCTION, "safra_2020", [0], [-1], "ERROR"),
        (rulesets.YEAR, "year", [1900, 2100], [1899, 2101], "ERROR"),
        (rulesets.QUANTITY, "PESO_KG", [0], [-3], "ERROR"),
        (rulesets.PH, "ph", [0, 14], [-0.1, 14.1], "ERROR"),
        (rulesets.DEPTH, "depth", [0, 500], [-1, 501], "WARNING"),
        (rulesets.PERCENTAGE, "silte", [0, 100], [-1, 100.5], "ERROR"),
    ],
)
def test_domain_rules(spark, rule, column, good, bad, severity):
    df = numbers(spark, column, [None if v is None else float(v) for v in good + bad], "double")
    assert found(df, rule) == [(rule.name, column, severity, len(bad))]


@dataclass(frozen=True)
class Broken(Rule):
    name = "quebrada"

    def checks(self, df):
        raise KeyError("sem coluna")


@dataclass(frozen=True)
class Odd(Rule):
    name = "impar"

    def checks(self, df):
        return [Check(self.name, "a", lambda n: F.lit("ímpar"), F.count_if(F.col("a") % 2 == 1), severity=WARNING)]


def test_a_broken_rule_is_an_error_and_the_others_still_run(spark):
    df = numbers(spark, "a", [1, 2, 3])
    result = validate(df, [Broken(), Odd(), NotEmpty()], fail_on_error=False)
    assert [e["rule"] for e in result.errors] == ["quebrada"]
    assert [w["rows_affected"] for w in result.warnings] == [2]
    assert not result.is_valid and result.summary() == "❌ INVÁLIDO | Linhas: 3 | Erros: 1 | Avisos: 1"


def test_warnings_never_invalidate_and_errors_raise(spark, tmp_path):
    df = spark.createDataFrame([("2024/01/01", "0000 UTC", 80.0)], "`Data` string, `Hora UTC` string, `TEMP` double")
    result = validate(df, rulesets.CLIMATE)
    assert result.is_valid and result.warning_count == 1 and result.error_count == 0
    assert result.to_dict()["stats"]["null_counts"] == {"Data": 0, "Hora UTC": 0, "TEMP": 0}
    df.drop("Data").write.parquet(str(tmp_path / "f"))
    with pytest.raises(ValidationFailed) as failure:
        validate_file(spark, str(tmp_path / "f"), rulesets.CLIMATE)
    assert failure.value.result.errors[0]["rule"] == "required_columns"


def test_no_rules_no_lines(spark):
    assert report(numbers(spark, "a", [1]), []).count() == 0


def test_all_rules_share_one_scan(spark, tmp_path):
    spark.range(10).selectExpr("id as AREA", "id as SAFRA", "id as ANO", "id as PESO").write.parquet(str(tmp_path / "t"))
    df = report(spark.read.parquet(str(tmp_path / "t")), rulesets.AGRICULTURE)
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_profile(spark):
    df = spark.createDataFrame([(1, None), (2, math.nan)], "a int, b double")
    assert {tuple(r) for r in profile(df).collect()} == {("a", 2, 2, 0), ("b", 2, 2, 2)}


def test_file_gate(spark):
    df = spark.createDataFrame(
        [("good", "2024/01/01", "0", 50.0), ("bad", None, "0", 500.0), ("bad", "2024/01/01", "1", 5.0), ("warm", "2024/01/01", "0", 1.0)],
        "arquivo string, `Data` string, `Hora UTC` string, UMID double",
    )
    errors = {r.arquivo: (r.rule, r.erros) for r in file_errors(df, rulesets.CLIMATE, "arquivo").collect()}
    assert errors == {"bad": ("not_null", 2)}
    summary = stored_summary(df, rulesets.CLIMATE, "arquivo")
    clean, rejected = split_by_file(df, summary, "arquivo")
    assert {r.arquivo for r in clean.collect()} == {"good", "warm"} and rejected.count() == 2
    listing = spark.createDataFrame([("good", 7), ("bad", 8), ("warm", 9), ("empty", 0)], "arquivo string, bytes bigint")
    status = {r.arquivo: (r.linhas, r.sucesso, r.erro) for r in file_status(listing, summary, "arquivo").collect()}
    assert status["good"] == (1, True, None) and status["empty"] == (0, False, "DataFrame está vazio")
    assert status["bad"] == (2, False, "Coluna 'Data' contém 1 valores nulos")


def test_file_summary_with_duplicates(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", -1), ("b", 1), ("c", -1)], "arquivo string, AREA int")
    rules = (NoDuplicates(("AREA",)), rulesets.AREA)
    got = {r.arquivo: (r.linhas, r.erros, r.rule) for r in file_summary(df, rules, "arquivo").collect()}
    assert got == {"a": (3, 2, "no_duplicates"), "b": (1, 0, None), "c": (1, 1, "area_valida")}
    only = {r.arquivo: (r.linhas, r.erros) for r in file_summary(df, rules[:1], "arquivo").collect()}
    assert only == {"a": (3, 1), "b": (1, 0), "c": (1, 0)}


def test_file_summary_reads_once(spark, tmp_path):
    df = spark.createDataFrame([("a", 1)], "arquivo string, AREA int")
    df.write.parquet(str(tmp_path / "t"))
    text = file_summary(spark.read.parquet(str(tmp_path / "t")), rulesets.AGRICULTURE, "arquivo")
    assert text._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_dates_may_begin_with_month_or_day(spark):
    cells = ["2024/12/31", "12/31/2024", "31/12/2024 10:30", "2024-02-30", "13/13/2024", "ontem", None]
    df = spark.createDataFrame([(c,) for c in cells], "d string")
    lines = report(df, [DataType("d", "datetime")]).collect()
    assert [(r.rows_affected, sorted(r.sample_values)) for r in lines] == [(3, ["13/13/2024", "2024-02-30", "ontem"])]


class _Raising(rules.Rule):
    def __init__(self, name, told):
        self.name, self.told = name, told

    def checks(self, df):
        bad = F.when(F.col("v") > 1, F.raise_error(F.lit(self.told)).cast("int"))
        return [rules.Check(self.name, "v", lambda n: F.lit("-"), affected=F.count(bad))]


def test_a_rule_that_fails_in_the_data_stops_no_other(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "v int, w string")
    chosen = [rules.NotNull(("w",)), _Raising("um", "primeiro erro"), rules.NumericRange("v", 0, 1), _Raising("dois", "segundo"), rules.NotEmpty()]
    result = runner.validate(df, chosen, fail_on_error=False)
    lines = [(x["rule"], x["column"], x["rows_affected"], x["severity"]) for x in result.errors]
    assert lines == [("not_null", "w", 1, "ERROR"), ("um", None, 0, "ERROR"), ("numeric_range", "v", 1, "ERROR"), ("dois", None, 0, "ERROR")]
    assert "primeiro erro" in result.errors[1]["message"] and result.errors[1]["message"].startswith("Erro ao executar regra")
    assert runner.validate(df.where("v < 2"), chosen, fail_on_error=False).error_count == 1
