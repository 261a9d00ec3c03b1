"""Rules and the checks they compile to.

A rule looks at the schema and returns checks; a check is an aggregate
expression.  All checks of all rules run in one scan (see ``runner``).
Subclass ``Rule`` to add one: set ``name`` and return checks from ``checks``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, FloatType, NumericType, StringType

from agrometry.functions import text

ERROR, WARNING = "ERROR", "WARNING"

# Message texts; {n} is the number of affected rows.
MESSAGES = {
    "not_empty": "DataFrame está vazio",
    "required_columns": "Colunas obrigatórias ausentes: {columns}",
    "not_null": "Coluna '{column}' contém {n} valores nulos",
    "numeric_range": "Coluna '{column}' tem {n} valores {side} de {limit}",
    "no_duplicates": "Encontradas {n} linhas duplicadas (baseado em: {basis})",
    "data_type": "Coluna '{column}' tem {n} {what}",
    "keyword_range": "Coluna '{column}' tem {n} valores {complaint}",
    "crash": "Erro ao executar regra: {crash}",
}


@dataclass(frozen=True)
class Parse:
    """A column to be read as a number or a timestamp, once per row for all checks."""

    column: str
    kind: str = "number"
    decimal_comma: bool = False

    @property
    def alias(self) -> str:
        return f"_{self.kind}{'_comma' if self.decimal_comma else ''}:{self.column}"

    def value(self) -> Column:
        return F.col(f"`{self.alias}`")

    def expression(self, df: DataFrame) -> Column:
        cell, kind = _col(self.column), df.schema[self.column].dataType
        if self.kind == "timestamp":
            if isinstance(kind, StringType):
                cell = F.replace(cell, F.lit("/"), F.lit("-"))
            cell = cell.cast("string")
            # year first; else month first, or day first where that cannot be a month
            dated = F.when(cell.rlike(r"^\s*\d{1,2}-\d{1,2}-\d{4}"), F.trim(cell))
            return F.coalesce(
                cell.try_cast("timestamp"),
                *[F.try_to_timestamp(dated, F.lit(f"{order}-yyyy[ H:mm[:ss]]")) for order in ("M-d", "d-M")],
            )
        if isinstance(kind, (NumericType, BooleanType)):
            return F.nanvl(cell.cast("double"), F.lit(None).cast("double"))
        return text.number(cell.cast("string"), self.decimal_comma)


@dataclass(frozen=True)
class Check:
    """One line of a report, if it fires.

    ``affected`` is an aggregate over rows; it may use the values of ``parses``.
    ``message`` gets the affected count as a column.  ``fires`` defaults to
    "some row is affected".  ``bad`` tells the rows to take samples from.
    ``duplicate_keys`` marks the one check kind that needs its own shuffle; it
    then stands for rows beyond the first of each key.
    """

    rule: str
    column: str | None
    message: Callable[[Column], Column]
    affected: Column | None = None
    fires: Column | None = None
    severity: str = ERROR
    parses: tuple[Parse, ...] = ()
    bad: Column | None = None
    duplicate_keys: tuple[str, ...] | None = None


class Rule:
    name: str

    def checks(self, df: DataFrame) -> list[Check]:
        raise NotImplementedError


def _col(name: str) -> Column:
    return F.col(f"`{name}`")


def _says(kind: str, **values) -> Callable[[Column], Column]:
    """Message of one kind, with the affected count filled in by Spark."""
    before, *after = MESSAGES[kind].format(n="\0", **values).split("\0")
    if not after:
        return lambda _n: F.lit(before)
    return lambda n: F.concat(F.lit(before), n.cast("string"), F.lit(after[0]))


def is_missing(df: DataFrame, name: str) -> Column:
    column = _col(name)
    if isinstance(df.schema[name].dataType, (FloatType, DoubleType)):
        return column.isNull() | F.isnan(column)
    return column.isNull()


@dataclass(frozen=True)
class NotEmpty(Rule):
    name = "not_empty"

    def checks(self, df):
        return [
            Check(
                self.name, None, _says("not_empty"),
                affected=F.lit(0).cast("bigint"), fires=F.count("*") == 0,
            )
        ]


@dataclass(frozen=True)
class RequiredColumns(Rule):
    columns: tuple[str, ...]
    name = "required_columns"

    def checks(self, df):
        missing = [c for c in self.columns if c not in df.columns]
        if not missing:
            return []
        message = _says("required_columns", columns=missing)
        return [Check(self.name, None, message, affected=F.count("*"), fires=F.count("*") >= 0)]


@dataclass(frozen=True)
class NotNull(Rule):
    columns: tuple[str, ...]
    severity: str = ERROR
    name = "not_null"

    def checks(self, df):
        return [
            Check(
                self.name, c, _says("not_null", column=c),
                affected=F.count_if(is_missing(df, c)), severity=self.severity,
            )
            for c in self.columns
            if c in df.columns
        ]


@dataclass(frozen=True)
class NumericRange(Rule):
    """Values under the minimum and over the maximum, reported apart."""

    column: str
    min_value: float | None = None
    max_value: float | None = None
    decimal_comma: bool = False
    name = "numeric_range"

    def checks(self, df):
        if self.column not in df.columns:
            return []
        parse = Parse(self.column, decimal_comma=self.decimal_comma)
        value = parse.value()
        sides = []
        if self.min_value is not None:
            sides.append((value < self.min_value, "abaixo", self.min_value))
        if self.max_value is not None:
            sides.append((value > self.max_value, "acima", self.max_value))
        return [
            Check(
                self.name, self.column,
                _says("numeric_range", column=self.column, side=side, limit=limit),
                affected=F.count_if(bad), parses=(parse,),
            )
            for bad, side, limit in sides
        ]


@dataclass(frozen=True)
class NoDuplicates(Rule):
    """Rows beyond the first of each key; all columns when no key is named."""

    columns: tuple[str, ...] | None = None
    name = "no_duplicates"

    def checks(self, df):
        basis = list(self.columns) if self.columns else "todas as colunas"
        message = _says("no_duplicates", basis=basis)
        return [Check(self.name, None, message, duplicate_keys=tuple(self.columns or df.columns))]


@dataclass(frozen=True)
class DataType(Rule):
    """Cells that do not read as ``numeric`` or ``datetime``; ``string`` always passes."""

    column: str
    expected_type: str
    name = "data_type"

    def checks(self, df):
        if self.column not in df.columns:
            return []
        # Expected type, how to read it, and the complaint.
        known = {
            "numeric": ("number", "valores não numéricos"),
            "datetime": ("timestamp", "valores de data inválidos"),
        }
        if self.expected_type not in known:
            return []
        kind, what = known[self.expected_type]
        parse = Parse(self.column, kind)
        bad = parse.value().isNull() & ~is_missing(df, self.column)
        return [
            Check(
                self.name, self.column, _says("data_type", column=self.column, what=what),
                affected=F.count_if(bad), parses=(parse,), bad=bad,
            )
        ]


@dataclass(frozen=True)
class KeywordRange(Rule):
    """Range check on every column whose name contains a keyword.

    Keywords match inside names ("ANO" also hits "PLANO"); ``whole_words``
    asks for a full word instead.
    """

    name: str
    keywords: tuple[str, ...]
    min_value: float | None
    max_value: float | None
    complaint: str
    severity: str = ERROR
    whole_words: bool = False
    decimal_comma: bool = False

    def matches(self, column: str) -> bool:
        upper = column.upper()
        if self.whole_words:
            words = "".join(ch if ch.isalnum() or ch == "_" else " " for ch in upper)
            return any(k in words.split() or k in words.replace("_", " ").split() for k in self.keywords)
        return any(k in upper for k in self.keywords)

    def checks(self, df):
        found = []
        for c in filter(self.matches, df.columns):
            parse = Parse(c, decimal_comma=self.decimal_comma)
            value = parse.value()
            bad = F.lit(False)
            if self.min_value is not None:
                bad = bad | (value < self.min_value)
            if self.max_value is not None:
                bad = bad | (value > self.max_value)
            message = _says("keyword_range", column=c, complaint=self.complaint)
            found.append(
                Check(
                    self.name, c, message, F.count_if(bad), severity=self.severity, parses=(parse,)
                )
            )
        return found
