"""Cut spans of characters out of texts, with built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_BLANK = " \t\n\v\f\r"


def carried(columns: list[str] | None) -> Column:
    """Columns that an operator takes along as one, so that their names never clash with its own."""
    kept = [F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(columns or [])]
    return F.struct(*(kept or [F.lit(None).cast("int").alias("c0")])).alias("carried")


def unpacked(rows: DataFrame, columns: list[str]) -> DataFrame:
    """``doc_id`` and ``text`` with the carried columns under their old names."""
    kept = [F.col(f"carried.c{k}").alias(c) for k, c in enumerate(columns)]
    return rows.select("doc_id", "text", *kept)


def _pieces(text: Column, spans: str) -> Column:
    """What lies before, between and after the spans."""
    count = F.size(spans)

    def piece(k: Column) -> Column:
        begin = F.when(k > 0, F.get(spans, k - 1)["end"]).otherwise(F.lit(0))
        end = F.when(k < count, F.get(spans, k)["begin"]).otherwise(F.length(text))
        return F.substr(text, (begin + 1).cast("int"), (end - begin).cast("int"))

    return F.transform(F.sequence(F.lit(0), count), piece)


def cut(text: str, spans: str) -> Column:
    """A text without its spans (places of characters, end excluded); what stays is joined by one space.

    A null text stays null, and a text without spans stays as it is.
    """
    trimmed = F.transform(_pieces(F.col(text), spans), lambda p: F.btrim(p, F.lit(_BLANK)))
    return F.when(F.size(spans) > 0, F.array_join(F.filter(trimmed, lambda p: p != ""), " ")).otherwise(F.col(text))


def kept_words(text: str, spans: str) -> Column:
    """The words (between ASCII white space) outside the spans, joined by one space."""
    whole = F.coalesce(F.col(text), F.lit(""))
    left = F.when(F.size(spans) > 0, F.array_join(_pieces(whole, spans), " ")).otherwise(whole)
    return F.trim(F.regexp_replace(left, "[\\x09-\\x0D ]+", " "))
