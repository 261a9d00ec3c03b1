"""The corpus pipeline: quality, near duplicates, repeated passages, benchmark passages, packing.

Every stage takes ``(spark, docs, sf_dir)`` and returns a table; all but the last return the columns of documents, whatever
they are beside doc_id and text.  Null texts are empty texts: they have a quality score, no duplicates and no passages,
and pack as a lone end token if they are accepted.  Rows that share a doc_id, or have none, are documents like any
others; of repeated rows one stays.  Empty tables give empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agrometry.llm import decontamination, membership, minhash_dedup, packing, quality, queries, spans, substring_dedup
from agrometry.llm.staging import staged

#: Repeated passages of at least so many words are cut (in documents, not in the query of its own).
PASSAGE_WORDS = 40

#: Training windows have no row-wise SQL; tests hold every stage against a brute-force version.
ORACLE_SQL = None


#: Column of row numbers inside a stage.
ROW = "_row"


def _others(docs: DataFrame) -> list[str]:
    return [c for c in docs.columns if c not in ("doc_id", "text")]


def _without_spans(found: DataFrame, docs: DataFrame) -> DataFrame:
    """The documents' columns with the spans cut out of the text, and its length where there is a column for it."""
    rows = spans.unpacked(found.withColumn("text", spans.cut("text", "spans")), _others(docs))
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return rows.select(docs.columns)


def accept_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality ranking accepts."""
    ranking = quality.train(docs, queries.table(spark, sf_dir, "labels"))
    return quality.accepted(docs, ranking)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: the one with the smallest doc_id (a null one last).

    Rows are told apart by a number of their own, written with them: rows that share a doc_id, or have none, are compared
    like any others, so of repeated rows one stays and no other text goes with them.  Rows without words all stay.
    """
    rows = staged(docs.withColumn(ROW, F.monotonically_increasing_id()), "rows")
    found = minhash_dedup.near_duplicates(rows.select(F.col(ROW).alias("doc_id"), "text"))
    later = found.where("not kept").select(F.col("doc_id").alias(ROW), F.col("component_id").alias("component"))
    later = staged(later, "later")
    members = staged(later.union(later.select(F.col("component").alias(ROW), "component").distinct()), "members")
    named = membership.may_hold(rows.select(ROW, F.col("doc_id").alias("id")), ROW, members.select(ROW)).join(members, ROW)
    first = named.groupBy("component").agg(F.min(F.struct(F.col("id").isNull(), "id", ROW)).alias("first"))
    gone = members.join(first, "component").where(F.col(ROW) != F.col(f"first.{ROW}")).select(ROW)
    gone = staged(gone, "gone")
    held, free = membership.split(rows, ROW, gone)
    return held.join(gone, ROW, "left_anti").select(docs.columns).union(free.select(docs.columns))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that occur earlier; those with nothing left go."""
    found = substring_dedup.repeats(docs, PASSAGE_WORDS, carry=_others(docs))
    return _without_spans(found.where("n_removed = 0 or n_removed < n_words"), docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated; the few benchmark words in others are cut."""
    found = decontamination.find(docs, queries.table(spark, sf_dir, "benchmark"), carry=_others(docs))
    return _without_spans(found.where(~decontamination.contaminated()), docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training windows: the pieces of all documents with their token ids."""
    return packing.pack(docs, queries.vocabulary())


STAGES = [
    ("quality", accept_quality),
    ("near_duplicates", drop_near_duplicates),
    ("repeats", cut_repeats),
    ("benchmark", remove_benchmark),
    ("packing", pack_windows),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over documents; each stage's rows are written and read again."""
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
