"""The operators over the given tables, one query each, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agrometry.llm import chat_format, decontamination, html_extract, language_id, license_scan, minhash_dedup, packing
from agrometry.llm import periodic_runs, prefix_trie, quality, quality_rules, substring_dedup, topk_search
from agrometry.llm.staging import small_batches


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return minhash_dedup.near_duplicates(table(spark, folder, "documents"), size=3, percent=85)


def op2_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return language_id.digest(language_id.identify(docs, language_id.learn(docs)))


def vocabulary() -> str:
    """The vocabulary of the packing contract, where the machine keeps it."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op3_pack(spark: SparkSession, folder: str) -> DataFrame:
    return packing.digest(packing.pack(table(spark, folder, "documents"), vocabulary()))


def op4_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_extract.digest(html_extract.extract(table(spark, folder, "pages"), html_extract.train()))


def op5_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return topk_search.search(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op6_licenses(spark: SparkSession, folder: str) -> DataFrame:
    files = table(spark, folder, "documents").select(license_scan.document_path().alias("path"), "text")
    number = F.regexp_extract("path", "([0-9]*)\\.txt$", 1).cast("bigint")
    return license_scan.scan(files).withColumn("doc_id", number)


def op7_repeats(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.digest(substring_dedup.repeats(table(spark, folder, "documents")))


def op8_chat(spark: SparkSession, folder: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id bigint, turn bigint, role string, text string")
    talks = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").union(added)
    return chat_format.digest(chat_format.examples(talks))


def op9_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return quality.digest(quality.score(docs, quality.train(docs, table(spark, folder, "labels"))))


def op10_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    found = decontamination.find(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return decontamination.digest(found)


def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.trie(prefix_trie.paths(prefix_trie.regrown(table(spark, folder, "conversations"))))


def op12_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.digest(quality_rules.judged(table(spark, folder, "documents")))


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").withColumn("text", periodic_runs.made_periodic())
    return periodic_runs.digest(periodic_runs.runs(docs))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: call for name, call in globals().items() if name.startswith("op") and callable(call)}


def oracle_sql() -> dict[str, str]:
    return {
        "op6_licenses": license_scan.sql(),
        "op8_chat": chat_format.SQL,
        "op11_prefix_trie": prefix_trie.sql(),
        "op12_quality_rules": quality_rules.sql(),
        "op13_periodic_runs": periodic_runs.sql(),
    }
