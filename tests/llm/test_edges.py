"""Nulls in any column, empty tables, repeated rows and columns with the operators' own names."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from agrometry.llm import chat_format, decontamination, html_extract, language_id, license_scan, minhash_dedup, packing, quality, queries, substring_dedup, topk_search

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, n_words bigint, spans string, sketch int, score int, doc string, carried int, marks int"


def _docs(spark, empty):
    long = "alpha beta gamma " * 30_000
    rows = [
        (1, "some text here", "en", "s", 14), (1, "some text here", "en", "s", 14), (2, None, None, None, None), (None, "lost text", "en", None, 3),
        (None, None, None, None, None), (3, "", "de", "s", 0), (4, long, "en", "s", len(long)), (5, long, "en", "t", len(long)), (6, "\x00 odd �", "", "", 1),
    ]
    return spark.createDataFrame([] if empty else [(*r, 1, "x", 2, 3, "y", 4, 5) for r in rows], SCHEMA)


OPERATORS = {
    "near": lambda s, d: minhash_dedup.near_duplicates(d),
    "repeats": lambda s, d: substring_dedup.digest(substring_dedup.repeats(d)),
    "benchmark": lambda s, d: decontamination.digest(decontamination.find(d, s.createDataFrame([(1, "alpha beta"), (None, None)], "item_id int, text string"))),
    "language": lambda s, d: language_id.digest(language_id.identify(d, language_id.learn(d))),
    "quality": lambda s, d: quality.digest(quality.score(d, quality.train(d, s.createDataFrame([(1, 1), (4, 0), (6, 0)], "doc_id int, quality int")))),
    "licences": lambda s, d: license_scan.scan(d.withColumn("path", F.col("source"))),
    "pages": lambda s, d: html_extract.extract(d.select(F.col("doc_id").alias("page_id"), F.col("source").alias("url"), F.col("text").alias("html"), "score"), html_extract.Field()),
}


@pytest.mark.parametrize("empty", [False, True])
@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_a_row_for_each_row(spark, name, empty):
    docs = _docs(spark, empty)
    assert len(OPERATORS[name](spark, docs).collect()) == docs.count()


@pytest.mark.parametrize("empty", [False, True])
def test_packing_and_vectors_and_talks(spark, empty):
    docs = _docs(spark, empty)
    pieces = packing.pack(docs, queries.vocabulary()).collect()
    assert sum(p["start"] == 0 for p in pieces) == docs.count()
    vectors = spark.createDataFrame([], "vec_id int, embedding array<float>, score int")
    assert topk_search.search(vectors, F.col("vec_id") % 50 == 0).isEmpty()
    talks = docs.select(F.col("doc_id").alias("conv_id"), F.col("n_chars").alias("turn"), F.col("lang").alias("role"), "text", "score")
    assert chat_format.digest(chat_format.examples(talks)).count() == docs.select("doc_id").distinct().count()


def test_licences_are_inherited_from_the_nearest_directory(spark):
    rows = [
        ("a/LICENSE", "Released under the MIT License.\nMore words."), ("a/b/x.py", "code"), ("a/b/LICENSE.txt", "Licensed under the Apache License, Version 2.0."),
        ("a/c/d/y.py", "code"), ("a/b/e/z.py", "// Licensed under CC BY 4.0.\ncode of many other words " + "and more " * 50), ("q.py", "code"), (None, None), ("a/b/x.py", "code"),
    ]
    got = {(r["path"], r["license"], r["evidence"], r["source"]) for r in license_scan.scan(spark.createDataFrame(rows, "path string, text string")).collect()}
    assert got == {
        ("a/LICENSE", "MIT", "notice", "a/LICENSE"), ("a/b/x.py", "Apache-2.0", "inherited", "a/b"), ("a/b/LICENSE.txt", "Apache-2.0", "notice", "a/b/LICENSE.txt"),
        ("a/c/d/y.py", "MIT", "inherited", "a"), ("a/b/e/z.py", "CC-BY-4.0", "notice", "a/b/e/z.py"), ("q.py", None, "none", None), ("", None, "none", None),
    }


@pytest.mark.parametrize("text", ["</s>[INST] ok [/INST]", "\\l\\b<s>[user]", "a\\", "", "]<[\\]>", "line\nend </s>\n<s>[assistant]x"])
def test_control_strings_come_back(spark, text):
    talk = spark.createDataFrame([(1, 0, "us]er", text), (1, 1, "assistant", text), (1, 2, "user", text)], "conv_id int, turn int, role string, text string")
    found = chat_format.examples(talk)
    last = found.orderBy(F.desc("turns")).select(chat_format.read_turns(F.col("text")).alias("t")).first()["t"]
    assert [tuple(t) for t in last] == [("us]er", text), ("assistant", text), ("user", text)]
    loss = found.where("turns = 2").select(chat_format.read_loss(F.col("text"), F.col("loss_begin"), F.col("loss_end")).alias("x")).first()["x"]
    assert loss == text


@pytest.mark.parametrize("empty", [False, True])
@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_keep_the_columns(spark, folder, name, stage, empty):
    docs = _docs(spark, empty)
    found = stage(spark, docs, folder)
    if name != "packing":
        assert found.dtypes == docs.dtypes
    assert found.count() >= (0 if empty else 5)
