"""Registered queries on the smallest tables: against SQL, or held-out accuracy."""

import random
import zlib

import numpy as np
import pytest
from compare import differences, sql_engine
from pyspark.sql import functions as F

from agrometry.llm import html_extract, labelled_pages, language_id, quality, queries, topk_search


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_matches_sql(spark, folder, name):
    assert differences(queries.queries()[name](spark, folder), sql_engine(folder), queries.oracle_sql()[name]) == []


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.queries()) == list(range(1, 14))


def test_language_of_held_out_documents(spark, folder):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = language_id.digest(language_id.identify(docs, language_id.learn(docs))).join(docs, "doc_id")
    right = found.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert right >= 0.98
    assert found.where("score < 0 or score > 1").isEmpty()


def test_texts_without_letters_have_no_language(spark, folder):
    fitted = language_id.learn(spark.read.parquet(f"{folder}/documents.parquet"))
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "12 !?"), (4, "中文"), (5, "the and that")], "doc_id bigint, text string")
    got = {r["doc_id"]: r["lang_pred"] for r in language_id.identify(docs, fitted).collect()}
    assert [got[k] for k in (1, 2, 3)] == ["und"] * 3 and got[4] != "und" and got[5] == "en"


def test_quality_of_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    scored = quality.digest(quality.score(queries.table(spark, folder, "documents"), quality.train(queries.table(spark, folder, "documents"), queries.table(spark, folder, "labels"))))
    held = scored.where("held_out").join(queries.table(spark, folder, "labels"), "doc_id").toPandas()
    assert (held.predicted == held.quality).mean() >= 0.97
    assert scored.where("score is null or score < 0 or score > 1").isEmpty()


def test_quality_without_both_labels_accepts(spark, docs):
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 0)], "doc_id bigint, quality int")
    assert {r["score"] for r in quality.score(docs, quality.train(docs, labels)).collect()} == {0.5}


def _exact(vectors, ids, k):
    numbers = np.floor(256 * vectors.astype(float)).astype(np.int64)
    out = []
    for i in np.flatnonzero(ids % 50 == 0):
        score = numbers @ numbers[i]
        best = [j for j in np.lexsort((ids, -score)) if ids[j] != ids[i]][:k]
        out += [(ids[i], r + 1, ids[j], score[j]) for r, j in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("block", [4096, 40])
def test_best_five_are_exact(spark, block, monkeypatch):
    monkeypatch.setattr(topk_search, "CANDIDATES", block)
    draw = np.random.default_rng(2)
    vectors = draw.normal(size=(400, 6)).astype(np.float32)
    vectors[100:220] = vectors[100]
    vectors[300:] = np.round(vectors[300:])
    table = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(vectors)], "vec_id bigint, embedding array<float>")
    got = topk_search.search(table.repartition(3), F.col("vec_id") % 50 == 0).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got) == _exact(vectors, np.arange(400), 5)


def test_unusable_and_huge_vectors(spark):
    rows = [(0, [1.0, 2.0]), (1, [1.0, None]), (2, None), (3, [float("nan"), 1.0]), (None, [1.0, 1.0]), (50, [1e30, -1e30]), (51, [1.0]), (52, [2.0, 2.0]), (52, [2.0, 2.0]), (53, [])]
    got = topk_search.search(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), F.col("vec_id") % 50 == 0).collect()
    assert {(r["query_id"], r["vec_id"]) for r in got} == {(0, 50), (0, 52), (50, 0), (50, 52)}


def test_main_text_of_held_out_layouts():
    fitted = html_extract.train()
    right = blocks = 0
    for seed in range(5000, 5080):
        rows, labels = html_extract.labelled(labelled_pages._Writer(seed).page())
        right += sum(a == b for a, b in zip(fitted.decode(rows), labels))
        blocks += len(labels)
    assert right / blocks >= 0.98
    page = "<nav><a href=/>Home</a></nav><article><h1>Big &amp; small</h1><p><b>One\n  two<br><p>Three</article><footer>&copy; x</footer>"
    assert html_extract.main_text(page, fitted) == "Big & small\nOne two\nThree"


def test_viterbi_finds_the_best_labels():
    fitted = html_extract.Field({"a": 1.0, "b": -0.7}, [[0.3, -0.4], [-0.2, 0.5]])
    rows = [["a"], ["b"], ["b"], ["a"], ["b"]]

    def score(labels):
        total = sum(fitted.scores([r])[0] * y for r, y in zip(rows, labels))
        return total + sum(fitted.step[i][j] for i, j in zip(labels, labels[1:]))

    every = [[(n >> k) & 1 for k in range(5)] for n in range(32)]
    assert score(fitted.decode(rows)) == max(map(score, every))


def test_close_languages_single_documents_and_many_languages(spark):
    draw = random.Random(8)
    word = lambda: "".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=9))
    own = {f"l{k:02}": " ".join(word() for _ in range(30)) for k in range(70)}
    texts = [(text, name) for name, text in own.items() for _ in range(4)]
    texts += [(f"shared ordinary vocabulary {name}", name) for name in ("xa", "xb", "xc") for _ in range(4)]
    texts += [("completely different things", "aa")] * 40 + [("quaint solitary paragraph", "zz")]
    learned = [k for k in range(1000) if zlib.crc32(str(k).encode()) % 4 != 2]
    rows = [(k, *row) for k, row in zip(learned, texts)]
    fitted = language_id.learn(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    asked = [*own.values(), "shared ordinary vocabulary", "solitary"]
    table = spark.createDataFrame(list(enumerate(asked)), "doc_id bigint, text string")
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language_id.identify(table, fitted).collect()}
    assert [got[k][0] for k in range(72)] == [*own, "xa", "zz"]
    assert 0.3 < got[70][1] < 0.4


def test_an_id_of_several_vectors_counts_once(spark):
    draw = np.random.default_rng(4)
    numbers, ids = draw.integers(-4, 5, size=(300, 4)), draw.integers(1, 40, size=300)
    numbers[0], ids[0] = [3, -2, 1, 4], 50
    numbers[1:28], ids[1:28] = numbers[0] * np.arange(2, 29)[:, None], np.tile([7, 50, 8], 9)
    table = spark.createDataFrame([(int(i), v.astype(float).tolist()) for i, v in zip(ids, numbers)], "vec_id bigint, embedding array<double>")
    score = (256 * numbers[ids == 50]) @ (256 * numbers.T)
    best = {int(i): int(score[:, ids == i].max()) for i in set(ids.tolist()) - {50}}
    want = [(r + 1, i, best[i]) for r, i in enumerate(sorted(best, key=lambda i: (-best[i], i))[:5])]
    got = topk_search.search(table, F.col("vec_id") == 50).orderBy("rank").collect()
    assert [(r["rank"], r["vec_id"], r["score"]) for r in got] == want


def test_only_the_raw_elements_themselves_are_no_text():
    text = lambda page: [block.text for block in html_extract.blocks(page)]
    for tag in ("<svg-icon name=x></svg-icon>", "<title-bar>", "<template-x/>", "<svg width='1'/>", "<svg>", "<object-view></object-view>"):
        assert text(f"<article>{tag}<h1>T</h1><p>Body</p></article><p>End</p>") == ["T", "Body", "End"]
    assert text("<p>a<svg><text>no</text><svg><title/>no</svg>no</svg>b</p><script>no</script x><p>c") == ["a b", "c"]
    assert text("<p>If <math><mi>x</mi><mo>=</mo><mn>1</mn></math> then</p><object data=a><p>instead</p></object>") == ["If x=1 then", "instead"]
