"""The stages of the pipeline, each against a plain version on its own input."""

import brute
import pytest

import corpus_pipeline
from agrometry.llm import packing, quality, queries, substring_dedup
from agrometry.llm.staging import staged


@pytest.fixture(scope="module")
def stages(spark, folder):
    docs = queries.table(spark, folder, "documents")
    found = [("documents", docs)]
    for name, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, folder), name)
        found.append((name, docs))
    return dict(found)


def _rows(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_quality_rejects_what_scores_under_half(spark, folder, stages):
    docs = stages["documents"]
    scored = quality.score(docs, quality.train(docs, queries.table(spark, folder, "labels")))
    assert set(_rows(stages["quality"])) == {r["doc_id"] for r in scored.where("score >= 0.5").collect()}


def test_one_document_of_each_group_stays(stages):
    want = brute.components([(r["doc_id"], r["text"]) for r in stages["quality"].collect()], 5, 80)
    assert set(_rows(stages["near_duplicates"])) == {c for _, c in want.values()}


def test_later_passages_are_cut(stages):
    before = _rows(stages["near_duplicates"])
    want = brute.repeats([(d, r["text"]) for d, r in before.items()], corpus_pipeline.PASSAGE_WORDS)
    left = {d: [w for i, w in enumerate(words) if i not in gone] for d, (words, gone) in want.items()}
    got = _rows(stages["repeats"])
    assert set(got) == {d for d in left if left[d] or not want[d][1]}
    for d, r in got.items():
        assert brute.BLANK.findall(r["text"].encode()) == left[d]
        assert r["n_chars"] == len(r["text"])
        if not want[d][1]:
            assert r["text"] == before[d]["text"]


def test_contaminated_documents_go(spark, folder, stages):
    items = [(r["item_id"], r["text"]) for r in queries.table(spark, folder, "benchmark").collect()]
    found = brute.hits([(r["doc_id"], r["text"]) for r in stages["repeats"].collect()], items)
    assert set(_rows(stages["benchmark"])) == {d for d, (n, hit, _) in found.items() if not hit or 20 * len(hit) < n}


def test_windows_hold_all_that_is_left(stages):
    pieces = stages["packing"].toPandas()
    assert set(pieces.doc_id) == set(_rows(stages["benchmark"]))
    assert pieces.groupby("sequence_id").length.sum().max() <= packing.LENGTH
    assert (pieces.groupby("doc_id").length.sum() == pieces.groupby("doc_id").doc_tokens.first()).all()


def test_one_row_of_each_group_stays_whatever_the_ids(spark, folder):
    near = " ".join(f"w{i}" for i in range(60))
    rows = [
        (1, "alpha beta gamma delta epsilon zeta"), (2, "alpha beta gamma delta epsilon zeta"), (2, "a text that nobody else has at all"),
        (5, "quick brown foxes jump over lazy dogs"), (5, "quick brown foxes jump over lazy dogs"), (None, "no id but a text of some words"), (None, "no id but a text of some words"),
        (None, "quick brown foxes jump over lazy dogs"), (9, near), (8, near + " more"), (None, near + " other"), (7, "one"), (7, "two"), (7, ""), (7, None), (None, None),
    ]
    docs = spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], "doc_id bigint, text string, _row_ int").repartition(3)
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, folder)
    assert kept.columns == docs.columns
    groups = brute.components([(k, t) for k, (_, t) in enumerate(rows)], 5, 80)
    members = {}
    for k, (_, root) in groups.items():
        members.setdefault(root, []).append(rows[k])
    want = [min(held, key=lambda r: (r[0] is None, r[0] or 0)) for held in members.values()]
    got = [(r["doc_id"], r["text"]) for r in kept.collect()]
    assert sorted((d for d, _ in got), key=str) == sorted((d for d, _ in want), key=str)
    assert {t for _, t in got} >= {rows[2][1], "one", "two", rows[5][1]} and len(got) == len(want)


@pytest.mark.parametrize("shared", [1, None])
def test_stages_keep_unique_texts_of_shared_ids(spark, folder, shared):
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(shared, passage + " a"), (shared, "x y z " + passage), (shared, "unlike all others in every word")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    left = corpus_pipeline.cut_repeats(spark, corpus_pipeline.drop_near_duplicates(spark, docs, folder), folder)
    assert sum(passage in r["text"] for r in left.collect()) == 1
    assert any(r["text"] == rows[2][1] for r in left.collect())


def test_a_task_keeps_one_python_worker(spark):
    """Texts that pass the filter are shuffled before Python reads them again, however short the list."""
    docs = spark.createDataFrame([(1, 2, "some text")], "doc bigint, row bigint, text string")
    unclear = spark.createDataFrame([(1, 2, 3, 0, 1)], "doc bigint, row bigint, anchor bigint, start bigint, windows bigint")
    read = substring_dedup._listed_texts(docs, unclear).mapInArrow(substring_dedup._reader(1), "key bigint, doc bigint, row bigint, start bigint, words binary")
    cut = substring_dedup.repeats(spark.createDataFrame([(1, "a b c " * 20)], "doc_id bigint, text string"))
    for df in (read, cut):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
