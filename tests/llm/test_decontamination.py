import brute
import pytest

from agrometry.llm import decontamination
from agrometry.llm.spans import cut


@pytest.fixture(scope="module")
def items(rows):
    base = rows[60][1].split()
    texts = [" ".join(base[10:40]), "two words", "one", None, "", " ".join(base[20:30]).upper(), "same " * 20, "-- !! --", rows[3][1]]
    return [(k + 1, t) for k, t in enumerate(texts)] + [(1, " ".join(base[10:40])), (None, "none")]


@pytest.mark.parametrize("block", [16_000_000, 1000])
@pytest.mark.parametrize("least", [1, 10])
def test_hits_are_those_of_every_window(spark, docs, rows, items, block, least):
    chosen = [(k, t) for k, t in items if least == 1 or k is None or len((t or "").split()) >= least]
    want = brute.hits(rows, [(k, t) for k, t in chosen if k is not None])
    table = spark.createDataFrame(chosen, "item_id bigint, text string")
    got = decontamination.digest(decontamination.find(docs, table, block)).collect()
    assert len(got) == len(rows)
    for r in got:
        n, hit, names = want[r["doc_id"]]
        assert (r["n_words"], r["n_hit"], r["n_items"]) == (n, len(hit), len(names))
        assert r["items_sha256"] == brute.sha(",".join(sorted(names)).encode())
        assert r["contaminated"] == (len(hit) > 0 and 20 * len(hit) >= n)


def test_spans_cut_the_hit_words(spark, docs, rows, items):
    table = spark.createDataFrame(items[:1], "item_id bigint, text string")
    found = decontamination.find(docs, table)
    want = brute.hits(rows, items[:1])
    for r in found.withColumn("left", cut("text", "spans")).collect():
        n, hit, _ = want[r["doc_id"]]
        assert len(brute.PLAIN.findall((r["left"] or "").encode().lower())) == n - len(hit)


def test_nothing_to_look_for(spark, docs):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert {r["n_hit"] for r in decontamination.find(docs, none).collect()} == {0}


@pytest.mark.parametrize("block", [16_000_000, 60])
def test_items_without_a_name_have_phrases(spark, block):
    items = [(None, "two words"), (None, "a lost item of the benchmark"), (4, "two words"), (4, "more of it")]
    docs = [(1, "two words"), (2, "see a lost item of the benchmark here"), (3, "some more of it"), (4, "nothing")]
    table = spark.createDataFrame(items, "item_id bigint, text string")
    found = decontamination.find(spark.createDataFrame(docs, "doc_id bigint, text string"), table, block).collect()
    assert {r["doc_id"]: (r["n_hit"], r["item_ids"]) for r in found} == {1: (2, ["4"]), 2: (6, []), 3: (3, ["4"]), 4: (0, [])}


def test_blocks_split_the_texts_of_one_item(spark):
    table = spark.createDataFrame([(1, f"text number {k}") for k in range(200)], "item_id bigint, text string")
    found = list(decontamination.blocks(table, 500))
    assert sorted(x for block in found for x in block) == sorted(("1", f"text number {k}") for k in range(200))
    assert max(sum(len(text) for _, text in block) for block in found) <= 1000
