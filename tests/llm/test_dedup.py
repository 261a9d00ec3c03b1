import random

import brute
import pytest
from pyspark.sql import functions as F

from agrometry.llm import minhash_dedup, substring_dedup
from agrometry.llm.graph import components


@pytest.mark.parametrize("size,percent", [(3, 85), (5, 80)])
def test_components_are_those_of_all_pairs(docs, rows, size, percent):
    want = brute.components(rows, size, percent)
    got = minhash_dedup.near_duplicates(docs, size, percent).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_short_sketches_and_forced_rounds_lose_no_link(docs, rows, monkeypatch):
    monkeypatch.setattr(minhash_dedup, "PAIRS_PER_ENTRY", 0)
    got = minhash_dedup.near_duplicates(docs, 3, 85, k=48, long=64).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == {d: c for d, (_, c) in brute.components(rows, 3, 85).items()}


def _template(count, own, words=400):
    draw = random.Random(5)
    rows = []
    for k in range(count):
        text = [f"t{i}" for i in range(words)]
        at = words - int(words * own)
        text[at:] = [f"o{k}x{i}" for i in range(words - at)]
        rows.append((k, " ".join(text)))
    for k in range(12):  # copies with a few changes, and with a third of the others' own words
        text = rows[7 * k][1].split()
        for _ in range(3):
            text[draw.randrange(len(text))] = f"z{draw.randrange(10**6)}"
        rows.append((count + k, " ".join(text)))
    return rows


@pytest.mark.parametrize("own", [0.06, 0.1, 0.14])
def test_documents_on_one_template_do_not_all_meet(spark, monkeypatch, own):
    monkeypatch.setattr(minhash_dedup, "PAIRS_PER_ENTRY", 0)
    met = []
    made = minhash_dedup._by_prefix

    def counted(*given):
        found = made(*given)
        met.append(found.count())
        return found

    monkeypatch.setattr(minhash_dedup, "_by_prefix", counted)
    rows = _template(150, own)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = {r["doc_id"]: r["component_id"] for r in minhash_dedup.near_duplicates(docs, 3, 85).collect()}
    assert got == {d: c for d, (_, c) in brute.components(rows, 3, 85).items()}
    assert all(n <= 5 * len(rows) for n in met)
    if own > 0.09:
        assert met


def test_chain_of_links_is_one_component(spark):
    links = spark.range(1, 60).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    got = {r["node"]: r["root"] for r in components(links, "a", "b").collect()}
    assert got == {k: 1 for k in range(2, 61)}


@pytest.mark.parametrize("window,hot,shard", [(20, 5000, 300_000), (20, 0, 500), (40, 5000, 300_000), (3, 5000, 2000)])
def test_removed_words_are_those_of_earlier_windows(docs, rows, window, hot, shard, monkeypatch):
    monkeypatch.setattr(substring_dedup, "HOT_SEGMENTS", hot)
    monkeypatch.setattr(substring_dedup, "SHARD_WORDS", shard)
    want = brute.repeats(rows, window)
    got = substring_dedup.digest(substring_dedup.repeats(docs, window)).collect()
    assert len(got) == len(rows)
    for r in got:
        words, gone = want[r["doc_id"]]
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        assert (r["n_words"], r["n_removed"], r["kept_sha256"]) == (len(words), len(gone), brute.sha(kept))


def test_no_shard_holds_a_passage_of_many_documents(spark, monkeypatch):
    shard = substring_dedup._shard

    def bounded(window):
        def run(table):
            words = sum(len(w.as_py()) // 8 for w in table.column("words"))
            if words > 3000:
                raise ValueError(f"{words} words in a shard")
            return shard(window)(table)

        return run

    monkeypatch.setattr(substring_dedup, "HOT_SEGMENTS", 50)
    monkeypatch.setattr(substring_dedup, "SHARD_WORDS", 1000)
    monkeypatch.setattr(substring_dedup, "_shard", bounded)
    footer = " ".join(f"f{i}" for i in range(25))
    rows = [(k, f"{' '.join(f'a{k}x{i}' for i in range(30))} {footer} {' '.join(f'b{k}x{i}' for i in range(30))}") for k in range(300)]
    rows += [(300, rows[7][1]), (301, f"{footer} {footer}"), (302, footer)]
    want = brute.repeats(rows, 20)
    got = substring_dedup.repeats(spark.createDataFrame(rows, "doc_id bigint, text string"), 20).collect()
    assert {r["doc_id"]: r["n_removed"] for r in got} == {d: len(gone) for d, (_, gone) in want.items()}


def test_rows_that_share_an_id_are_documents_of_their_own(spark):
    passage, other = (" ".join(f"{x}{i}" for i in range(30)) for x in "pq")
    rows = [
        (0, f"{passage} own words"), (1, f"other words first {passage}"), (1, "nothing that any text repeats"), (1, "x " * 200), (2, other), (2, f"{other} more"), (2, other),
        (None, f"early {passage}"), (None, f"{passage}"), (None, "alone"), (None, None), (3, ""), (3, passage),
    ]
    docs = spark.createDataFrame([(*r, 1, "r") for r in rows], "doc_id bigint, text string, row int, doc string").repartition(4)
    got = sorted(((r["doc_id"], r["n_words"], r["n_removed"]) for r in substring_dedup.repeats(docs).collect()), key=str)
    mark = {r: k for k, r in enumerate(sorted({(d if d is not None else -(1 << 63), t) for d, t in rows}, key=lambda r: (r[0], _mark(spark, r))))}
    want = brute.repeats([(k, t) for (d, t), k in mark.items()], 20)
    found = [want[mark[(d if d is not None else -(1 << 63), t)]] for d, t in rows]
    assert got == sorted(((d, len(w), len(gone)) for (d, _), (w, gone) in zip(rows, found)), key=str)
    assert sum(n for _, _, n in got) > 100


def _mark(spark, row):
    return spark.createDataFrame([row], "d bigint, t string").select(F.xxhash64("d", "t")).first()[0]
