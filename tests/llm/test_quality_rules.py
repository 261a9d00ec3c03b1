"""Counts of the quality rules against plain code, and thresholds that follow language and source."""

from collections import Counter

import pytest
from brute import BLANK
from pyspark.sql import functions as F

from agrometry.llm import quality_rules

SCHEMA = "doc_id bigint, text string, lang string, source string, n_words string, key int, cells int, bounds int"


def counts(text):
    text = text or ""
    words = BLANK.findall(text.encode())
    runs = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = Counter(runs)
    covered = {i + k for i, r in enumerate(runs) if often[r] > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if BLANK.search(x.encode())]
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return (len(words), sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed)


def _judged(spark, rows, **options):
    docs = spark.createDataFrame([(*r, "x", 1, 2, 3) for r in rows], SCHEMA)
    return [tuple(r) for r in quality_rules.digest(quality_rules.judged(docs, **options)).collect()]


def test_counts_of_awkward_texts(spark, rows):
    texts = [(k, t, None, None) for k, t in rows] + [
        (None, "a b c d e f g h " * 3, "en", "s"), (None, None, None, None), (900, "#*$ \r\n%&|<> é\n#*$ \r\n \n\t\n", "en", "s"), (900, "\x0b\x0c x\x0by", "", ""),
    ]
    got = Counter(r[:-1] for r in _judged(spark, texts))
    assert got == Counter((k, *counts(t)) for k, t, *_ in texts)
    assert _judged(spark, []) == []


SIGNS = " ".join(f"##{k}" for k in range(20)) + " "


def _documents(n=400):
    plain = lambda k: " ".join(f"word{(k * 31 + i * 7) % 997}" for i in range(60))
    rows = [(k, plain(k), "en", "big") for k in range(n)]
    rows += [(1000 + k, SIGNS + plain(k), "en", "code") for k in range(n)]
    rows += [(2000, SIGNS + plain(5), "en", "big"), (2001, SIGNS + plain(6), "en", "rare"), (2002, plain(7), "en", "rare"), (2003, plain(8), None, None)]
    rows += [(2004, " ".join(["tiny"] * 9 + ["x"] * 40 + [f"y{k}" for k in range(30)]), "de", "few"), (2005, " ".join("q" * 40 + str(k) for k in range(40)), "en", "code")]
    return rows


@pytest.mark.parametrize("heavy", [10_000, 2])
def test_symbols_are_judged_by_their_source(spark, heavy):
    kept = {r[0]: r[-1] for r in _judged(spark, _documents(), heavy=heavy)}
    assert all(kept[k] for k in [*range(400), *range(1000, 1400), 2002, 2003])
    assert not kept[2000] and not kept[2005] and not kept[2004]


def test_small_sources_take_their_languages_bounds(spark):
    rows = [r for r in _documents() if r[3] != "code"]
    assert {r[0]: r[-1] for r in _judged(spark, rows)}[2001] is False


def test_sketches_merge_and_err_by_a_64th(spark):
    values = [3, 70, 127, 128, 129, 255, 1000, 123_456, 999_999_999]
    cut = spark.createDataFrame([(v,) for v in values], "v bigint").select("v", F.expr(quality_rules._cell("v")).alias("c"))
    assert all(r["c"] <= r["v"] and (r["v"] - r["c"]) * 64 < max(r["v"], 64) for r in cut.collect())
    cells = spark.range(1000).selectExpr("'-' as lang_key", "'-' || id % 3 as key", "false as base_failed", "array(id, id, id, id) as cells")
    parts = [quality_rules.sketches(cells.where(c)) for c in ("id % 7 < 3", "id % 7 >= 3")]
    whole = quality_rules.bounds(quality_rules.sketches(cells), ["lang_key"]).collect()
    assert quality_rules.bounds(parts[0].union(parts[1]), ["lang_key"]).collect() == whole


def test_main_path_is_built_in(spark, folder):
    found = quality_rules.judged(spark.read.parquet(f"{folder}/documents.parquet"))
    rows = quality_rules.measured(spark.read.parquet(f"{folder}/documents.parquet"))
    for df in (found, rows):
        assert "Python" not in df._jdf.queryExecution().executedPlan().toString() and "Arrow" not in df._jdf.queryExecution().executedPlan().toString()
