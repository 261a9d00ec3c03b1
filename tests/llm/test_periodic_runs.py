"""Runs of words against a brute-force search, on texts that are hard for periods, and the registered rewriting."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from brute import BLANK
from pyspark.sql import functions as F

from agrometry.llm import arrays, periodic_runs, queries


def brute(words, least=12):
    """(start, end) -> smallest period of all stretches."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        k = 0
        while k < n - q:
            begin = k
            while k < n - q and words[k] == words[k + q]:
                k += 1
            if k - begin >= q and k - begin + q >= least:
                found.setdefault((begin, k + q), q)
            k = max(k, begin + 1)
    return sorted((s, q, e - s) for (s, e), q in found.items())


def _fibonacci(draw):
    a, b = [0], [0, 1]
    while len(b) < 250:
        a, b = b, b + a
    return b[: draw.randrange(20, 250)]


def _thue_morse(draw):
    return [bin(k).count("1") % 2 for k in range(draw.randrange(20, 256))]


def _nested(draw):
    words = [draw.randrange(3)]
    while len(words) < 200:
        step = draw.randrange(3)
        words = words * draw.randrange(2, 5) if step == 0 else words + ([draw.randrange(3)] if step == 1 else words[: draw.randrange(1, len(words) + 1)])
    return words[:400]


def _broken_power(draw):
    power = ([draw.randrange(3) for _ in range(draw.randrange(1, 9))] * 200)[: draw.randrange(20, 160)]
    return [9] * draw.randrange(3) + power + power + power[: draw.randrange(4)] + [draw.randrange(3) for _ in range(draw.randrange(30))]


def _copied(draw):
    words = [draw.randrange(1000) for _ in range(200)]
    for _ in range(3):
        at = draw.randrange(len(words))
        words[at:at] = words[at : at + draw.randrange(1, 60)] * draw.randrange(1, 4)
    return words


@pytest.mark.parametrize("make", [_fibonacci, _thue_morse, _nested, _broken_power, _copied, lambda d: [d.randrange(2) for _ in range(200)]])
def test_all_runs_are_found(make):
    draw = random.Random(11)
    for _ in range(40):
        texts = [make(draw) for _ in range(draw.randrange(1, 4))]
        values = [x for k, t in enumerate(texts) for x in [*t, 10**6 + k]]
        found = periodic_runs.find_runs(arrays.mixed(np.array(values, np.uint64)), max(map(len, texts)))
        want, first = [], 0
        for t in texts:
            want += [(first + s, q, length) for s, q, length in brute(t)]
            first += len(t) + 1
        assert [(s, q, e - s) for s, e, q in found.tolist()] == want


def test_a_set_depends_on_its_context_alone():
    draw = random.Random(3)
    passage = [draw.randrange(50) for _ in range(120)]
    values = [draw.randrange(50) for _ in range(77)] + passage + [draw.randrange(50) for _ in range(40)] + passage + [10**6]
    levels = periodic_runs._levels(arrays.mixed(np.array(values, np.uint64)), len(values))
    place, _ = periodic_runs.synchronising_set(levels, 2, np.zeros((0, 3), np.int64))
    inside = lambda begin: {p - begin for p in place if begin <= p <= begin + 120 - 24}
    assert inside(77) == inside(77 + 160) and inside(77)


def _plain(doc_id, text, made=False):
    words = BLANK.findall((text or "").encode())
    if made and doc_id is not None:
        h = zlib.crc32(str(doc_id).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]
    found = brute(words)
    gone = {i for s, q, length in found for i in range(s + q, s + length)}
    lines = "".join(f"{s},{length},{q}\n" for s, q, length in found)
    best = min(found, key=lambda r: (-r[2], r[0], r[1]), default=None)
    first = (best[0], best[2], best[1], 1000 * best[2] // best[1]) if best else (None,) * 4
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(found), *first, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_documents_with_nulls_repeats_and_clashing_names(spark):
    rows = [
        (1, "a b " * 30), (1, "a b " * 30), (None, "x " * 12), (2, None), (3, ""), (4, " \t\n "), (5, "é ü\x0bß " * 9 + "日本 " * 13), (6, "x " * 11),
        (7, "p q r s t u " * 2), (8, "long words here " * 4_000), (9, " ".join(f"w{k % 700}" for k in range(2_000))),
    ]
    docs = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "doc_id bigint, text string, n_words int, runs string, collapsed int")
    got = [tuple(r) for r in periodic_runs.digest(periodic_runs.runs(docs)).collect()]
    assert sorted(got, key=str) == sorted((_plain(*r) for r in rows), key=str)
    assert periodic_runs.digest(periodic_runs.runs(docs.limit(0))).isEmpty()


def test_registered_query_against_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").where(F.length("text") < 6000).collect()
    got = {r["doc_id"]: tuple(r) for r in queries.op13_periodic_runs(spark, folder).collect()}
    assert all(got[r["doc_id"]] == _plain(r["doc_id"], r["text"], True) for r in docs) and len(docs) > 100
