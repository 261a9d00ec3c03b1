"""Language and quality against plain versions: exact sets instead of a filter, one document at a time."""

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from agrometry.llm import language_id, quality, queries


def _grams(text):
    """All runs of GRAM bytes of a text with single blanks for everything but letters."""
    data = bytes(c + 0x20 if 0x41 <= c <= 0x5A else c for c in (text or "").encode())
    plain = b" " + bytes(c if 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in data) + b" "
    while b"  " in plain:
        plain = plain.replace(b"  ", b" ")
    return [plain[i : i + language_id.GRAM] for i in range(len(plain) - language_id.GRAM + 1)]


def test_language_against_exact_sets(spark):
    folder = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang").collect()
    learned = [r for r in rows if r["lang"] and r["text"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2]
    sizes = Counter(r["lang"] for r in learned)
    found = {name: Counter() for name in sizes}
    for r in learned:
        found[r["lang"]].update(set(_grams(r["text"])))
    most = Counter()
    for name, counts in found.items():
        for gram, n in counts.items():
            most[gram] = max(most[gram], n / sizes[name])
    own = {name: {g for g, n in counts.items() if n / sizes[name] >= language_id.SHARE * most[g]} for name, counts in found.items()}
    got = {r["doc_id"]: r for r in queries.op2_language(spark, folder).collect()}
    same = close = asked = 0
    for r in rows:
        grams = _grams(r["text"])
        hits = {name: sum(g in has for g in grams) for name, has in sorted(own.items())}
        if not sum(hits.values()) or got[r["doc_id"]]["lang_pred"] == language_id.UNKNOWN:
            continue
        best = max(hits, key=hits.get)
        asked += 1
        same += got[r["doc_id"]]["lang_pred"] == best
        close += abs(got[r["doc_id"]]["score"] - hits[best] / sum(hits.values())) < 0.02
    assert asked > 900 and same >= 0.995 * asked and close >= 0.99 * asked


def _kind(c):
    if 0x61 <= c <= 0x7A:
        return 0
    if 0x41 <= c <= 0x5A:
        return 1
    if 0x30 <= c <= 0x39:
        return 2
    named = {0x20: 3, 0x0A: 4, 0x0D: 4, 0x2E: 5, 0x2C: 6, 0x21: 7, 0x3F: 7, 0x7C: 10}
    return named.get(c, 8 if c >= 0x80 else 11 if c < 0x20 or c == 0x7F else 9)


def _features(text):
    data = (text or "").encode()
    kinds = [_kind(c) for c in data]
    double, single = Counter(zip(kinds, kinds[1:])), Counter(kinds)
    words, lines = data.split(), [x for x in data.replace(b"\r", b"\n").split(b"\n") if x]
    n, w, k = max(1, len(data)), max(1, len(words)), max(1, len(lines))
    sizes = [len(x) for x in words]
    mean = sum(sizes) / w
    more = [
        math.log1p(len(data)), math.log1p(len(words)), mean, math.sqrt(max(0, sum(s * s for s in sizes) / w - mean**2)),
        len(set(words)) / w, len(set(lines)) / k, sum(2 * sum(_kind(c) == 1 for c in x) > len(x) for x in words) / w,
        sum(a == b for a, b in zip(words, words[1:])) / w, sum(_kind(x[-1]) in (7, 9, 10) for x in words) / w, math.log1p(w / k),
    ]
    pairs = [double[(b, a)] / n for a in range(12) for b in range(12)]
    return [*pairs, *(single[a] / n for a in range(12)), *more]


def test_quality_features_and_scores_against_a_loop(spark, rows):
    texts = [t for _, t in rows] + ["A|B!? c\r\nd\x00e\x7f", "é É ÉÀ", "\n\n\n", "x" * 3000, "1 1 1 2 2\n1 1 1 2 2"]
    plain = np.array([_features(t) for t in texts])
    assert np.allclose(quality.features(pa.array(texts, pa.string())), plain, atol=1e-9)
    draw = np.random.default_rng(3)
    good, poor = draw.normal(0.5, 1, (60, quality.FEATURES)), draw.normal(-0.5, 1, (60, quality.FEATURES))
    fitted = quality.fit(good, poor, 0.5)
    for row, score in zip(plain, fitted.score(plain)):
        raw = sum(min(8, max(-8, (x - c) / s)) * w for x, c, s, w in zip(row, fitted.centre, fitted.scale, fitted.weights))
        assert abs(score - 1 / (1 + math.exp(-min(30, max(-30, (raw - fitted.threshold) / fitted.spread))))) < 1e-9
