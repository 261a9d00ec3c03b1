"""Training takes every labelled document: moments, pairs and threshold against plain versions."""

import zlib

import numpy as np
import pyarrow as pa
import pytest

from agrometry.llm import quality


def _learned(d):
    return zlib.crc32(str(d).encode()) % 3 != 1


def _texts(n):
    return [(d, f"Plain words, number {d} of many." * (1 + d % 3) if d % 4 else f"||| {d} !! ?? {'X' * (d % 5)}") for d in range(n)]


def test_all_labelled_documents_count(spark):
    """More than 3 000 documents of a label, which once were all that was learned from."""
    texts = _texts(9_000)
    docs = spark.createDataFrame(texts, "doc_id int, text string")
    labels = spark.createDataFrame([(d, int(d % 4 > 0)) for d, _ in texts], "doc_id int, quality int")
    fitted = quality.train(docs, labels)
    known = [(d, t) for d, t in texts if _learned(d)]
    plain = quality.features(pa.array([t for _, t in known]))
    assert np.allclose(fitted.centre, plain.mean(0), atol=1e-5)
    label = np.array([d % 4 > 0 for d, _ in known])
    assert ((fitted.score(plain) >= 0.5) == label).all()


def test_one_group_gives_the_weights_of_all_pairs(spark):
    texts = _texts(200)
    docs = spark.createDataFrame(texts, "doc_id int, text string").repartition(4)
    labels = spark.createDataFrame([(d, int(d % 4 > 0)) for d, _ in texts], "doc_id int, quality int")
    fitted = quality.train(docs, labels)
    known = [(d, t) for d, t in texts if _learned(d)]
    plain = quality.features(pa.array([t for _, t in known])).astype(np.float32).astype(float)
    good = np.array([d % 4 > 0 for d, _ in known])
    want = quality.fit(plain[good], plain[~good], (~good).mean())
    for name in ("centre", "scale", "weights", "threshold", "spread"):
        assert np.allclose(getattr(fitted, name), getattr(want, name), atol=1e-6), name


def test_a_rare_label_meets_every_document(spark):
    known = spark.createDataFrame([(d, int(d >= 40), b"") for d in range(5_000)], "doc_id bigint, label int, features binary")
    rows = quality._dealt(known, {0: 40, 1: 4_960}).toPandas()
    assert rows["first"].sum() == 5_000
    assert (rows[rows.label == 0].groupby("bucket").size().reindex(rows.bucket.unique(), fill_value=0) >= 15).all()


@pytest.mark.parametrize("bins", [4, 64])
@pytest.mark.parametrize("rejected", [0.05, 0.5, 0.8])
def test_the_threshold_is_the_exact_quantile(spark, monkeypatch, bins, rejected):
    monkeypatch.setattr(quality, "BINS", bins)
    draw = np.random.default_rng(1)
    raw = np.concatenate([draw.normal(0, 1, 300), draw.normal(0, 1e-9, 100), [50.0, -90.0]])
    label = draw.integers(0, 2, len(raw))
    scores = spark.createDataFrame([(int(k), float(r)) for k, r in zip(label, raw)], "label int, raw double")
    order = np.argsort(raw)
    share = np.where(label == 1, (1 - rejected) / (label == 1).sum(), rejected / (label == 0).sum())[order]
    at = int(np.searchsorted(np.cumsum(share), rejected - 1e-12))
    want = (raw[order][at] + raw[order][at + 1]) / 2
    assert abs(quality._cut(scores, rejected)[0] - want) < 1e-12
