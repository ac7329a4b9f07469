"""The classifier: held-out accuracy, the dual fit, and odd rows."""

import zlib

import numpy as np
from pyspark.sql import functions as F

from snapstats.llm import nbsvm as nb


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    got = nb.op10_quality(docs, labels)
    assert got.dtypes == [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")]
    rows = got.join(labels, "doc_id", "left").collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    good, bad = ([r.score for r in rows if r.held_out and r.quality == q] for q in (1, 0))
    auc = np.mean([[1.0 if a > b else 0.5 if a == b else 0.0 for b in bad] for a in good])
    assert auc > 0.98 and np.mean([s >= 0.3 for s in good]) > 0.97 and np.mean([s < 0.3 for s in bad]) > 0.85


def test_dual_fit_is_optimal():
    rng = np.random.default_rng(4)
    scale = rng.normal(size=30)
    rows = [np.unique(rng.integers(0, 30, 8)) for _ in range(80)]
    y = np.array([int(r.sum() + rng.normal(scale=20) > 100) for r in rows])
    w, bias = nb.dual_coordinate_descent(rows, y, scale, epochs=2000)

    def loss(w, bias):
        signs = np.where(y > 0, 1, -1)
        return (w @ w + bias * bias) / 2 + sum(max(0, 1 - s * (w[r] @ scale[r] + bias)) for r, s in zip(rows, signs))
    best = loss(w, bias)
    for _ in range(300):
        assert best <= loss(w + rng.normal(scale=.01, size=30), bias + rng.normal(scale=.01)) + 1e-2


def test_odd_rows(spark):
    words = "fine clean prose about many things of the world".split()
    rows = [(i, " ".join(words[(i + k * i) % 9] for k in range(12)) if i % 3 else "spam!!! " * 9, "en") for i in range(60)] + [(None, "x", "a"), (90, None, "b"), (91, "", "c"), (3, "again", "d")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, _label string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(60)] + [(None, 1, 0), (5, None, 1), (5, 1, 1), (777, 0, 0)], "doc_id bigint, quality int, toxic int")
    got = nb.op10_quality(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.held_out is not None for r in got)
    by = {r.doc_id: r.score for r in got}
    assert by[90] == by[91] and min(by[i] for i in range(60) if i % 3) > max(by[i] for i in range(0, 60, 3) if i != 3)
    for none in (labels.limit(0), labels.where("quality = 1")):
        assert nb.op10_quality(docs, none).where("score between 0 and 1").count() == len(rows)
    assert nb.op10_quality(docs.limit(0), labels).count() == 0
    assert [r.score for r in nb.op10_quality(docs, labels).orderBy("doc_id", "score").collect()] == sorted_scores(got)


def sorted_scores(rows):
    return [r.score for r in sorted(rows, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.score))]
