from __future__ import annotations

import zlib

import numpy as np
from llm.helpers import awkward, frame, words

from tidemark.llm import quality

LABELS = "doc_id bigint, quality int, toxic int"


def labelled(n=400):
    import random

    rng = random.Random(1)
    rows, labels = [], []
    for i in range(n):
        text = words(rng, rng.randrange(5, 60))
        if i % 5 == 0:
            text = " ".join(w + "$$$" for w in text.split()) if i % 2 else text.upper() + "!!"
        rows.append((i, text, None, None, None))
        labels.append((i, int(i % 5 != 0), 0))
    return rows, labels


def test_weights_minimise_the_loss():
    rng = np.random.default_rng(2)
    better, worse = rng.normal(0.5, 1, (200, 4)), rng.normal(0, 1, (60, 4))
    w = quality.bradley_terry(better, worse)
    r = np.random.default_rng(0)
    sides = [np.concatenate([r.permutation(np.resize(np.arange(len(x)), 200)) for _ in range(quality.PAIRINGS)]) for x in (better, worse)]
    gap = better[sides[0]] - worse[sides[1]]
    loss = lambda v: np.logaddexp(0, -(gap @ v)).mean() + quality.PENALTY * v @ v / 2
    for k in range(4):
        for d in (-1e-3, 1e-3):
            assert loss(w) <= loss(w + d * np.eye(4)[k])


def test_held_out_rows(spark):
    rows, labels = labelled()
    docs = frame(spark, rows)
    model = quality.fit(docs, spark.createDataFrame(labels, LABELS))
    truth = dict((d, q) for d, q, _ in labels)
    held = [r for r in quality.scored(docs, model, ("doc_id",)).collect() if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert len(held) > 50 and np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in held)


def test_held_out_labels_are_not_learned_from(spark):
    rows, labels = labelled()
    docs = frame(spark, rows)
    turned = [(d, 1 - q if zlib.crc32(str(d).encode()) % 4 == 2 else q, t) for d, q, t in labels]
    assert quality.fit(docs, spark.createDataFrame(labels, LABELS)) == quality.fit(docs, spark.createDataFrame(turned, LABELS))


def test_scores_depend_on_the_text_alone(spark):
    model = ([0.3] * len(quality.features("")), 0.1)
    a = {r.doc_id: r.score for r in quality.scored(frame(spark, [(i, r[1], *r[2:]) for i, r in enumerate(awkward())]), model, ("doc_id",)).collect()}
    b = {r.doc_id: r.score for r in quality.scored(frame(spark, [(i, r[1], "xx", "yy", 0) for i, r in enumerate(awkward())]), model, ("doc_id",)).collect()}
    assert a == b and len(a) == len(awkward())


def test_awkward_rows_and_labels(spark, tmp_path):
    labels = [(0, 1, 0), (0, 0, 0), (1, None, 0), (None, 1, 0), (9999, 0, 0), (3, 1, 1), (5, 0, 0), (5, 0, 0), (6, 1, 0)]
    spark.createDataFrame(labels, LABELS).write.parquet(f"{tmp_path}/labels.parquet")
    docs = frame(spark).withColumnsRenamed({"lang": "score", "source": "features"})
    kept = quality.stage(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns and kept.count() <= len(awkward())
    one = spark.createDataFrame([(0, 1, 0)], LABELS)
    got = quality.scored(frame(spark), quality.fit(frame(spark), one), ("doc_id",)).collect()
    assert {(r.score, r.predicted) for r in got} == {(0.7, 1)} and len(got) == len(awkward())
    empty = quality.fit(frame(spark, []), spark.createDataFrame([], LABELS))
    assert quality.scored(frame(spark, []), empty, ("doc_id",)).collect() == []
