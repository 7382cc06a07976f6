from __future__ import annotations

import zlib
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from silverline.llm import quality_crf as Q
from silverline.llm.wordhash import WordHasher
from tests.llm.helpers import docs_of

SF = "/root/testdata/sf0.01"


def test_forward_backward_against_enumeration():
    rng = np.random.default_rng(0)
    lines, transition = np.array([1, 4, 2]), rng.normal(size=(2, 2))
    unary = rng.normal(size=7)
    marginal, expected, log_z = Q.forward_backward(unary, lines, transition)
    at, all_edges, all_z = 0, np.zeros((2, 2)), 0.0
    for n in lines:
        total, good, edges = 0.0, np.zeros(n), np.zeros((2, 2))
        for labels in product((0, 1), repeat=n):
            score = sum(u if y else 0 for u, y in zip(unary[at:at + n], labels, strict=True))
            score += sum(transition[a, b] for a, b in zip(labels[:-1], labels[1:], strict=True))
            p = np.exp(score)
            total += p
            good += p * np.array(labels)
            for a, b in zip(labels[:-1], labels[1:], strict=True):
                edges[a, b] += p
        assert marginal[at:at + n] == pytest.approx(good / total)
        all_edges += edges / total
        all_z += np.log(total) - np.log1p(np.exp(unary[at:at + n])).sum()
        at += n
    assert expected == pytest.approx(all_edges) and log_z == pytest.approx(all_z)


def test_features_of_lines():
    texts = [b"The the THE\n\nA | b", b"", "Été 12!!".encode()]
    features, lines, weight = Q.line_features(texts, WordHasher())
    assert lines.tolist() == [3, 1, 1] and weight.tolist() == [12, 1, 6, 1, 11]
    assert features[0, 8] == pytest.approx(2 / 3) and features[0, 9] == pytest.approx(2 / 3)      # repeats, not distinct
    assert features[1, 42] == 1 and features[3, 42] == 1 and features[4, 6] == pytest.approx(1 / 2)
    alone = np.concatenate([Q.line_features([t], WordHasher())[0] for t in texts])
    assert (alone == features).all()
    wide = Q.with_neighbours(features, lines)
    assert (wide[1, 46:91] == features[0]).all() and not wide[3, 46:].any()


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = {r["doc_id"]: r for r in Q.quality(docs, labels).collect()}
    assert len(rows) == docs.count()
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) and r["predicted"] == (r["score"] >= 0.3) for i, r in rows.items())
    held = [i for i in truth if rows[i]["held_out"]]
    assert np.mean([rows[i]["predicted"] == truth[i] for i in held]) >= 0.95
    flipped = labels.withColumn("quality", F.when(Q.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = {r["doc_id"]: r["score"] for r in Q.quality(docs.withColumn("lang", F.lit("xx")), flipped).collect()}
    assert again == {i: r["score"] for i, r in rows.items()}         # held-out labels and other columns change nothing


def test_edges(spark):
    labels = spark.createDataFrame([(1, 1), (1, 0), (1, 1), (2, 0), (3, None), (None, 0), (4, 0)], "doc_id long, quality int") \
        .withColumn("text", F.lit("clash"))
    rows = [(1, "Good words here."), (2, "bad!! BAD!!"), (3, None), (4, ""), (None, "x"), (2, "bad!! BAD!!"), (5, "line\n" * 40000)]
    docs = docs_of(spark, rows).withColumn("score", F.lit(7)).withColumn("features", F.lit(7)).withColumn("quality", F.lit(7))
    got = Q.quality(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    assert Q.quality(docs.limit(0), labels).count() == 0
    assert {r["score"] for r in Q.quality(docs, labels.limit(0)).collect()} == {0.5}


def test_all_lines_of_long_documents_are_learnt(spark, monkeypatch):
    """Lines at the start of long documents, alone in telling bad from good, are learnt; on Spark as on the driver."""
    good, bad = "Some plain words stand here.", "WIN NOW!!! | $$$ 100% | 777"
    rows = [(i, "\n".join([good if i % 2 else bad] * 100 + ["same line of text"] * 300)) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    calls = []
    steps = 20
    climb = Q._climb
    monkeypatch.setattr(Q, "_climb", lambda g, width, texts, *_: climb(lambda t: calls.append(1) or g(t), width, texts, steps))
    whole = Q.train(docs, labels)
    monkeypatch.setattr(Q, "DRIVER_LINES", 1000)
    summed = Q.train(docs, labels)
    assert len(calls) == 2 * steps
    assert np.allclose(whole.weights, summed.weights, atol=1e-6) and np.allclose(whole.transition, summed.transition, atol=1e-6)
    tests = spark.createDataFrame([(1, good), (2, bad)], "doc_id long, text string")
    score = {r["doc_id"]: r["_score"] for r in Q.score_documents(tests, whole).collect()}
    assert score[1] > 0.6 and score[2] < 0.4
