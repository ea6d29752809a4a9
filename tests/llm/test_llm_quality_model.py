"""The line field: exact marginals, gradients that learn, accuracy on rows it has not seen."""

import itertools
import zlib

import cases
import numpy as np
from scanweave.llm import line_crf
from scanweave.llm.tables import read_table


def test_marginals_against_all_labellings():
    rng = np.random.default_rng(1)
    n_lines = np.array([3, 1, 5, 2])
    odds, moves = rng.normal(size=n_lines.sum()), rng.normal(size=(2, 2))
    upto, behind = line_crf.forward_backward(odds, n_lines, moves)
    got = 1 / (1 + np.exp(-(upto + behind)))
    at = 0
    for n in n_lines:
        total, good = 0.0, np.zeros(n)
        for labels in itertools.product((0, 1), repeat=int(n)):
            score = sum(odds[at + i] * y for i, y in enumerate(labels))
            score += sum(moves[a, b] for a, b in zip(labels, labels[1:]))
            total += np.exp(score)
            good += np.exp(score) * np.array(labels)
        assert np.allclose(got[at : at + n], good / total)
        at += n


def test_features_are_row_local():
    texts = [cases.prose(1, 50).encode(), b"", b"\n", b"A B!\nA B!\n\n***", "é é é\n日本".encode(), b"x " * 500]
    features, sizes, n_lines = line_crf.line_features(texts)
    assert n_lines.tolist() == [t.count(b"\n") + 1 for t in texts] and features.shape == (n_lines.sum(), line_crf.N_FEATURES)
    assert sizes.sum() == sum(len(t) for t in texts) - sum(t.count(b"\n") for t in texts)
    at = 0
    for text, n in zip(texts, n_lines):
        alone, _, _ = line_crf.line_features([text])
        assert np.allclose(features[at : at + n], alone)
        at += n
    repeated, _, _ = line_crf.line_features([b"a a a a\nb\nb"])
    assert repeated[0, 5] == 1.5 and repeated[0, 6] == 1.5 and repeated[2, 7] == 1 and repeated[1, 7] == 0


def test_learns_and_keeps_order_out():
    rng = np.random.default_rng(2)
    labels = rng.integers(0, 2, 60)
    texts = [("Fine words here.\n" * 3 if y else "BAD!! ***\n" * 3).encode() for y in labels]
    features, _, n_lines = line_crf.line_features(texts)
    model = line_crf.train(features, n_lines, labels, steps=100)
    scores = line_crf.document_scores(texts, model)
    assert ((scores >= 0.3) == labels).all()
    assert line_crf.document_scores([], model).shape == (0,)
    assert line_crf.document_scores([b"", b"\n\n"], model).tolist() == [model.base_rate] * 2


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    labels = read_table(spark, folder, "labels")
    model = line_crf.fit(docs, labels)
    rows = line_crf.score_quality(docs, model).select("row.doc_id", "score", "predicted").toPandas()
    rows = rows.merge(labels.toPandas(), on="doc_id")
    unseen = rows[[zlib.crc32(str(d).encode()) % 5 == 0 for d in rows.doc_id]]
    assert (unseen.predicted == unseen.quality).mean() > 0.95
    assert unseen[unseen.quality == 1].predicted.mean() > 0.98
    # Labels of held-out rows do not count.
    flipped = labels.withColumn("quality", line_crf.F.when(line_crf.held_out(labels.doc_id), 1 - labels.quality).otherwise(labels.quality))
    again = line_crf.fit(docs, flipped)
    assert np.array_equal(model.weights, again.weights) and np.array_equal(model.moves, again.moves)


def test_odd_rows(spark):
    docs = cases.table(spark, cases.odd_rows())
    none = spark.createDataFrame([], "doc_id long, quality int")
    model = line_crf.fit(docs, none)
    out = line_crf.score_quality(docs, model)
    assert {r.score for r in out.collect()} == {0.5} and out.count() == docs.count()
    assert out.select("row.*").columns == docs.columns
    labels = spark.createDataFrame([(100, 1), (101, 0), (102, 1), (102, 0), (None, 1), (106, None), (999, 1), (107, 3)], "doc_id long, quality int")
    scored = line_crf.score_quality(docs, line_crf.fit(docs, labels)).collect()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in scored) and len(scored) == docs.count()
    assert line_crf.score_quality(cases.table(spark, []), model).count() == 0
