import random
import zlib

import numpy as np
from cases import ODD, documents, labels, stored

from restock.llm import quality_classifier as qc


def corpus(n=400):
    rng = random.Random(4)
    texts, marks = [], []
    for i in range(n):
        words = ["".join(rng.choices("abcdefg", k=rng.randint(1, 7))) for _ in range(rng.randint(5, 60))]
        good = i % 3 > 0
        if not good:
            kind = rng.randrange(3)
            words = [w.upper() + "!!" for w in words] if kind == 0 else [w + "###" for w in words] if kind == 1 else [w for w in words for _ in range(6)]
        texts.append(" ".join(words))
        marks.append((i, int(good), 0))
    return texts, marks


def test_held_out_rows_are_told_apart(spark, tmp_path):
    texts, marks = corpus()
    rows = qc.scores(documents(spark, tmp_path, texts), labels(spark, marks)).collect()
    assert len(rows) == len(texts)
    for row in rows:
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 3 == 1)
        assert 0 <= row.score <= 1 and row.predicted == int(row.score >= 0.5)
    held = [row for row in rows if row.held_out]
    assert sum(row.predicted == marks[row.doc_id][1] for row in held) >= 0.98 * len(held)


def test_held_out_labels_have_no_effect(spark, tmp_path):
    texts, marks = corpus(150)
    docs = documents(spark, tmp_path, texts)
    turned = [(i, 1 - q if zlib.crc32(str(i).encode()) % 3 == 1 else q, t) for i, q, t in marks]
    both = [{r.doc_id: r.score for r in qc.scores(docs, labels(spark, m)).collect()} for m in (marks, turned)]
    assert both[0] == both[1]


def test_accepted_rows_are_those_predicted_good(spark, tmp_path):
    texts, marks = corpus(200)
    docs, given = documents(spark, tmp_path, texts), labels(spark, marks)
    kept = qc.accepted(docs, given)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in qc.scores(docs, given).collect() if r.predicted}


def test_coordinate_descent_reaches_the_optimum():
    """The duality gap of the hinge-loss problem closes."""
    rng = np.random.default_rng(1)
    rows = [np.unique(rng.integers(0, 40, 8)) for _ in range(80)]
    signs = np.where(np.array([row.sum() for row in rows]) > np.median([row.sum() for row in rows]), 1.0, -1.0)
    ratios, costs = rng.normal(size=40), np.full(80, 0.5)
    model = qc.dual_coordinate_descent(rows, signs, ratios, costs, passes=2000)
    scaled = np.zeros((80, 41))
    for i, row in enumerate(rows):
        scaled[i, row] = ratios[row] / np.sqrt((ratios[row] ** 2).sum())
        scaled[i, 40] = 1
    w = np.append(model.weights, model.intercept)
    primal = lambda v: 0.5 * v @ v + (costs * np.maximum(0, 1 - signs * (scaled @ v))).sum()
    best = primal(w)
    for _ in range(300):
        assert best <= primal(w + rng.normal(scale=0.01, size=41)) + 1e-3


def test_shapes_and_repeats():
    assert [qc.shape(w) for w in ("Thha***", "ATIN!!", "abc", "|", "4é")] == ["Aa*", "A!", "a", "|", "0a"]
    assert set(qc.features("the the the")) & set(qc.features("a a a")) - set(qc.features("the cat sat"))
    assert qc.features(None).size == qc.features(" \n").size == 0


def test_odd_rows_and_labels(spark, tmp_path):
    docs = stored(spark, tmp_path, ODD)
    given = labels(spark, [(1, 1, 0), (1, 1, 0), (5, 0, 0), (2, None, None), (None, 1, 1), (99, 0, 0), (6, 7, 0)])
    rows = qc.scores(docs, given).collect()
    assert len(rows) == len(ODD) and all(0 <= row.score <= 1 and row.held_out is not None for row in rows)
    assert len({row.score for row in rows if row.doc_id in (2, 3, 4)}) == 1
    assert qc.accepted(docs, given).columns == docs.columns


def test_no_labels_and_no_documents(spark, tmp_path):
    docs = stored(spark, tmp_path, ODD)
    assert {row.score for row in qc.scores(docs, labels(spark, [])).collect()} == {0.5}
    assert qc.accepted(docs, labels(spark, [])).count() == len(ODD)
    assert qc.scores(stored(spark, tmp_path, [], name="none"), labels(spark, [(1, 1, 0), (2, 0, 0)])).collect() == []
