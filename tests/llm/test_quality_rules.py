import random
import re
from collections import Counter

import numpy as np
from cases import DOCS, ODD, stored
from hypothesis import given, settings
from hypothesis import strategies as st

from restock.llm import quality_rules as qr


def slow_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    twice = Counter(windows)
    covered = {j for i, w in enumerate(windows) if twice[w] > 1 for j in range(i, i + 5)}
    seen, equal = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            equal += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), equal, len(covered)


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab #|\n\t\u00a0\x1c\x85\u00e9\U0001f600"), max_size=80))
def test_counts_like_brute_force(text):
    assert qr.statistics(text)[:5] == slow_counts(text)


SCHEMA = "doc_id long, text string, lang string, source string"


def corpus(spark, tmp_path):
    rng = random.Random(11)
    rows = []
    for i in range(600):
        words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(rng.randint(15, 120))]
        bad = i % 20 == 0
        if bad:
            words = [w.upper() + "!" for w in words] if i % 40 else [w + "###" for w in words]
        source = "hot" if i % 3 else f"s{i % 2}" if i < 570 else f"tiny{i}"
        rows.append((i, " ".join(words), "en" if i % 2 else "de", source))
    return stored(spark, tmp_path, rows, SCHEMA)


def test_outliers_go_and_others_stay(spark, tmp_path):
    rows = qr.judged(corpus(spark, tmp_path)).collect()
    assert len(rows) == 600
    for row in rows:
        assert row.kept == (row.doc_id % 20 != 0) and not row.base_failed


def test_many_groups_are_joined_by_salted_keys_with_equal_results(spark, tmp_path, monkeypatch):
    docs = corpus(spark, tmp_path)
    few = sorted(map(str, qr.judged(docs).collect()))
    monkeypatch.setattr(qr, "GROUPS", 2)
    monkeypatch.setattr(qr, "SALTS", 7)
    assert sorted(map(str, qr.judged(docs).collect())) == few
    rows = spark.createDataFrame([("hot", i % 7) for i in range(500)] + [(None, 0)], "unit string, salt int")
    groups = qr.written(spark.createDataFrame([(u, 1) for u in ("hot", "b", "c")], "unit string, n int"))
    joined = qr.beside(rows, groups, ["unit"], "left")
    assert joined.count() == 501 and joined.filter("n IS NULL").count() == 1


def test_estimates_like_concentration_steps(spark):
    """The same steps with exact quantiles on one group."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, qr.SIZE)) * 0.3
    x[:30] += 4
    df = spark.createDataFrame([("u", row.tolist()) for row in x], "unit string, x array<double>")
    estimate = qr._start(df)
    for _ in range(qr.STEPS):
        estimate = qr._nearer(df, estimate)
    (found,) = estimate.collect()
    mean = np.median(x, axis=0)
    spread = 1.4826 * np.median(np.abs(x - mean), axis=0)
    inverse = np.diag(1 / (spread**2 + np.square(qr.FLOORS)))
    for _ in range(qr.STEPS):
        d = np.einsum("ij,jk,ik->i", x - mean, inverse, x - mean)
        near = x[d <= np.quantile(d, qr.NEAREST)]
        mean = near.mean(axis=0)
        inverse = np.linalg.inv(np.cov(near.T, bias=True) + np.diag(np.square(qr.FLOORS)))
    assert np.allclose(found["mean"], mean, atol=0.03)
    assert np.allclose(np.array(found["inverse"]).reshape(qr.SIZE, qr.SIZE), inverse, rtol=0.3, atol=0.8)
    assert np.abs(found["mean"]).max() < 0.1


def test_odd_rows(spark, tmp_path):
    rows = qr.judged(stored(spark, tmp_path, ODD, DOCS)).collect()
    assert len(rows) == len(ODD)
    texts = {row[0]: row[1] for row in ODD}
    for row in rows:
        counts = slow_counts(texts[row.doc_id])
        assert tuple(row[name] for name in qr.COUNTS) == counts
        failed = counts[0] < 10 or 100 * counts[4] > 20 * counts[0]
        # So few rows give no verdict.
        assert row.base_failed == failed and row.kept == (not failed) and row.distance is None


def test_empty_table(spark, tmp_path):
    assert qr.judged(stored(spark, tmp_path, [])).collect() == []
