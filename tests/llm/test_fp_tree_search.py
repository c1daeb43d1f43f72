import math
import random
import re
from collections import Counter

import numpy as np
from cases import ODD, documents, stored

from restock.llm import fp_tree_search

ITEMS = "item_id long, text string, score double, rank int"


def terms(text):
    small = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", small)


def slow(docs, items, best=50):
    """The contract, document by document."""
    counts = [(doc_id, Counter(terms(text))) for doc_id, text in docs]
    held = [c for _, c in counts if c]
    n_docs, n_terms = len(held), sum(sum(c.values()) for c in held)
    df = Counter(term for c in held for term in c)
    rows = []
    for item_id, text in items:
        scores = []
        for doc_id, c in counts:
            score = 0
            for term in set(terms(text)) & set(c):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
                m = 100 - 50 + (50 * sum(c.values()) * n_docs) // n_terms
                score += w * ((1000000000 * c[term]) // (1000 * c[term] + 20 * m))
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0, doc_id))
        rows += [(item_id, rank, doc_id, -score) for rank, (score, _, _, doc_id) in enumerate(sorted(scores)[:best], 1)]
    return sorted(rows, key=str)


def found(docs, items, **options):
    return sorted((tuple(row) for row in fp_tree_search.ranked(docs, items, **options).collect()), key=str)


def test_odd_rows(spark, tmp_path):
    texts = ["one THREE words", None, "", " ", "emoji \U0001f600 中文", "one three words", "Zahl"]
    items = stored(spark, tmp_path, [(i if i != 5 else None, text, 0.0, 1) for i, text in enumerate(texts)], ITEMS, "items")
    docs = stored(spark, tmp_path, ODD)
    assert found(docs, items) == slow([(row[0], row[1]) for row in ODD], [(i if i != 5 else None, t) for i, t in enumerate(texts)])


def test_empty_tables(spark, tmp_path):
    docs, none = stored(spark, tmp_path, ODD), stored(spark, tmp_path, [], name="none")
    items = stored(spark, tmp_path, [(1, "one", 0.0, 1)], ITEMS, "items")
    no_items = stored(spark, tmp_path, [(1, None, 0.0, 1), (2, " ", 0.0, 1)], ITEMS, "no_items")
    assert found(none, items) == found(docs, items.limit(0)) == found(docs, no_items) == []


def test_like_brute_force_with_many_small_trees_and_blocks(spark, tmp_path, monkeypatch):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    common = [rng.choices(words[:12], k=rng.randint(0, 30)) + rng.choices(words, k=rng.randint(0, 12)) for _ in range(300)]
    texts = [" ".join(c) for c in common] + ["w1 w2 w3 w50"] * 90 + [" ".join(words[:40] * 30)]
    items = [(i, " ".join(rng.choices(words, k=8))) for i in range(12)] + [(12, "w50 w2"), (12, "w50 w2")]
    docs = documents(spark, tmp_path, texts)
    given = spark.createDataFrame(items, "item_id long, text string")
    expected = slow(list(enumerate(texts)), items)
    assert found(docs, given) == expected
    monkeypatch.setattr(fp_tree_search, "TREE_POSTINGS", 300)
    assert found(docs, given, block_bytes=150) == expected
    assert found(docs, given, best=3) == slow(list(enumerate(texts)), items, 3)


def test_bounds_hold_and_cut():
    """A node's bound is at least every score below it, and a search looks at few leaves."""
    rng = np.random.default_rng(1)
    sizes = rng.integers(0, 30, 2000)
    held = [np.sort(rng.choice(200, size, replace=False, p=np.arange(200, 0, -1) / 20100)) for size in sizes]
    starts = np.concatenate([[0], np.cumsum(sizes)])
    flat, tfs = np.concatenate(held).astype(np.int64), rng.integers(1, 5, sizes.sum())
    tree = fp_tree_search.Tree(starts, flat, tfs, rng.integers(50, 120, 2000), np.arange(200))
    weights = np.zeros(200, np.int64)
    weights[[1, 5, 40, 120, 160, 199]] = [10, 50, 900, 3000, 4000, 6000]
    exact = fp_tree_search._sums(weights, tree.terms, tree.gains, tree.starts)
    bounds = fp_tree_search._sums(weights, tree.node_terms, tree.node_gains, tree.node_starts)
    assert sorted(tree.order) == list(range(2000))
    assert all(bounds[i] >= exact[a:b].max() for i, (a, b) in enumerate(zip(tree.low, tree.high, strict=True)))

    class Counting(fp_tree_search.Best):
        looked = 0

        def offer(self, scores, documents):
            self.looked += len(scores)
            super().offer(scores, documents)

    best = Counting(10)
    best.ids = list(range(2000))
    tree.search(weights, best)
    assert sorted((score for score, _ in best.heap), reverse=True) == sorted(exact, reverse=True)[:10]
    assert best.looked < 1000
