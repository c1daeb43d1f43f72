import hashlib
import re

import pytest
from cases import ODD, documents, stored
from pyspark.sql import functions as F

from restock.llm import queries, spot_signatures


def words_of(text):
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").lower()) if w]


def sixty(text):
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def signatures(text):
    words = words_of(text)
    found = set()
    for i, word in enumerate(words):
        if word in spot_signatures.ANCHORS:
            chain = [w for w in words[i:] if w not in spot_signatures.ANCHORS][:3]
            if len(chain) == 3:
                found.add(sixty(" ".join([word, *chain])))
    return sorted(found or ({sixty(" ".join(words))} if words else set()))


def likeness(a, b):
    return 1.0 if a == b else len(set(a) & set(b)) / len(set(a) | set(b))


def digest(found):
    return hashlib.md5(",".join(map(str, found)).encode()).hexdigest()


def expected(rows):
    texts = sorted(((i, text or "") for i, text in rows), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    out = []
    for at, (doc_id, text) in enumerate(texts):
        after = texts[(at + 1) % len(texts)][1]
        half = len(text) // 2
        changed = text[: len(text) - half] + after[:half]
        a, b, c = signatures(text), signatures(changed), signatures(after)
        near = likeness(a, b), likeness(a, c)
        out.append((doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest(), digest(a), digest(b), *near, len(a)))
    return sorted(out, key=str)


def found(spark, tmp_path, rows, monkeypatch, bucket_rows=None):
    monkeypatch.setattr(queries, "table", lambda *_: rows)
    if bucket_rows:
        beside = spot_signatures.beside_next
        monkeypatch.setattr(spot_signatures, "beside_next", lambda r, i, c: beside(r, i, c, bucket_rows))
    df = queries.op13_spot_signatures(spark, "")
    return sorted((tuple(row)[:8] for row in df.collect()), key=str)


@pytest.mark.parametrize("bucket_rows", [None, 1, 2])
def test_odd_rows(spark, tmp_path, monkeypatch, bucket_rows):
    rows = stored(spark, tmp_path, ODD)
    assert found(spark, tmp_path, rows, monkeypatch, bucket_rows) == expected([(row[0], row[1]) for row in ODD])


@pytest.mark.parametrize("bucket_rows", [3, 50])
def test_like_brute_force_over_many_buckets(spark, tmp_path, monkeypatch, folder, bucket_rows):
    given = [(row.doc_id * 7 - 900, row.text) for row in spark.read.parquet(f"{folder}/documents.parquet").limit(400).collect()]
    given += [(given[0][0], "a repeated id of the first"), (None, "none"), (None, "none too"), (None, None)]
    rows = stored(spark, tmp_path, given, "doc_id long, text string")
    assert found(spark, tmp_path, rows, monkeypatch, bucket_rows) == expected(given)


def test_one_row_and_no_rows(spark, tmp_path, monkeypatch):
    rows = documents(spark, tmp_path, ["The quick brown fox and the lazy dog ran home early"])
    assert found(spark, tmp_path, rows, monkeypatch) == expected([(0, "The quick brown fox and the lazy dog ran home early")])
    assert found(spark, tmp_path, rows.limit(0), monkeypatch) == []


def test_likeness_is_pruned_by_length_without_a_change(spark):
    sets = [[], [1], [1, 2, 3, 4], [1, 2, 3, 4, 5], list(range(100)), list(range(10, 100)), list(range(81)), list(range(79))]
    pairs = [(a, b) for a in sets for b in sets]
    df = spark.createDataFrame(pairs, "a array<long>, b array<long>")
    rows = df.select("*", spot_signatures.likeness(F.col("a"), F.col("b")).alias("near"), spot_signatures.alike(F.col("a"), F.col("b")).alias("alike"))
    for row in rows.collect():
        assert row.near == likeness(row.a, row.b)
        assert row.alike == (likeness(row.a, row.b) >= 0.8)


def test_menus_leave_few_signatures():
    article = "the old house by the river was sold in spring and the new owner painted all of it"
    assert len(signatures(article)) > 3
    assert signatures("Home Products Contact Login Imprint") == [sixty("home products contact login imprint")]
