import random
import re

import xxhash
from cases import DOCS, ODD, documents, stored

from restock.llm import simhash_dedup
from restock.llm.components import connected


def slow_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def slow_components(fingerprints, ids):
    root = list(range(len(ids)))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(fingerprints):
            for j, b in enumerate(fingerprints):
                if (a ^ b).bit_count() <= 2 and root[i] != root[j]:
                    root[i] = root[j] = min(root[i], root[j])
                    changed = True
    known = {}
    for r, i in zip(root, ids, strict=True):
        if i is not None:
            known[r] = min(known.get(r, i), i)
    return [known.get(r) for r in root]


def check(rows):
    fingerprints = [row.fp & (1 << 64) - 1 for row in rows]
    expected = slow_components(fingerprints, [row.doc_id for row in rows])
    assert [row.component_id for row in rows] == expected


def test_odd_rows(spark, tmp_path):
    rows = simhash_dedup.near_duplicates(stored(spark, tmp_path, ODD)).collect()
    assert len(rows) == len(ODD)
    texts = {i: text for i, text, *_ in ODD}
    assert all(row.fp & (1 << 64) - 1 == slow_fingerprint(texts[row.doc_id]) for row in rows)
    assert {row.component_id for row in rows if row.doc_id in (2, 3, 4)} == {2}
    assert {row.component_id for row in rows if row.doc_id in (1, 6)} == {1}
    assert [row.component_id for row in rows if row.doc_id is None] == [None]
    check(rows)


def test_empty_table(spark, tmp_path):
    empty = stored(spark, tmp_path, [])
    assert simhash_dedup.near_duplicates(empty).collect() == []
    assert simhash_dedup.keep_one(empty).collect() == []


def test_links_like_brute_force_with_small_and_large_keys(spark, tmp_path):
    """Chains, stars and copies, linked by pairs and by neighbouring words alike."""
    rng = random.Random(3)
    words = [rng.getrandbits(64) for _ in range(20)]
    for word in list(words):
        here = word
        for _ in range(12):
            for bit in rng.sample(range(64), rng.choice([1, 2, 2, 3])):
                here ^= 1 << bit
            words.append(here)
    signed = sorted({w - (1 << 64) if w >> 63 else w for w in words})
    table = spark.createDataFrame([(w,) for w in signed], "fp long")
    roots = slow_components([w & (1 << 64) - 1 for w in signed], signed)
    expected = {w: r for w, r in zip(signed, roots, strict=True)}
    for bucket in (64, 2, 1):
        found = {row.node: row.root for row in connected(simhash_dedup.links(table, bucket)).collect()}
        assert {w: found.get(w, w) for w in signed} == expected


def test_pivot_keys_meet_for_all_near_words(spark):
    rng = random.Random(5)
    pairs = []
    for _ in range(200):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), rng.choice([0, 1, 2])):
            b ^= 1 << bit
        pairs.append(tuple(w - (1 << 64) if w >> 63 else w for w in (a, b)))
    df = spark.createDataFrame(pairs, "a long, b long")
    keys = [simhash_dedup.pivot_keys(simhash_dedup.pivot_distances(df[name])) for name in "ab"]
    from pyspark.sql import functions as F

    assert df.filter(~F.arrays_overlap(*keys)).count() == 0


def test_one_document_of_each_group_stays(spark, tmp_path):
    base = " ".join(f"word{i}" for i in range(300))
    near = base.replace("word150 ", "other ")
    texts = [base, near, base, "quite another text with words of its own", None, ""]
    docs = documents(spark, tmp_path, texts)
    kept = simhash_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(row.doc_id for row in kept.collect()) in ([0, 3, 4], [0, 1, 3, 4])
    found = {row.doc_id: row.component_id for row in simhash_dedup.near_duplicates(docs).collect()}
    assert sorted(row.doc_id for row in kept.collect()) == sorted(set(found.values()))


def test_rows_that_repeat_leave_one(spark, tmp_path):
    kept = simhash_dedup.keep_one(stored(spark, tmp_path, ODD, DOCS))
    assert sorted(row.doc_id for row in kept.collect() if row.doc_id is not None) == [1, 2, 5, 7]
    assert kept.filter("doc_id IS NULL").count() == 1


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 500), (7, 3)], "a long, b long")
    rows = connected(links).collect()
    assert len(rows) == 201 and {row.root for row in rows} == {0}
