import random

import corpus_pipeline
from cases import DOCS, ODD, documents, stored

from restock.llm import near_copies


def sets(text):
    words = (text or "").lower().split()
    return {" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def slow_kept(texts):
    """Smallest id of every component of texts with similarity of at least 0.8."""
    held = [sets(text) for text in texts]
    root = list(range(len(texts)))
    for i, a in enumerate(held):
        for j, b in enumerate(held[:i]):
            if 5 * len(a & b) >= 4 * len(a | b) and root[i] != root[j]:
                old, new = max(root[i], root[j]), min(root[i], root[j])
                root = [new if r == old else r for r in root]
    return sorted(set(root))


def edited(rng, words, share):
    """Words of which about a share of the five-word shingles is changed."""
    out = list(words)
    for at in rng.sample(range(0, len(out), 5), max(1, round(share * len(out) / 5))):
        out[at] = f"new{rng.random()}"
    return out


def test_copies_with_changed_shingles_leave_one(spark, tmp_path):
    rng = random.Random(2)
    texts, groups = [], 0
    for share in (0.01, 0.03, 0.05, 0.08, 0.1, 0.15, 0.2):
        for _ in range(3):
            words = [f"w{rng.randrange(5000)}" for _ in range(400)]
            texts += [" ".join(words), " ".join(edited(rng, words, share))]
            groups += 1
    expected = slow_kept(texts)
    assert groups <= len(expected) < len(texts)
    docs = documents(spark, tmp_path, texts)
    kept = near_copies.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(row.doc_id for row in kept.collect()) == expected
    stage = corpus_pipeline.near_dedup(spark, docs, str(tmp_path))
    assert sorted(row.doc_id for row in stage.collect()) == expected


def test_large_groups_and_chains_like_brute_force(spark, tmp_path):
    """Many copies of one base, a chain of small edits and texts with a common passage."""
    rng = random.Random(4)
    base = [f"w{rng.randrange(900)}" for _ in range(120)]
    texts = [" ".join(edited(rng, base, rng.choice([0.04, 0.1, 0.2]))) for _ in range(90)]
    for _ in range(15):
        base = edited(rng, base, 0.08)
        texts.append(" ".join(base))
    passage = " ".join(f"p{i}" for i in range(60))
    texts += [f"{passage} " + " ".join(f"q{rng.random()}" for _ in range(rng.choice([8, 30]))) for _ in range(60)]
    texts += ["", None, "a b c", "A  b c", "a b d"]
    kept = near_copies.keep_one(documents(spark, tmp_path, texts)).collect()
    assert sorted(row.doc_id for row in kept) == slow_kept(texts)


def test_odd_rows(spark, tmp_path):
    kept = near_copies.keep_one(stored(spark, tmp_path, ODD, DOCS)).collect()
    assert sorted(row.doc_id for row in kept if row.doc_id is not None) == [1, 2, 5, 7]
    assert sum(row.doc_id is None for row in kept) == 1
    assert near_copies.keep_one(stored(spark, tmp_path, [], name="none")).collect() == []


def test_linked_fingerprints_make_candidates(spark):
    """Classes meet the least one of their fingerprint's component, without any common key."""
    rows = [(1, 0b0), (2, 0b11), (3, 0b1111), (4, -1), (5, -1), (6, 0b101010101 << 20)]
    found = near_copies.by_fingerprint(spark.createDataFrame(rows, "id long, fp long")).collect()
    assert sorted((row.a, row.b) for row in found) == [(1, 2), (1, 3), (4, 5)]


def test_classes_of_one_fingerprint_all_meet(spark, tmp_path):
    """Texts that one repeated passage gives one fingerprint, without any key: copies far from the least class link too."""
    rng = random.Random(6)
    passage = " ".join(f"p{i}" for i in range(11))
    texts = []
    for _ in range(6):
        tail = [f"t{rng.random()}" for _ in range(60)]
        texts += [f"{passage} " * 60 + " ".join(tail), f"{passage} " * 60 + " ".join([*tail[:-1], "other"])]
    assert len({near_copies.fingerprint_of(text.encode(), 5) for text in texts}) == 1
    kept = near_copies.keep_one(documents(spark, tmp_path, texts), bands=0).collect()
    assert sorted(row.doc_id for row in kept) == slow_kept(texts) == list(range(0, 12, 2))


def test_pairs_of_groups_at_most_two_bits_apart(spark):
    rng = random.Random(7)
    base = [rng.getrandbits(63) for _ in range(3)]
    rows = [(i, rng.choice(base) ^ sum(1 << b for b in rng.sample(range(63), rng.randrange(4)))) for i in range(60)]
    members = [(i, i % 4) for i, _ in rows if i % 5]
    root = dict(members)
    expected = {
        (a, b, root.get(a, a), root.get(b, b))
        for a, x in rows
        for b, y in rows
        if a < b and (x ^ y).bit_count() <= 2 and root.get(a, a) != root.get(b, b)
    }
    placed = near_copies.islands(spark.createDataFrame(rows, "id long, fp long"))
    found = near_copies.apart(placed, spark.createDataFrame(members, "id long, root long"))
    assert expected and sorted(map(tuple, found.select("a", "b", "root_a", "root_b").collect())) == sorted(expected)
