import hashlib
import random
import zlib

import pytest
from cases import stored

from restock.llm import prefix_trie

TURNS = "conv_id long, turn long, role string, text string, path string, shard int, n long"


def rebuilt(rows):
    """conv_id to its rebuilt turns, straight from the contract."""
    own = {}
    for conv, turn, role, text, *_ in rows:
        own.setdefault(conv, []).append((turn, role or "", text or ""))
    key = lambda t: hashlib.md5(f"{len(t[1])}:{t[1]}{t[2]}".encode()).hexdigest()
    for conv, turns in own.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1], key(t)))
        own[conv] = [(role, text) for _, role, text in turns]
    out = {}
    for conv, turns in own.items():
        h = 0 if conv is None else zlib.crc32(str(conv).encode()) % 6
        head = [] if conv is None else own.get(int(conv / 100) * 100, [])
        out[conv] = tuple(head[:h] + turns[h:])
    return out


def slow(rows):
    paths = rebuilt(rows)
    members = {}
    for conv, path in paths.items():
        for depth in range(len(path) + 1):
            members.setdefault(path[:depth], []).append(conv)
    parents = {prefix: prefix[:-1] for prefix in members if prefix}
    low = lambda convs: min((c for c in convs if c is not None), default=None)
    inner, out = set(parents.values()), []
    for prefix, convs in members.items():
        below = [p for p in members if p[: len(prefix)] == prefix]
        leaves = [p for p in below if p not in inner]
        saved = sum((len(members[p]) - 1) * len(p[-1][1]) for p in below if p)
        ends = ",".join(str(c) for c in sorted(c for c in convs if c is not None and len(paths[c]) == len(prefix)))
        parent = low(members[prefix[:-1]]) if prefix else None
        children = sum(1 for p in parents.values() if p == prefix)
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((low(convs), len(prefix), parent, len(convs), children, len(leaves), saved, digest))
    return sorted(out, key=str)


def found(df, shards=None):
    rows = prefix_trie.nodes(prefix_trie.rebuilt(prefix_trie.paths(df)), shards).collect()
    return sorted((tuple(row) for row in rows), key=str)


def conversations(seed, ids, vocabulary=3, most=9):
    rng = random.Random(seed)
    rows = []
    for conv in ids:
        turns = [(rng.choice(["user", "assistant"][: 1 + i % 2]), f"t{rng.randrange(vocabulary)}" * rng.choice([1, 1, 5])) for i in range(rng.randint(1, most))]
        rows += [(conv, i, role, text, "x", 1, 1) for i, (role, text) in enumerate(turns)]
    return rows


@pytest.mark.parametrize("shards", [1, 2, 7, 23])
def test_like_brute_force_at_any_number_of_shards(spark, tmp_path, shards):
    rows = conversations(shards, [*range(0, 130), *range(300, 340), 999])
    assert found(stored(spark, tmp_path, rows, TURNS), shards) == slow(rows)


def test_copies_and_long_common_paths(spark, tmp_path):
    """Hundreds of equal conversations, and long ones that part late, over many shards."""
    rows = [(c, t, "user", f"same {t}", "x", 1, 1) for c in range(0, 60) for t in range(4)]
    rows += [(200 + c, t, "user", f"long {t}" if t < 30 + c % 5 else f"{c} {t}", "x", 1, 1) for c in range(0, 30) for t in range(36)]
    assert found(stored(spark, tmp_path, rows, TURNS), 9) == slow(rows)


def test_odd_rows(spark, tmp_path):
    rows = [
        (0, 1, "user", "a", "x", 1, 1),
        (0, None, None, "first", "x", 1, 1),
        (0, 2, "user", None, None, 1, 1),
        (0, 2, "user", None, None, 1, 1),
        (1, 5, "", "", "x", 1, 1),
        (2, 0, "user", "é\U0001f600" * 20_000, "x", 1, 1),
        (None, 0, "user", "no id", "x", 1, 1),
        (None, 1, "user", "no id", "x", 1, 1),
        (-7, 0, "user", "a", "x", 1, 1),
        (512, 0, "user", "a", "x", 1, 1),
    ]
    df = stored(spark, tmp_path, rows, TURNS)
    assert found(df) == slow(rows)
    assert found(df, 5) == slow(rows)
    assert found(df.limit(0)) == []


def test_only_a_row_without_id(spark, tmp_path):
    rows = [(None, 0, "user", "x", "x", 1, 1)]
    assert found(stored(spark, tmp_path, rows, TURNS)) == slow(rows)


def test_first_shards_of_skeleton_nodes():
    # Shards 0 to 3: the last path of 0 shares three turns with 1, which holds one run of paths, and so on.
    shape = [(0, 3, 1), (1, 5, 2), (2, 0, 1), (3, -1, 0)]
    assert prefix_trie._starts(shape) == [[], [(3, 0)], [(2, 0), (5, 1)], [(0, 0)]]


def test_pieces_of_ids_cross_batches(spark):
    ids = [(10**6 + 3 * i,) for i in range(9000)]
    df = spark.createDataFrame(ids, "conv_id long").selectExpr("conv_id", "'p' AS path")
    ends = prefix_trie._ends(df).collect()
    expected = hashlib.sha256(",".join(str(i) for (i,) in ids).encode()).hexdigest()
    assert [row.ends for row in ends] == [expected]
