import random

from cases import ODD, documents, stored
from hypothesis import given, settings
from hypothesis import strategies as st

from restock.llm import decontamination
from restock.llm.decontamination import best_end, budget, pieces, words_of


def slow_ends(pattern, window):
    """Least distance of the pattern to a stretch that ends at each place."""
    row = list(range(len(pattern) + 1))
    ends = []
    for word in window:
        new = [0]
        for i, p in enumerate(pattern, 1):
            new.append(min(row[i - 1] + (p != word), row[i] + 1, new[i - 1] + 1))
        row = new
        ends.append(row[-1])
    return ends


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("abcd"), min_size=1, max_size=80), st.lists(st.sampled_from("abcd"), max_size=60), st.integers(0, 8))
def test_bit_parallel_distance(pattern, window, limit):
    ends = slow_ends(pattern, window)
    low = min(ends, default=99)
    expected = (low, ends.index(low) + 1) if low <= limit else None
    assert best_end(pattern, window, limit) == expected


def test_pieces_cover_an_item():
    for size in range(1, 60):
        cut = pieces(size, budget(size) + 1)
        assert [i for a, b in cut for i in range(a, b)] == list(range(size)) and all(a < b for a, b in cut)


def benchmark(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def fixture():
    rng = random.Random(2)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randint(2, 5)))
    items = [[word() for _ in range(rng.randint(3, 40))] for _ in range(15)]
    texts = []
    for _ in range(120):
        text = [word() for _ in range(rng.randint(0, 60))]
        if rng.random() < 0.7:
            item = list(rng.choice(items))
            for _ in range(rng.randint(0, 9)):
                place = rng.randrange(len(item))
                item[place : place + rng.choice([0, 1])] = rng.choice([[], [word()]])
                item = item or ["x"]
            at = rng.randint(0, len(text))
            text[at:at] = item
        texts.append(", ".join(text).title())
    return [" ".join(item) for item in items], texts


def test_hits_like_brute_force(spark, tmp_path):
    items, texts = fixture()
    docs, bench = documents(spark, tmp_path, texts), benchmark(spark, list(enumerate(items)))
    expected = set()
    for d, text in enumerate(texts):
        for i, item in enumerate(items):
            pattern = words_of(item)
            low = min(slow_ends(pattern, words_of(text)), default=99)
            if low <= budget(len(pattern)):
                expected.add((d, i, low))
    for block_bytes in (1 << 20, 100):
        rows = decontamination.occurrences(docs, bench, block_bytes=block_bytes).collect()
        assert {(row.doc_id, row.item_id, row.distance) for row in rows} == expected and len(rows) == len(expected)
        for row in rows:
            part = words_of(texts[row.doc_id])[row.start : row.end]
            assert slow_ends(words_of(items[row.item_id]), part)[-1] >= row.distance
        clean = decontamination.clean(docs, bench, block_bytes=block_bytes)
        assert clean.columns == docs.columns
        assert {row.doc_id for row in clean.collect()} == set(range(len(texts))) - {d for d, _, _ in expected}


def test_odd_rows_and_items(spark, tmp_path):
    docs = stored(spark, tmp_path, ODD)
    bench = benchmark(
        spark,
        [(1, "two three four FIVE six seven eight"), (2, None), (3, ""), (None, "one two"), (4, "two, three. four five six seven eight"), (5, "!!")],
    )
    rows = decontamination.occurrences(docs, bench).collect()
    assert sorted((row.doc_id, row.item_id, row.distance) for row in rows) == sorted([(1, 1, 0), (1, 4, 0)] * 2 + [(6, 1, 0), (6, 4, 0)])
    assert decontamination.clean(docs, bench).count() == len(ODD) - 3


def test_empty_tables(spark, tmp_path):
    docs, none = stored(spark, tmp_path, ODD), benchmark(spark, [])
    found = decontamination.occurrences(docs, none)
    assert found.columns == ["doc_id", "item_id", "distance", "start", "end"] and found.collect() == []
    assert decontamination.clean(docs, none).count() == len(ODD)
    assert decontamination.occurrences(stored(spark, tmp_path, [], name="none"), benchmark(spark, [(1, "a b")])).collect() == []
