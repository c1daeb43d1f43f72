from collections import Counter, defaultdict
from fractions import Fraction

from cases import DOCS, ODD, stored
from hypothesis import given, settings
from hypothesis import strategies as st

from restock.llm import mixing


def test_documents_get_one_slot_each(spark, tmp_path):
    rows = [(i, "big" if i % 3 else f"s{i % 5}") for i in range(3000)]
    docs = stored(spark, tmp_path, rows, "doc_id long, source string")
    weights = {"big": 0.2, "s0": 0.4, "s1": 0.2, "s2": 0.1, "s3": 0.1}
    out = mixing.mixed(docs, weights, block_rows=10).collect()
    assert sorted(row.doc_id for row in out) == list(range(3000))
    by_slot = defaultdict(set)
    for row in out:
        by_slot[row.mix_slot].add((row.source, row.mix_block))
        assert row.mix_release <= row.mix_slot < row.mix_deadline
    assert sorted(by_slot) == list(range(len(by_slot))) and all(len(blocks) == 1 for blocks in by_slot.values())
    assert max(Counter(row.mix_slot for row in out).values()) == 10
    first = [slot for slot in sorted(by_slot) if any(r.mix_slot == slot and r.mix_phase == 0 for r in out)]
    for source, weight in {**weights, "s4": 0}.items():
        done = 0
        for n, slot in enumerate(first, 1):
            done += next(iter(by_slot[slot]))[0] == source
            # Shares are whole numbers of a thousand slots.
            assert abs(done - n * weight) < 1 + n * 0.004


def test_odd_rows(spark, tmp_path):
    rows = [(*row, 3, 4, 5, 6, 7, "x") for row in ODD]
    schema = f"{DOCS}, mix_slot int, _source int, phase int, _before int, share int, _plan string"
    docs = stored(spark, tmp_path, rows, schema)
    out = mixing.mixed(docs, block_rows=1)
    assert sorted(row.mix_slot for row in out.collect()) == list(range(len(ODD)))
    assert set(docs.columns) - {"mix_slot"} < set(out.columns)


def test_empty_table(spark, tmp_path):
    assert mixing.mixed(stored(spark, tmp_path, [])).collect() == []


def check_exact(blocks, weights):
    """Every block once, and less than one block from the exact weight at every slot of a phase."""
    rows = list(mixing.placed(blocks, weights))
    assert [row[2] for row in rows] == list(range(sum(blocks.values())))
    for source, count in blocks.items():
        assert [row[1] for row in rows if row[0] == source] == list(range(count))
    left = {source: count for source, count in blocks.items() if count}
    at = 0
    while at < len(rows):
        phase = [row for row in rows[at:] if row[3] == rows[at][3]]
        wanted = {s: Fraction(weights.get(s, 0)) for s in left if weights.get(s, 0) > 0} or dict.fromkeys(left, 1)
        total, done = sum(wanted.values()), dict.fromkeys(wanted, 0)
        for n, (source, _, slot, _, release, deadline) in enumerate(phase, 1):
            done[source] += 1
            assert release <= slot < deadline
            assert all(abs(done[s] * total - n * wanted[s]) < total for s in wanted)
        left = {s: count - done.get(s, 0) for s, count in left.items() if count > done.get(s, 0)}
        at += len(phase)


def test_the_deviation_does_not_grow_with_the_rows():
    small = {f"s{i}": 0.1 / 9 for i in range(9)}
    check_exact({"big": 9000, **{name: 111 for name in small}}, {"big": 0.9, **small})
    check_exact({"big": 5000, **{f"s{i}": 500 for i in range(20)}}, {"big": 1 / 3, **{f"s{i}": 1 / 30 for i in range(20)}})


@settings(max_examples=60, deadline=None)
@given(
    st.dictionaries(st.sampled_from("abcdefgh"), st.integers(0, 60), min_size=1),
    st.dictionaries(st.sampled_from("abcdefgh"), st.floats(0, 3)),
)
def test_exact_windows_in_all_phases(blocks, weights):
    check_exact(blocks, weights)


def test_more_than_a_thousand_sources(spark, tmp_path):
    docs = stored(spark, tmp_path, [(i, f"host{i % 2500}") for i in range(6000)], "doc_id long, source string")
    out = mixing.mixed(docs, block_rows=2).collect()
    assert sorted(row.doc_id for row in out) == list(range(6000))
    assert len({row.mix_slot for row in out}) == 3500
    assert all(row.mix_release <= row.mix_slot < row.mix_deadline for row in out)
