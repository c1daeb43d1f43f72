"""Boosted trees against hand-computed leaves, brute-force splits and the best constant."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from restock.operators import boosting
from restock.operators.boosting import BoostingOptions, Grower, Tree
from restock.session import steps

WHOLE = {"row_share": 1.0, "column_share": 1.0, "learning_rate": 1.0}


def brute_sums(binned, g, h, bins):
    """``ask`` over arrays, with the number of scans."""

    def ask(tree: Tree, nodes: list[int]) -> np.ndarray:
        ask.scans += 1
        at = tree.nodes_of(binned)
        out = np.zeros((len(nodes), 2, binned.shape[1], bins))
        for i, node in enumerate(nodes):
            for row in np.flatnonzero(at == node):
                for column in range(binned.shape[1]):
                    out[i, :, column, binned[row, column]] += g[row], h[row]
        return out

    ask.scans = 0
    return ask


def leaf_sets(tree, binned):
    at = tree.nodes_of(binned)
    return {frozenset(np.flatnonzero(at == node).tolist()) for node in set(at.tolist())}


def brute_gain(rows, side, g, h, l2, least):
    left, right = rows & side, rows & ~side
    if h[left].sum() < least or h[right].sum() < least:
        return -np.inf
    score = lambda part: g[part].sum() ** 2 / (h[part].sum() + l2)
    return score(left) + score(right) - score(rows)


@pytest.fixture()
def data():
    chance = np.random.default_rng(3)
    binned = chance.integers(0, 6, (220, 3)).astype(np.uint8)
    g = (binned[:, 0] > 2) * 2.0 - (binned[:, 1] > 3) * (binned[:, 2] > 1) * 3.0 + chance.normal(0, 0.4, 220)
    return binned, g, chance.uniform(0.5, 1.5, 220)


def cuts(binned):
    return [(f, c, binned[:, f] <= c) for f in range(binned.shape[1]) for c in range(5)]


@pytest.mark.parametrize("depth", [1, 2, 3])
def test_symmetric_trees_take_the_split_with_the_largest_total_gain(data, depth):
    binned, g, h = data
    options = BoostingOptions(growth="symmetric", depth=depth, bins=6)
    ask = brute_sums(binned, g, h, 6)
    tree = boosting._symmetric(Grower(options, np.ones(3, bool), ask))
    groups = [np.ones(220, bool)]
    for _ in range(depth):
        total = [sum(max(0.0, brute_gain(rows, side, g, h, 1.0, 1.0)) for rows in groups) for _, _, side in cuts(binned)]
        side = cuts(binned)[int(np.argmax(total))][2]
        groups = [part for rows in groups for part in (rows & side, rows & ~side)]
    assert leaf_sets(tree, binned) == {frozenset(np.flatnonzero(rows).tolist()) for rows in groups if rows.any()}
    assert ask.scans == depth


@pytest.mark.parametrize("leaves", [2, 5, 9])
def test_best_first_trees_split_the_leaf_with_the_largest_gain(data, leaves):
    binned, g, h = data
    options = BoostingOptions(growth="best_first", depth=8, leaves=leaves, bins=6)
    ask = brute_sums(binned, g, h, 6)
    tree = boosting._best_first(Grower(options, np.ones(3, bool), ask))
    groups = [np.ones(220, bool)]
    for _ in range(leaves - 1):
        found = [(brute_gain(rows, side, g, h, 1.0, 1.0), -i, -j) for i, rows in enumerate(groups) for j, (_, _, side) in enumerate(cuts(binned))]
        _, i, j = max(found)
        rows, side = groups.pop(-i), cuts(binned)[-j][2]
        groups += [rows & side, rows & ~side]
    assert leaf_sets(tree, binned) == {frozenset(np.flatnonzero(rows).tolist()) for rows in groups}
    assert tree.feature.count(-1) == leaves and ask.scans <= leaves


def test_level_trees_like_best_first_without_a_limit(data):
    binned, g, h = data
    grown = {}
    for growth in ("level", "best_first"):
        options = BoostingOptions(growth=growth, depth=3, leaves=99, bins=6)
        grown[growth] = boosting.GROWTH[growth](Grower(options, np.ones(3, bool), brute_sums(binned, g, h, 6)))
    assert leaf_sets(grown["level"], binned) == leaf_sets(grown["best_first"], binned)
    np.testing.assert_allclose(grown["level"].values_of(binned), grown["best_first"].values_of(binned))


def frame(spark, rows):
    return spark.createDataFrame(rows, "x double, z double, y double, w double")


def test_first_round_equals_hand_computed_leaves(spark):
    """Tweedie of power 1.4: Newton steps of two leaves from the mean, no shrinkage but l2."""
    rows = [(0.0, 1.0, 0.0, 1.0)] * 30 + [(0.0, 1.0, 2.0, 1.0)] * 10 + [(1.0, 1.0, 6.0, 1.0)] * 30 + [(1.0, 1.0, 1.0, 1.0)] * 5
    options = BoostingOptions(trees=1, depth=1, **WHOLE)
    model = boosting.fit(frame(spark, rows), ["x", "z"], F.col("y"), F.col("w"), options)
    y = np.array([row[2] for row in rows])
    m, x = np.log(y.mean()), np.array([row[0] for row in rows])
    g = np.exp(0.6 * m) - y * np.exp(-0.4 * m)
    h = 0.6 * np.exp(0.6 * m) + 0.4 * y * np.exp(-0.4 * m)
    assert model.base == pytest.approx(m)
    assert [tree.feature for tree in model.trees] == [[0, -1, -1]]
    expected = [-g[x == side].sum() / (h[x == side].sum() + 1) for side in (0.0, 1.0)]
    assert model.trees[0].value[1:] == pytest.approx(expected)
    predicted = frame(spark, rows).select("x", model.response([F.col("x"), F.col("z")]).alias("p")).distinct().collect()
    assert {row.x: row.p for row in predicted} == pytest.approx({side: y.mean() * np.exp(e) for side, e in zip((0.0, 1.0), expected, strict=True)})


@pytest.mark.parametrize("bound", [None, 1.0, 0.3])
def test_steps_are_bounded_on_a_leaf_of_zeros(spark, bound):
    rows = [(0.0, 1.0, 0.0, 1.0)] * 400 + [(1.0, 1.0, 40.0, 1.0)] * 100
    options = BoostingOptions("poisson", trees=1, depth=1, l2=0.0, max_step=bound, **WHOLE)
    zeros, large = boosting.fit(frame(spark, rows), ["x"], F.col("y"), F.col("w"), options).trees[0].value[1:]
    assert zeros == pytest.approx(-(bound or 1.0)) and large == pytest.approx(min(bound or 4.0, 4.0))


@pytest.mark.parametrize("growth", ["level", "symmetric", "best_first"])
@pytest.mark.parametrize("objective", ["tweedie", "poisson"])
def test_held_out_deviance_is_below_the_constant_and_the_stand_in(spark, objective, growth):
    """Counts with many zeros; the stand-in are trees on log(1 + y) with weights, as far as squared error goes."""
    chance = np.random.default_rng(7)
    x, z = chance.uniform(0, 1, (2, 3000))
    y = chance.poisson(np.exp(2 * x - 1) * (z > 0.4)) * chance.gamma(2.0, 0.5, 3000).round(2)
    df = frame(spark, [tuple(map(float, row)) for row in zip(x, z, y, np.ones(3000), strict=True)])
    train, held = df.filter("x * 1000 % 10 < 7"), df.filter("x * 1000 % 10 >= 7")
    options = BoostingOptions(objective, growth=growth, trees=20, depth=3, leaves=8, learning_rate=0.3)
    model = boosting.fit(train, ["x", "z"], F.col("y"), F.col("w"), options)
    own = held.withColumn("p", model.response([F.col("x"), F.col("z")]))
    mean = train.agg(F.avg("y")).first()[0]
    vector = VectorAssembler(inputCols=["x", "z"], outputCol="f")
    power = 1.0 if objective == "poisson" else 1.4
    weighed = train.withColumns({"l": F.log1p("y"), "v": F.pow(F.col("y") + 1, F.lit(2 - power))})
    other = GBTRegressor(featuresCol="f", labelCol="l", weightCol="v", maxIter=20, maxDepth=3, stepSize=0.3, predictionCol="q").fit(vector.transform(weighed))
    stand_in = other.transform(vector.transform(held)).withColumn("p", F.greatest(F.expm1("q"), F.lit(0.0)))
    loss = lambda rows, p: rows.agg(F.sum(boosting.deviance(objective, F.col("y"), p))).first()[0]
    assert loss(own, F.col("p")) < 0.9 * loss(own, F.lit(mean))
    assert loss(own, F.col("p")) < loss(stand_in, F.col("p"))


def test_no_rows_null_labels_and_reading_back(spark):
    none = frame(spark, []).filter("x > 0")
    for objective, value in (("tweedie", 0.0), ("squared", 0.0), ("logistic", 0.5)):
        model = boosting.fit(none, ["x"], F.col("y"), F.col("w"), BoostingOptions(objective))
        assert spark.range(1).select(model.response([F.lit(3.0)]).alias("p")).first().p == value
    rows = [(float(i % 9), 1.0, None if i % 5 == 0 else float(i % 4), 1.0 if i % 7 else 0.0) for i in range(300)]
    model = boosting.fit(frame(spark, rows), ["x", "z"], F.col("y"), F.col("w"), BoostingOptions("squared", trees=12, depth=2))
    again = boosting.Boosted.from_json(model.to_json())
    both = frame(spark, rows).select(model.response([F.col("x"), F.col("z")]).alias("a"), again.response([F.col("x"), F.col("z")]).alias("b"))
    assert len(model.trees) == 12 and all(row.a == row.b for row in both.collect())


def test_shares_of_rows_are_kept_and_differ_by_tree():
    place = np.random.default_rng(1).integers(-(2**63), 2**63 - 1, 20_000)
    taken = [boosting.sampled(place, 0.7, seed) for seed in (42, 43)]
    assert all(abs(part.mean() - 0.7) < 0.02 for part in taken)
    assert 0.4 < (taken[0] & taken[1]).mean() < 0.58


def test_unknown_options_are_refused():
    for wrong in ({"objective": "hinge"}, {"growth": "random"}, {"bins": 300}):
        with pytest.raises(ValueError):
            BoostingOptions(**wrong)


def looked_up(tree, binned):
    """The node of every row, one row and level at a time."""
    found = []
    for row in binned:
        node = 0
        while tree.feature[node] >= 0:
            node = tree.left[node] if row[tree.feature[node]] <= tree.cut[node] else tree.right[node]
        found.append(node)
    return found


@pytest.mark.parametrize("splits", [0, 1, 30, 200])
def test_nodes_are_found_by_comparing_whole_inputs(splits):
    """Trees of any shape, of more than 255 nodes too; rows of an input may lie together or apart."""
    chance = np.random.default_rng(splits)
    tree = Tree()
    leaves = [tree.add(0.0)]
    for _ in range(splits):
        leaf = leaves.pop(chance.integers(len(leaves)))
        leaves += tree.split(leaf, int(chance.integers(4)), int(chance.integers(255)), tuple(chance.normal(size=2)))
    binned = chance.integers(0, 256, (500, 4)).astype(np.uint8)
    expected = looked_up(tree, binned)
    for layout in (binned, np.asfortranarray(binned), binned[:0]):
        assert tree.nodes_of(layout).tolist() == expected[: len(layout)]
        assert tree.values_of(layout).tolist() == [tree.value[node] for node in expected[: len(layout)]]


def test_scans_pass_over_the_rows_of_an_input_in_place():
    """Blocks keep every input's rows together, however they were cut."""
    rows = boosting.BLOCK_ROWS + 5
    binned = np.random.default_rng(5).integers(0, 9, (rows, 3)).astype(np.uint8)
    numbers = [np.arange(rows) * 1.0, np.ones(rows), np.zeros(rows), np.arange(rows)]
    read = list(boosting._rows(iter([boosting._blocks([binned, *numbers])]), 3))
    assert all(part[0].flags.f_contiguous for part in read)
    for i, whole in enumerate([binned, *numbers]):
        assert (np.concatenate([part[i] for part in read]) == whole).all()
    assert boosting.bins_of([np.array([0.5, 2.0])] * 2, [[1.0], [1.0, 1.5]]).flags.f_contiguous


@pytest.mark.parametrize("label", [1.0, None])
def test_a_fit_leaves_no_written_rows(spark, label):
    rows = spark.createDataFrame([(float(i % 7), label) for i in range(300)], "x double, y double")
    before, split = steps(spark), spark.conf.get("spark.sql.files.maxPartitionBytes")
    boosting.fit(rows, ["x"], F.col("y"), F.lit(1.0), BoostingOptions("squared", trees=12, depth=2))
    assert steps(spark) == before
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == split
