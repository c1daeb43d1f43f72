"""Gradient boosted trees of the second order, fitted from sums that Spark adds up.

Every row carries gradient and hessian of the loss at its margin, the score on the scale of the link.
A tree is grown from one table of (node, feature, bin) sums of both: each task adds up its own rows,
Spark adds up the tasks, and the driver, which holds the sums of one tree and never a row, chooses
splits. A split gains GL² / (HL + l2) + GR² / (HR + l2) - G² / (H + l2); a leaf's step is -G / (H + l2),
the Newton step, kept to ``max_step`` where one is given. Of two siblings only the one with the smaller
hessian is summed, the other is the difference to the parent.

Three ways to grow: ``level`` splits every node of a level by its own best split; ``symmetric`` splits
all nodes of a level by the one split with the largest total gain; ``best_first`` always splits the leaf
with the largest gain, up to a number of leaves. Each of them scans the rows once for each level: for
best-first trees the children of all open leaves are summed ahead, in one scan.

Inputs are cut into at most 256 bins at quantiles; a row is kept as one byte an input, its label,
weight and margin, and rows are kept in blocks. Each tree sees a share of the rows, chosen by a hash of the row, and of the inputs.
Margins are written anew after ``REFRESH`` trees, so a scan applies few trees. What comes to the driver
is bounded by nodes, inputs and bins, whatever the number of rows.

Defined cases: a row of a null input belongs to the first bin of a column without nulls in training
(inputs are filled before). Rows without a label or with weight 0 count for nothing. No rows give a model
without trees that predicts 0, or one half for ``logistic``.
"""

from __future__ import annotations

import heapq
import json
import math
from collections.abc import Callable, Iterator
from dataclasses import asdict, dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from restock.session import materialise, remove_read, settings_for

LOG_LINK = ("tweedie", "poisson")
OBJECTIVES = (*LOG_LINK, "squared", "logistic")
REFRESH = 10
_LEAST = 1e-6
_NOISE = 1e-9


@dataclass(frozen=True)
class BoostingOptions:
    objective: str = "tweedie"
    variance_power: float = 1.4
    growth: str = "level"
    trees: int = 20
    depth: int = 5
    leaves: int = 31
    bins: int = 32
    learning_rate: float = 0.1
    l2: float = 1.0
    min_hessian: float = 1.0
    max_step: float | None = None
    row_share: float = 0.9
    column_share: float = 0.9
    seed: int = 42

    def __post_init__(self) -> None:
        if self.objective not in OBJECTIVES:
            raise ValueError(f"unknown objective {self.objective}")
        if self.growth not in GROWTH:
            raise ValueError(f"unknown growth {self.growth}")
        if not 2 <= self.bins <= 256:
            raise ValueError("bins must be 2 to 256")


def gradients(options: BoostingOptions, label: np.ndarray, margin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivative of the loss by the margin."""
    if options.objective == "squared":
        return margin - label, np.ones_like(margin)
    if options.objective == "logistic":
        chance = 1 / (1 + np.exp(-margin))
        return chance - label, np.maximum(chance * (1 - chance), _LEAST)
    power = 1.0 if options.objective == "poisson" else options.variance_power
    low, high = np.exp((1 - power) * margin), np.exp((2 - power) * margin)
    return high - label * low, (2 - power) * high - (1 - power) * label * low


def base_margin(objective: str, mean: float) -> float:
    """The margin of a constant prediction."""
    if objective == "squared":
        return mean
    if objective == "logistic":
        chance = min(max(mean, _LEAST), 1 - _LEAST)
        return math.log(chance / (1 - chance))
    return math.log(max(mean, _LEAST))


def response(objective: str, margin: np.ndarray) -> np.ndarray:
    if objective == "squared":
        return margin
    return 1 / (1 + np.exp(-margin)) if objective == "logistic" else np.exp(margin)


def deviance(objective: str, label: Column, prediction: Column, power: float = 1.4) -> Column:
    """Deviance of one row; predictions of a log link are kept above zero."""
    if objective == "squared":
        return (label - prediction) ** 2
    mean = F.greatest(prediction, F.lit(_LEAST))
    if objective == "logistic":
        chance = F.least(mean, F.lit(1 - _LEAST))
        return -2 * (label * F.log(chance) + (1 - label) * F.log(1 - chance))
    if objective == "poisson":
        return 2 * (F.when(label > 0, label * F.log(label / mean)).otherwise(0.0) - (label - mean))
    own = F.pow(F.greatest(label, F.lit(0.0)), F.lit(2 - power)) / ((1 - power) * (2 - power))
    return 2 * (own - label * F.pow(mean, F.lit(1 - power)) / (1 - power) + F.pow(mean, F.lit(2 - power)) / (2 - power))


@dataclass
class Tree:
    """Nodes by number, the root first; ``feature`` is -1 in a leaf. A bin up to ``cut`` goes left."""

    feature: list[int] = field(default_factory=list)
    cut: list[int] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)

    def add(self, value: float) -> int:
        for values, first in zip((self.feature, self.cut, self.left, self.right), (-1, 0, 0, 0), strict=True):
            values.append(first)
        self.value.append(value)
        return len(self.value) - 1

    def split(self, node: int, feature: int, cut: int, values: tuple[float, float]) -> tuple[int, int]:
        self.feature[node], self.cut[node] = feature, cut
        self.left[node], self.right[node] = self.add(values[0]), self.add(values[1])
        return self.left[node], self.right[node]

    def nodes_of(self, binned: np.ndarray) -> np.ndarray:
        """The node that each row ends in.

        Every split is compared for all rows at once and its two sides are mixed by bits: passes over
        short whole numbers in place of a look-up a row and level. Quickest if inputs lie together.
        """
        number = np.min_scalar_type(len(self.feature))

        def ends(node: int) -> np.ndarray | np.generic:
            if self.feature[node] < 0:
                return number.type(node)
            left, right = ends(self.left[node]), ends(self.right[node])
            goes_left = (binned[:, self.feature[node]] <= self.cut[node]).astype(number)
            return right ^ (np.negative(goes_left) & (left ^ right))

        return np.broadcast_to(ends(0), len(binned))

    def values_of(self, binned: np.ndarray) -> np.ndarray:
        return np.array(self.value).take(self.nodes_of(binned))


@dataclass
class Boosted:
    """A fitted model: cut points of its inputs, trees, and the margin it starts from."""

    options: BoostingOptions
    columns: list[str]
    cuts: list[list[float]]
    base: float
    trees: list[Tree] = field(default_factory=list)

    def response(self, inputs: list[Column]) -> Column:
        """The prediction as a column, on the scale of the label."""
        cuts, trees, base, objective = self.cuts, self.trees, self.base, self.options.objective

        def predict(*values: pd.Series) -> pd.Series:
            binned = bins_of([v.to_numpy(np.float64) for v in values], cuts)
            margin = np.full(len(binned), base)
            for tree in trees:
                margin += tree.values_of(binned)
            return pd.Series(response(objective, margin))

        return F.pandas_udf(predict, T.DoubleType())(*inputs)

    def to_json(self) -> str:
        return json.dumps({**self.__dict__, "options": asdict(self.options), "trees": [asdict(tree) for tree in self.trees]})

    @classmethod
    def from_json(cls, text: str) -> Boosted:
        about = json.loads(text)
        options, trees = BoostingOptions(**about.pop("options")), [Tree(**tree) for tree in about.pop("trees")]
        return cls(options, trees=trees, **about)


def bins_of(values: list[np.ndarray], cuts: list[list[float]]) -> np.ndarray:
    """Per row and input the number of cut points below the value; the rows of an input lie together."""
    out = np.empty((len(values[0]) if values else 0, len(cuts)), np.uint8, order="F")
    for i, (column, points) in enumerate(zip(values, cuts, strict=True)):
        out[:, i] = np.searchsorted(points, column, side="left")
    return out


def cut_points(rows: DataFrame, columns: list[str], bins: int) -> list[list[float]]:
    """Quantiles of every column, from one scan.

    They lie a little above the values, so that the rounding noise of sums added in another order does not
    part rows of equal values.
    """
    shares = [i / bins for i in range(1, bins)]
    found = rows.agg(*[F.percentile_approx(name, shares, 10_000).alias(f"q{i}") for i, name in enumerate(columns)]).first()
    return [sorted({value + _NOISE * (1 + abs(value)) for value in values or []}) for values in found]


# Rows as trees see them, in blocks: one byte an input and row, and the numbers of all rows of the block. A
# task then gets a few large values instead of many small rows.
_BLOCKS = "bins binary, label binary, weight binary, margin binary, place binary"
_NUMBERS = (np.float64, np.float64, np.float64, np.int64)
_CELLS = "cell long, g double, h double"
# Rows of a block, and blocks that are worked on at a time.
BLOCK_ROWS = 1024
_TOGETHER = 16
# Blocks take as many bytes in memory as their rows have inputs, so unlike facts they can be read in Spark's usual parts, a
# few tasks a core, as long as a task gets few of them at a time.
_SCANS = {"spark_sql_files_maxPartitionBytes": "64m", "spark_sql_execution_arrow_maxRecordsPerBatch": str(4 * _TOGETHER)}


def _batch(columns: dict[str, np.ndarray | pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(values) for values in columns.values()], names=list(columns))


def _blocks(values: list[np.ndarray]) -> pa.RecordBatch:
    """Bins, label, weight, margin and place of rows, as blocks."""
    starts = range(0, len(values[1]), BLOCK_ROWS)
    names = [part.split()[0] for part in _BLOCKS.split(", ")]
    parts = [pa.array([v[i : i + BLOCK_ROWS].tobytes() for i in starts], pa.binary()) for v in values]
    return _batch(dict(zip(names, parts, strict=True)))


def _rows(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[list[np.ndarray]]:
    """Bins, the rows of an input together, label, weight, margin and place, some blocks at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, _TOGETHER):
            joined = [b"".join(column.to_pylist()) for column in batch.slice(start, _TOGETHER).columns]
            numbers = [np.frombuffer(part, kind) for part, kind in zip(joined[1:], _NUMBERS, strict=True)]
            yield [np.asfortranarray(np.frombuffer(joined[0], np.uint8).reshape(len(numbers[0]), width)), *numbers]


def _binned(cuts: list[list[float]], base: float):
    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [column.to_numpy(zero_copy_only=False) for column in batch.columns]
            label, weight, place = columns[len(cuts) :]
            bins = bins_of(columns[: len(cuts)], cuts) if cuts else np.zeros((len(label), 0), np.uint8)
            yield _blocks([bins, label, weight, np.full(len(label), base), place])

    return binned


def _advanced(trees: list[Tree], width: int):
    def advanced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for binned, label, weight, margin, place in _rows(batches, width):
            yield _blocks([binned, label, weight, margin + sum(tree.values_of(binned) for tree in trees), place])

    return advanced


def sampled(place: np.ndarray, share: float, seed: int) -> np.ndarray:
    """Whether each row is among the share that a tree sees."""
    mixed = (place.view(np.uint64) ^ np.uint64(seed * 0x9E3779B97F4A7C15 % 2**64)) * np.uint64(0xD6E8FEB86659FD93)
    return (mixed >> np.uint64(11)).astype(np.float64) < share * 2**53


def _sums(options: BoostingOptions, trees: list[Tree], grown: Tree, asked: list[int], width: int, seed: int):
    """Sums of gradient and hessian per (asked node, input, bin) of one task's rows."""
    shape = len(asked), width, options.bins
    position = np.full(len(grown.value), -1)
    position[asked] = np.arange(len(asked))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, *shape))
        for binned, label, weight, margin, place in _rows(batches, width):
            margin = margin + sum(tree.values_of(binned) for tree in trees)
            at = position[grown.nodes_of(binned)]
            chosen = np.flatnonzero((at >= 0) & sampled(place, options.row_share, seed))
            g, h = (weight[chosen] * part for part in gradients(options, label[chosen], margin[chosen]))
            first = at[chosen] * options.bins
            for column in range(width):
                cells = first + binned[:, column].take(chosen)
                for i, part in enumerate((g, h)):
                    total[i, :, column] += np.bincount(cells, part, len(asked) * options.bins).reshape(len(asked), -1)
        total = total.reshape(2, -1)
        held = np.flatnonzero(total[1])
        yield _batch({"cell": held, "g": total[0, held], "h": total[1, held]})

    return sums


@dataclass
class _Split:
    gain: float
    feature: int
    cut: int
    left: tuple[float, float]
    right: tuple[float, float]


class Grower:
    """Grows one tree from sums; ``ask`` gives the (node, input, bin) sums of nodes of a partial tree."""

    def __init__(self, options: BoostingOptions, columns: np.ndarray, ask: Callable[[Tree, list[int]], np.ndarray]) -> None:
        self.options, self.columns, self.ask = options, columns, ask
        self.tree = Tree()
        self.sums: dict[int, np.ndarray] = {}
        root = self.tree.add(0.0)
        self.sums[root] = ask(self.tree, [root])[0]
        self.tree.value[root] = self.step(self.total(root))

    def total(self, node: int) -> tuple[float, float]:
        """G and H of a node, from its bins of any one input."""
        g, h = self.sums[node][:, 0].sum(axis=1) if self.sums[node].shape[1] else (0.0, 0.0)
        return float(g), float(h)

    def step(self, total: tuple[float, float]) -> float:
        g, h = total
        bound = self.options.max_step if self.options.max_step is not None else math.inf
        return max(-bound, min(bound, -g / (h + self.options.l2))) if h > 0 else 0.0

    def gains(self, node: int) -> np.ndarray:
        """Gain of every (input, cut); -inf for inputs left out and for sides of too small a hessian."""
        left = self.sums[node].cumsum(axis=2)[:, :, :-1]
        total = self.sums[node].sum(axis=2)[:, :, None]
        right, l2, least = total - left, self.options.l2, self.options.min_hessian
        score = lambda part: part[0] ** 2 / np.maximum(part[1] + l2, _LEAST)
        found = score(left) + score(right) - score(total)
        found[(left[1] < least) | (right[1] < least)] = -np.inf
        found[~self.columns] = -np.inf
        return found

    def split_at(self, node: int, feature: int, cut: int, gain: float) -> _Split:
        own = self.sums[node][:, feature]
        left, all_of = own[:, : cut + 1].sum(axis=1), own.sum(axis=1)
        return _Split(gain, feature, cut, tuple(left), tuple(all_of - left))

    def best(self, node: int) -> _Split | None:
        found = self.gains(node)
        if not found.size or not found.max() > _LEAST:
            return None
        feature, cut = np.unravel_index(found.argmax(), found.shape)
        return self.split_at(node, int(feature), int(cut), float(found.max()))

    def divide(self, node: int, split: _Split) -> tuple[int, int]:
        return self.tree.split(node, split.feature, split.cut, (self.step(split.left), self.step(split.right)))

    def add_up(self, divided: list[tuple[int, tuple[int, int], _Split]]) -> None:
        """Sums of the children of divided nodes, in one scan: the smaller child's, and the rest."""
        if not divided:
            return
        smaller = [pair[0] if split.left[1] <= split.right[1] else pair[1] for _, pair, split in divided]
        found = self.ask(self.tree, smaller)
        for (node, (left, right), _), child, sums in zip(divided, smaller, found, strict=True):
            self.sums[child] = sums
            self.sums[right if child == left else left] = self.sums[node] - sums


def _by_level(grower: Grower) -> Tree:
    level = [0]
    for depth in range(grower.options.depth):
        splits = [(node, split) for node in level if (split := grower.best(node))]
        divided = [(node, grower.divide(node, split), split) for node, split in splits]
        if depth + 1 < grower.options.depth:
            grower.add_up(divided)
        level = [child for _, pair, _ in divided for child in pair]
    return grower.tree


def _symmetric(grower: Grower) -> Tree:
    level = [0]
    for depth in range(grower.options.depth):
        # A node that a split leaves on one side gains nothing from it and bars nothing.
        total = sum(np.maximum(grower.gains(node), 0.0) for node in level)
        if not total.size or not total.max() > _LEAST:
            break
        feature, cut = (int(i) for i in np.unravel_index(total.argmax(), total.shape))
        splits = [(node, grower.split_at(node, feature, cut, float(total.max()))) for node in level]
        divided = [(node, grower.divide(node, split), split) for node, split in splits]
        if depth + 1 < grower.options.depth:
            grower.add_up(divided)
        level = [child for _, pair, _ in divided for child in pair]
    return grower.tree


def _best_first(grower: Grower) -> Tree:
    """Leaves are divided ahead of their turn, so that one scan sums children of all open leaves."""
    tried, ahead = grower.tree, {}
    split, depths = {0: grower.best(0)}, {0: 0}
    open_leaves = [(-split[0].gain, 0)] if split[0] else []
    accepted = {}
    while open_leaves and len(accepted) + 1 < grower.options.leaves:
        _, node = heapq.heappop(open_leaves)
        if node not in ahead:
            waiting = [node, *(leaf for _, leaf in open_leaves if leaf not in ahead)]
            for leaf in waiting:
                ahead[leaf] = grower.divide(leaf, split[leaf])
            grower.add_up([(leaf, ahead[leaf], split[leaf]) for leaf in waiting])
        accepted[node] = ahead[node]
        for child in ahead[node]:
            depths[child] = depths[node] + 1
            split[child] = grower.best(child) if depths[child] < grower.options.depth else None
            if split[child]:
                heapq.heappush(open_leaves, (-split[child].gain, child))
    return _kept(tried, accepted)


def _kept(tree: Tree, accepted: dict[int, tuple[int, int]]) -> Tree:
    """The tree with only the accepted splits."""
    kept = Tree()
    places = [(0, kept.add(tree.value[0]))]
    while places:
        node, place = places.pop()
        if node in accepted:
            left, right = accepted[node]
            pair = kept.split(place, tree.feature[node], tree.cut[node], (tree.value[left], tree.value[right]))
            places += zip((left, right), pair, strict=True)
    return kept


GROWTH = {"level": _by_level, "symmetric": _symmetric, "best_first": _best_first}


def fit(rows: DataFrame, columns: list[str], label: Column, weight: Column, options: BoostingOptions) -> Boosted:
    """A model of ``label`` from number columns without nulls."""
    labelled = rows.select(
        *[F.col(name).cast("double").alias(f"x{i}") for i, name in enumerate(columns)],
        label.cast("double").alias("label"),
        F.coalesce(weight.cast("double"), F.lit(0.0)).alias("weight"),
    ).filter("label IS NOT NULL")
    names, width = [f"x{i}" for i in range(len(columns))], len(columns)
    table = materialise(labelled.withColumn("place", F.xxhash64(*names, "label")))
    mean = table.agg(F.sum(F.col("label") * F.col("weight")) / F.sum("weight")).first()[0]
    if mean is None:
        remove_read(table)
        none = 0.0 if options.objective in ("squared", "logistic") else -math.inf
        return Boosted(options, columns, [[]] * width, none)
    cuts = cut_points(table, names, options.bins)
    model = Boosted(options, columns, cuts, base_margin(options.objective, mean))
    blocks = materialise(table.mapInArrow(_binned(cuts, model.base), _BLOCKS))
    remove_read(table)
    with settings_for(rows.sparkSession, **_SCANS):
        _grow(model, blocks)
    return model


def _grow(model: Boosted, table: DataFrame) -> None:
    """Adds the trees, from blocks of binned rows; every table of blocks is removed once no tree needs it."""
    options, width = model.options, len(model.columns)
    chance = np.random.default_rng(options.seed)
    since: list[Tree] = []
    for turn in range(options.trees):
        if len(since) == REFRESH:
            passed, table = table, materialise(table.mapInArrow(_advanced(since, width), _BLOCKS))
            remove_read(passed)
            since = []
        chosen = chance.permutation(width) < max(1, round(options.column_share * width))

        def ask(grown: Tree, asked: list[int], table=table, since=tuple(since), turn=turn) -> np.ndarray:
            task = _sums(options, list(since), grown, asked, width, options.seed + turn)
            added = table.mapInArrow(task, _CELLS).groupBy("cell").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).toArrow()
            out = np.zeros((2, len(asked) * width * options.bins))
            out[:, added["cell"].to_numpy()] = added["g"].to_numpy(), added["h"].to_numpy()
            return out.reshape(2, len(asked), width, options.bins).swapaxes(0, 1)

        tree = GROWTH[options.growth](Grower(options, chosen, ask))
        tree.value = [value * options.learning_rate for value in tree.value]
        since.append(tree)
        model.trees.append(tree)
    remove_read(table)
