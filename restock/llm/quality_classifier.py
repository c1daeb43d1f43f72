"""Quality classifier: n-gram indicators scaled by naive Bayes log-count ratios, then a linear hinge-loss model.

Features are indicators, in a fixed number of columns, of single words and of runs of one to three
word shapes. A shape is the sequence of character kinds in a word; a word equal to the one before it
has a shape of its own. Ratios come from counts over all labelled training rows. The hinge-loss model
is fitted by dual coordinate descent on a sample of at most ``SAMPLE_ROWS`` training rows of each
class, the one bound here; every document is scored by its whole text.

Defined cases: a null text is an empty one and gets the model's intercept as margin. Labels that are
null or not 0 or 1, or whose document is missing, are ignored; a document labelled twice counts
twice. With no labels of either class the score is 0.5. Rows that repeat keep their rows.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from restock.llm.common import is_held_out, likely, written

COLUMNS = 1 << 16
WORD_COLUMNS = 1 << 15
SAMPLE_ROWS = 3_000
COST = 0.1
PASSES = 20
SMOOTHING = 1.0
SLOPE = 2.0

_SAME = np.int64(0)
_CACHE_WORDS = 300_000
_RUNS = re.compile(r"(.)\1+", re.DOTALL)
_seen: dict[str, tuple[int, int]] = {}


def shape(word: str) -> str:
    """Character kinds in order, runs joined: ``Thha***`` is ``Aa*``."""
    kinds = "".join(
        "A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c if c.isascii() else "?" for c in word
    )
    return _RUNS.sub(r"\1", kinds)


def _described(word: str) -> tuple[int, int]:
    known = _seen.get(word)
    if known is None:
        if len(_seen) > _CACHE_WORDS:
            _seen.clear()
        code = zlib.crc32(shape(word).encode()) | 1
        known = _seen[word] = (zlib.crc32(word.lower().encode("utf-8", "surrogatepass")) % WORD_COLUMNS, code)
    return known


def features(text: str | None) -> np.ndarray:
    """The sorted columns set by a text."""
    words = text.split() if text else []
    if not words:
        return np.zeros(0, np.uint16)
    pairs = np.array([_described(word) for word in words], np.int64)
    own, shapes = pairs[:, 0], pairs[:, 1]
    same = np.fromiter((a == b for a, b in zip(words, words[1:])), bool, len(words) - 1)  # noqa: B905
    shapes[1:][same] = _SAME
    present = np.zeros(COLUMNS, bool)
    present[own] = True
    run = np.zeros(len(words), np.int64)
    for length in range(1, min(3, len(words)) + 1):
        run = run[: len(words) - length + 1] * 1_000_003 + shapes[length - 1 :] + length
        present[WORD_COLUMNS + ((run * 2_654_435_761) >> 20) % (COLUMNS - WORD_COLUMNS)] = True
    return np.flatnonzero(present).astype(np.uint16)


@F.pandas_udf(T.BinaryType())
def packed_features(texts: pd.Series) -> pd.Series:
    return pd.Series([features(text).tobytes() for text in texts], dtype=object)


def _unpacked(value: bytes) -> np.ndarray:
    return np.frombuffer(value, np.uint16)


def _class_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows that set each column, by class, over one task's rows."""
    counts, rows = np.zeros((2, COLUMNS), np.int64), np.zeros(2, np.int64)
    for batch in batches:
        for label, value in zip(batch["label"], batch["packed"], strict=True):
            counts[label][_unpacked(value)] += 1
            rows[label] += 1
    for label in (0, 1):
        at = np.flatnonzero(counts[label])
        total = pd.DataFrame({"label": label, "at": [-1], "n": rows[label]})
        yield pd.concat([pd.DataFrame({"label": label, "at": at, "n": counts[label][at]}), total])


@dataclass
class Model:
    """Weights per column and an intercept; a positive margin means label 1."""

    weights: np.ndarray
    intercept: float

    def margin(self, columns: np.ndarray) -> float:
        return float(self.weights[columns].sum()) + self.intercept


def log_count_ratios(counts: np.ndarray, rows: np.ndarray) -> np.ndarray:
    shares = (counts + SMOOTHING) / (rows[:, None] + 2 * SMOOTHING)
    return np.log(shares[1] / shares[0])


def dual_coordinate_descent(
    rows: list[np.ndarray], signs: np.ndarray, ratios: np.ndarray, costs: np.ndarray, passes: int = PASSES
) -> Model:
    """Linear hinge-loss fit; every row is scaled to unit length, the intercept is one more column."""
    scales = [ratios[columns] for columns in rows]
    lengths = np.array([np.sqrt(scale @ scale) or 1.0 for scale in scales])
    weights, intercept = np.zeros(len(ratios)), 0.0
    dual = np.zeros(len(rows))
    order = np.random.default_rng(0)
    for _ in range(passes):
        moved = 0.0
        for i in order.permutation(len(rows)):
            scaled = scales[i] / lengths[i]
            gradient = signs[i] * (weights[rows[i]] @ scaled + intercept) - 1.0
            new = min(max(dual[i] - gradient / (scaled @ scaled + 1.0), 0.0), costs[i])
            step = (new - dual[i]) * signs[i]
            if step:
                weights[rows[i]] += step * scaled
                intercept += step
                moved = max(moved, abs(step))
                dual[i] = new
        if moved < 1e-3:
            break
    return Model(weights, intercept)


def fit(labelled: DataFrame, sample_rows: int = SAMPLE_ROWS) -> tuple[np.ndarray, Model] | None:
    """Ratios and model from rows (doc_id, packed, label); none if a class has no rows.

    The driver receives two counts per column and the sample, both of a fixed size.
    """
    totals = (
        labelled.select("label", "packed")
        .mapInPandas(_class_counts, "label int, at int, n long")
        .groupBy("label", "at")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    counts, rows = np.zeros((2, COLUMNS)), np.zeros(2)
    for label, at, n in totals.itertuples(index=False):
        if at < 0:
            rows[label] = n
        else:
            counts[label][at] = n
    if not rows.all():
        return None
    ratios = log_count_ratios(counts, rows)
    chosen, signs = [], []
    for label in (0, 1):
        mixed = F.xxhash64(F.col("doc_id"), F.lit(7))
        part = labelled.filter(F.col("label") == label).orderBy(mixed, "packed").limit(sample_rows).select("packed")
        found = [_unpacked(bytes(row.packed)) for row in part.collect()]
        chosen += found
        signs += [2 * label - 1] * len(found)
    signs = np.array(signs, float)
    costs = np.where(signs > 0, 1 / (signs > 0).sum(), 1 / (signs < 0).sum()) * COST * len(signs)
    return ratios, dual_coordinate_descent(chosen, signs, ratios, costs)


def _scorer(fitted: tuple[np.ndarray, Model] | None):
    if fitted is None:
        return lambda packed: F.lit(0.5)
    ratios, model = fitted

    @F.pandas_udf("double")
    def score(values: pd.Series) -> pd.Series:
        margins = []
        for value in values:
            columns = _unpacked(value)
            scale = ratios[columns]
            margins.append(model.weights[columns] @ scale / (np.sqrt(scale @ scale) or 1.0) + model.intercept)
        return pd.Series(1 / (1 + np.exp(-SLOPE * np.array(margins, float))), dtype="float64")

    return score


def _fitted(packed: DataFrame, labels: DataFrame, label: str, divisor: int, rest: int):
    usable = labels.filter(F.col(label).isin(0, 1)).select("doc_id", F.col(label).cast("int").alias("label"))
    training = packed.filter(~is_held_out("doc_id", divisor, rest)).join(usable, "doc_id")
    return fit(written(training.select("doc_id", "packed", "label")))


def scores(
    docs: DataFrame, labels: DataFrame, label: str = "quality", divisor: int = 3, rest: int = 1
) -> DataFrame:
    """Per row: doc_id, held_out, score and predicted."""
    packed = written(docs.select("doc_id", packed_features("text").alias("packed")))
    score = _scorer(_fitted(packed, labels, label, divisor, rest))
    found = packed.select("doc_id", is_held_out("doc_id", divisor, rest).alias("held_out"), score("packed").alias("score"))
    return found.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def accepted(docs: DataFrame, labels: DataFrame, label: str = "quality", divisor: int = 3, rest: int = 1) -> DataFrame:
    """The documents with a score of 0.5 or more, unchanged.

    Features of labelled rows are taken first; the texts themselves are scored where they are read.
    """
    wanted = labels.filter(F.col(label).isin(0, 1)).select("doc_id").distinct()
    training = likely(docs.filter(~is_held_out("doc_id", divisor, rest)).select("doc_id", "text"), wanted, "doc_id")
    packed = training.select("doc_id", packed_features("text").alias("packed"))
    score = _scorer(_fitted(packed, labels, label, divisor, rest))
    return docs.filter(score(packed_features("text")) >= 0.5)
