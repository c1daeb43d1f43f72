"""Quality rules: base statistics per text, then robust multivariate outliers per language and source.

Each text gives five transformed statistics: word length, symbols, equal lines, repeated words and
capitals, each smoothed so that short texts stay near the usual value. Location and scatter of a group
are minimum-covariance-determinant estimates: from medians, the rows nearest by Mahalanobis distance
(three quarters of the group, by approximate quantiles) give new means and covariances, a few times over.
Every such step is an aggregation of sums, and rows meet their estimates by broadcast or by salted keys, so a
group may be any share of the rows. A row far beyond its group is rejected.

Groups of fewer than ``LEAST_ROWS`` rows are pooled by language, and those again over all languages;
if even these are too few, there is no verdict and their rows are kept.

Defined cases: a null text has no words and fails the base rule. Null languages and sources are groups
of their own. Rows that repeat keep their rows. A spread of zero is replaced by ``FLOORS``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from restock.llm.common import written

SPACE = " \t\n\r\x0b\x0c"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
NEAREST = 0.75
STEPS = 3
LEAST_ROWS = 50
# Least spread of each statistic: what a clean text may differ by even if its group does not differ at all.
FLOORS = [0.08, 0.08, 0.15, 0.10, 0.06]
SIZE = len(FLOORS)
_CAPITALS = re.compile(rb"[A-Z]")


def chi_square(normal_quantile: float, size: int = SIZE) -> float:
    """Chi-square quantile for a standard normal quantile, by the cube-root approximation."""
    return size * (1 - 2 / (9 * size) + normal_quantile * (2 / (9 * size)) ** 0.5) ** 3


# About one in a million rows of a normal group lies beyond the cut.
CUT = chi_square(4.75)
MEDIAN = chi_square(0.0)

# One row per group, of some 300 bytes, is sent to every task up to this many groups.
GROUPS = 10_000
# Beyond it rows are joined by group and salt, so a group that holds a third of all rows is this many tasks.
SALTS = 64

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _names(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Equal numbers for equal pairs."""
    return np.unique(first * (int(second.max()) + 1) + second, return_inverse=True)[1].astype(np.int64)


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of five words found twice or more."""
    size = len(words) - WINDOW + 1
    if size < 2:
        return 0
    numbers: dict[bytes, int] = {}
    single = np.fromiter((numbers.setdefault(word, len(numbers)) for word in words), np.int64, len(words))
    pairs = _names(single[:-1], single[1:])
    fours = _names(pairs[:-2], pairs[2:])
    windows = _names(fours[:-1], single[WINDOW - 1 :])
    twice = (np.bincount(windows) > 1)[windows]
    edges = np.zeros(len(words) + 1, np.int64)
    edges[:size] += twice
    edges[WINDOW:] -= twice
    return int((np.cumsum(edges) > 0).sum())


def statistics(text: str | None) -> tuple:
    """The base counts and the transformed vector of a text."""
    text = text or ""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    n_words = len(words)
    word_chars = len(text) - sum(map(text.count, SPACE))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [line for line in text.split("\n") if line.strip(SPACE)]
    equal = len(lines) - len(set(lines))
    repeated = repeated_words(words)
    capitals = len(_CAPITALS.findall(data))
    vector = [
        float(np.log((word_chars + 250) / (n_words + 50))),
        (symbols / (n_words + 20)) ** 0.5,
        (equal / (len(lines) + 5)) ** 0.5,
        (repeated / (n_words + 20)) ** 0.5,
        capitals / (word_chars + 100),
    ]
    return n_words, word_chars, symbols, equal, repeated, vector


def _measure():
    @F.pandas_udf(f"{', '.join(f'{name} long' for name in COUNTS)}, x array<double>")
    def measure(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([statistics(text) for text in texts], columns=[*COUNTS, "x"])

    return measure


def beside(rows: DataFrame, groups: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """The rows with what is known of their group; ``groups`` holds one row a group and is written.

    No group's rows meet in one task: few groups go to the rows, many are repeated for every salt. The rows
    carry a written ``salt`` that does not depend on what they hold, so copies of one text are spread as well.
    """
    if groups.limit(GROUPS + 1).count() <= GROUPS:
        return rows.join(F.broadcast(groups), keys, how)
    each = groups.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.join(each, [*keys, "salt"], how)


def _grouped(measured: DataFrame) -> DataFrame:
    """Rows (lang_key, source_key, ...) with ``unit``, the group that judges them; null where there are too few."""
    sizes = measured.groupBy("lang_key", "source_key").agg(F.count(F.lit(1)).alias("n"))
    own = F.when(F.col("n") >= LEAST_ROWS, F.concat_ws("/", "lang_key", "source_key"))
    sizes = sizes.withColumn("own", own)
    pooled = sizes.filter("own IS NULL").groupBy("lang_key").agg(F.sum("n").alias("pool"))
    rest = pooled.filter(F.col("pool") < LEAST_ROWS).agg(F.coalesce(F.sum("pool"), F.lit(0)).alias("rest"))
    enough = rest.select(F.col("rest") >= LEAST_ROWS).scalar()
    unit = F.coalesce("own", F.when(F.col("pool") >= LEAST_ROWS, F.col("lang_key")), F.when(enough, F.lit("*")))
    units = sizes.join(pooled, "lang_key", "left").select("lang_key", "source_key", unit.alias("unit"))
    return beside(measured, written(units), ["lang_key", "source_key"])


def _key(name: str) -> Column:
    """A column as text that tells a null from every value."""
    return F.coalesce(F.concat(F.lit("="), F.col(name).cast("string")), F.lit("-")).alias(f"{name}_key")


def _distance(x: Column, mean: Column, inverse: Column) -> Column:
    """Squared Mahalanobis distance."""
    terms = [
        (x[i] - mean[i]) * (x[j] - mean[j]) * inverse[i * SIZE + j] * (1 if i == j else 2)
        for i in range(SIZE)
        for j in range(i, SIZE)
    ]
    return sum(terms[1:], terms[0])


def _inverses(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per group: sums become a mean and the inverse of a covariance with the least spreads added."""
    for batch in batches:
        means, inverses = [], []
        for n, total, products in zip(batch["n"], batch["total"], batch["products"], strict=True):
            mean = np.array(total) / n
            upper = np.zeros((SIZE, SIZE))
            upper[np.triu_indices(SIZE)] = np.array(products) / n
            square = upper + np.triu(upper, 1).T - np.outer(mean, mean)
            means.append(mean)
            inverses.append(np.linalg.inv(square + np.diag(np.square(FLOORS))).ravel())
        yield pd.DataFrame({"unit": batch["unit"], "mean": means, "inverse": inverses})


_ESTIMATE = "unit string, mean array<double>, inverse array<double>"


def _start(rows: DataFrame) -> DataFrame:
    """Medians and spreads by absolute deviation of every statistic by itself."""
    median = lambda value: F.percentile_approx(value, 0.5, 1000)
    middles = rows.groupBy("unit").agg(F.array(*[median(F.col("x")[i]) for i in range(SIZE)]).alias("mean"))
    apart = beside(rows, written(middles), ["unit"])
    spreads = [1.4826 * median(F.abs(F.col("x")[i] - F.col("mean")[i])) for i in range(SIZE)]
    found = apart.groupBy("unit").agg(F.first("mean").alias("mean"), F.array(*spreads).alias("spread"))
    inverse = [
        1 / (F.col("spread")[i] ** 2 + FLOORS[i] ** 2) if i == j else F.lit(0.0)
        for i in range(SIZE)
        for j in range(SIZE)
    ]
    return found.select("unit", "mean", F.array(*inverse).alias("inverse"))


def _nearer(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """One concentration step: new estimates from the nearest rows of every group."""
    placed = beside(rows, estimates, ["unit"]).withColumn("d", _distance(F.col("x"), F.col("mean"), F.col("inverse")))
    limits = placed.groupBy("unit").agg(F.percentile_approx("d", NEAREST, 1000).alias("limit"))
    near = beside(placed.drop("mean", "inverse"), written(limits), ["unit"]).filter("d <= limit")
    x = F.col("x")
    products = [F.sum(x[i] * x[j]) for i in range(SIZE) for j in range(i, SIZE)]
    sums = near.groupBy("unit").agg(
        F.count(F.lit(1)).alias("n"), F.array(*[F.sum(x[i]) for i in range(SIZE)]).alias("total"), F.array(*products).alias("products")
    )
    return sums.mapInPandas(_inverses, _ESTIMATE)


def judged(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, the counts, ``base_failed``, ``kept`` and ``distance`` (null without a verdict)."""
    found = docs.select("doc_id", _key("lang"), _key("source"), _measure()("text").alias("found"))
    salt = F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int").alias("salt")
    measured = written(found.select("doc_id", "lang_key", "source_key", "found.*", salt))
    rows = written(_grouped(measured))
    sample = rows.filter("unit IS NOT NULL").select("unit", "x", "salt")
    estimates = written(_start(sample))
    for _ in range(STEPS):
        estimates = written(_nearer(sample, estimates))
    far = _distance(F.col("x"), F.col("mean"), F.col("inverse"))
    middle = beside(sample, estimates, ["unit"]).groupBy("unit").agg(F.percentile_approx(far, 0.5, 1000).alias("middle"))
    wide = written(estimates.join(middle, "unit").withColumn("scale", F.greatest(F.col("middle") / MEDIAN, F.lit(1.0))))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    found = beside(rows, wide, ["unit"], "left").withColumn("distance", far / F.col("scale"))
    kept = ~failed & F.coalesce(F.col("distance") <= CUT, F.lit(True))
    return found.select("doc_id", *COUNTS, failed.alias("base_failed"), kept.alias("kept"), "distance")
