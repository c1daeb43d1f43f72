"""Near copies: documents whose sets of word shingles have a Jaccard similarity of at least a bound.

Equal sets are one class. Every class has ``BANDS`` keys, each a hash of ``WIDTH`` least values of its
shingles under random orders: two sets of similarity s share a given key with probability s ** WIDTH,
so at 0.8 all keys differ for one pair in some ten thousand, and at 0.9 for none worth a figure.
Classes whose SimHash fingerprints are linked (``simhash_dedup.links``, at most two bits apart) are
compared with the least of their component first. Members of a key are compared with one leader,
so candidates grow with the rows and not with the pairs of a group. Members that are not similar to their leader stay open and get another one, for
``ROUNDS`` rounds; a link that one key misses is met again in the others. At last every two classes
with fingerprints at most two bits apart are compared that the links so far do not connect; pairs within a
group could change nothing. Every candidate is verified with the whole sets, so no link is wrong; recall against
brute force is measured in the tests.

Defined cases: a text of fewer words than a shingle is one shingle; null and wordless texts are
copies of each other. Of rows that repeat an id the first in the files stays; rows without an id come
after all others. Columns of any name go through as they are.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from restock.llm.common import as_bytes, fresh, identified, likely, written
from restock.llm.components import connected
from restock.llm.simhash_dedup import fingerprint_of, words_near
from restock.llm.simhash_dedup import links as fingerprint_links

SHINGLE = 5
SIMILARITY = 0.8
BANDS = 24
WIDTH = 5
ROUNDS = 3
_SLACK = 1e-9
_SEED = 11
# Shingles of one text that are mixed at a time.
_AT_ONCE = 4096
# Orders of ids, a round each.
_MASKS = (0, 0x5555555555555555, 0x0F0F0F0F0F0F0F0F)


def shingles_of(text: bytes, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted hashes of the distinct shingles; letters A to Z count in lower case."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.int64)
    digest = xxhash.xxh64_intdigest
    runs = range(max(1, len(words) - shingle + 1))
    hashes = [digest(b" ".join(words[i : i + shingle])) for i in runs]
    return np.unique(np.array(hashes, dtype=np.uint64).view(np.int64))


def similarity_of(a: np.ndarray, b: np.ndarray) -> float:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common / (len(a) + len(b) - common) if len(a) or len(b) else 1.0


def least_values(shingles: np.ndarray, bands: int, width: int) -> np.ndarray:
    """For each of bands * width random orders the least value of the shingles."""
    factors, shifts = np.random.default_rng(_SEED).integers(0, 2**63, (2, bands * width, 1), dtype=np.uint64)
    found = np.full(bands * width, np.iinfo(np.uint64).max)
    for start in range(0, len(shingles), _AT_ONCE):
        mixed = shingles[start : start + _AT_ONCE].view(np.uint64) * (2 * factors + 1) + shifts
        found = np.minimum(found, mixed.min(axis=1))
    return found


def _keys(shingle: int, bands: int, width: int):
    @F.pandas_udf("size int, digest long, fp long, keys array<long>")
    def keys(texts: pd.Series) -> pd.DataFrame:
        out = []
        for text in as_bytes(texts):
            held = shingles_of(text, shingle)
            rows = least_values(held, bands, width).reshape(bands, width) if len(held) else np.zeros((0, width), np.uint64)
            hashes = [xxhash.xxh64_intdigest(row.tobytes(), i) for i, row in enumerate(rows)]
            digest = int(np.uint64(xxhash.xxh64_intdigest(held.tobytes())).astype(np.int64))
            out.append((len(held), digest, fingerprint_of(text, shingle), np.array(hashes, np.uint64).view(np.int64)))
        return pd.DataFrame(out, columns=["size", "digest", "fp", "keys"])

    return keys


def _similar(shingle: int, similarity: float):
    @F.pandas_udf("boolean")
    def similar(a: pd.Series, b: pd.Series) -> pd.Series:
        sets = lru_cache(64)(lambda text: shingles_of(text, shingle))
        pairs = zip(as_bytes(a), as_bytes(b), strict=True)
        return pd.Series([similarity_of(sets(x), sets(y)) >= similarity - _SLACK for x, y in pairs], dtype=bool)

    return similar


def keep_one(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    similarity: float = SIMILARITY,
    bands: int = BANDS,
    width: int = WIDTH,
) -> DataFrame:
    """The documents with one row of every component: the smallest id, the first of rows that repeat."""
    row = fresh(docs, "_row")
    placed = identified(docs, row)
    keys = _keys(shingle, bands, width)(F.col(text)).alias("found")
    rows = written(placed.select(F.col(row).alias("at"), F.col(doc_id).alias("doc_id"), keys).select("at", "doc_id", "found.*"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "at")).alias("first")
    # A class is named by the digest of its set.
    classes = written(rows.groupBy(F.col("digest").alias("id")).agg(first))
    whole = rows.join(classes.select("first.at"), "at", "left_semi").select(F.col("digest").alias("id"), "size", "fp", "keys")
    texts = placed.select(F.col(row).alias("at"), F.col(text).alias("text"))
    members = groups(written(whole), texts, classes.select("id", "first.at"), shingle, similarity)
    rooted = classes.join(members, "id", "left").withColumn("root", F.coalesce("root", "id"))
    kept = rooted.groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.at").alias(row))
    return placed.join(kept, row, "left_semi").select(docs.columns)


def islands(classes: DataFrame) -> DataFrame:
    """(id, fp, island) of every class; an island is a component of linked fingerprints, named by its least one."""
    fingerprints = classes.select("fp").distinct()
    members = connected(fingerprint_links(fingerprints)).select(F.col("node").alias("fp"), F.col("root").alias("island"))
    return classes.select("id", "fp").join(members, "fp", "left").withColumn("island", F.coalesce("island", "fp"))


def by_fingerprint(classes: DataFrame) -> DataFrame:
    """Pairs (a, b) of every class with the least one of its fingerprint's component."""
    return _with_least(islands(classes))


def _with_least(placed: DataFrame) -> DataFrame:
    led = placed.groupBy("island").agg(F.min("id").alias("a"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    return placed.join(led, "island").filter("id <> a").select("a", F.col("id").alias("b"))


def apart(placed: DataFrame, members: DataFrame) -> DataFrame:
    """Pairs (a, b) with their groups of all classes of two groups whose fingerprints are at most two bits apart.

    ``placed`` has (id, fp, island), ``members`` (id, root); a class without a member is a group of its own. Two
    fingerprints share a word at most one bit away exactly if they are at most two bits apart. Of two classes of
    different groups one is not of the group that holds most of the word, so the rest of a word meets all
    of it, and the classes of one large group never meet each other.
    """
    grouped = placed.join(members, "id", "left").withColumn("root", F.coalesce("root", "id"))
    several = grouped.groupBy("island").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low < high")
    rows = written(grouped.join(several, "island", "left_semi").select("id", "fp", "root"))
    words = rows.select("id", "root", F.explode(words_near(F.col("fp"))).alias("word"))
    held = words.groupBy("word", "root").agg(F.count(F.lit(1)).alias("n"))
    most = held.groupBy("word").agg(F.max_by("root", F.struct("n", "root")).alias("most"), F.count(F.lit(1)).alias("groups"))
    shared = written(words.join(most.filter("groups > 1"), "word").select("word", "id", "root", "most"))
    rest = shared.filter("root <> most").select("word", F.col("id").alias("x"), F.col("root").alias("root_x"))
    every = shared.select("word", F.col("id").alias("y"), F.col("root").alias("root_y"))
    met = rest.join(every, "word").filter("root_x <> root_y")
    swapped = F.col("x") > F.col("y")
    sides = {"a": F.least("x", "y"), "b": F.greatest("x", "y")}
    roots = {f"root_{s}": F.when(swapped, t).otherwise(F.col(o)) for s, o, t in (("a", "root_x", F.col("root_y")), ("b", "root_y", F.col("root_x")))}
    return met.select(*[c.alias(n) for n, c in {**sides, **roots}.items()]).distinct()


class _Compared:
    """Verifies candidate pairs (a, b) of classes with their whole sets."""

    def __init__(self, classes: DataFrame, texts: DataFrame, places: DataFrame, shingle: int, similarity: float) -> None:
        self.sizes, self.texts, self.places = classes.select("id", "size"), texts, places
        self.similar, self.similarity = _similar(shingle, similarity), similarity

    def __call__(self, pairs: DataFrame) -> DataFrame:
        """The pairs that may be similar by their sizes, and whether they are: ``linked``."""
        columns = pairs.columns
        for side in ("a", "b"):
            pairs = pairs.join(self.sizes.select(F.col("id").alias(side), F.col("size").alias(f"size_{side}")), side)
        fit = F.least("size_a", "size_b") >= F.greatest("size_a", "size_b") * self.similarity - _SLACK
        pairs = written(pairs.filter(fit).select(columns))
        ids = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
        asked = written(self.places.join(ids, "id", "left_semi"))
        known = written(likely(self.texts, asked, "at").join(asked, "at").select("id", "text"))
        # The side with few pairs an id first; a leader's text is then joined to rows, not sent with each.
        both = pairs.join(known.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
        both = both.join(known.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
        return written(both.select(*columns, self.similar("text_a", "text_b").alias("linked")))


def links(classes: DataFrame, placed: DataFrame, compared: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Links (a, b) between similar classes (id, size, fp, keys): with the least of their island and with leaders of keys."""
    open_rows = classes.select("id", F.explode("keys").alias("key"))
    found = None
    for turn in range(ROUNDS):
        # The leader is the least id under another order each round; the order can be undone.
        mask = F.lit(_MASKS[turn % len(_MASKS)])
        led = open_rows.groupBy("key").agg(F.min(F.col("id").bitwiseXOR(mask)).alias("leader"), F.count(F.lit(1)).alias("n"))
        led = led.filter("n > 1").select("key", F.col("leader").bitwiseXOR(mask).alias("leader"))
        met = written(open_rows.join(led, "key").filter("id <> leader"))
        pairs = met.select(F.least("id", "leader").alias("a"), F.greatest("id", "leader").alias("b")).distinct()
        if found is None:
            pairs = pairs.unionByName(_with_least(placed)).distinct()
        else:
            pairs = pairs.join(found.select("a", "b"), ["a", "b"], "left_anti")
        tried = compared(pairs)
        found = tried if found is None else found.unionByName(tried)
        linked = found.filter("linked").select("a", "b")
        if turn + 1 < ROUNDS:
            sides = met.withColumns({"a": F.least("id", "leader"), "b": F.greatest("id", "leader")})
            open_rows = written(sides.join(linked, ["a", "b"], "left_anti").select("id", "key"))
    return linked


def groups(classes: DataFrame, texts: DataFrame, places: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """(id, root) of the classes that links connect with others.

    ``classes`` has (id, size, fp, keys), ``texts`` (at, text) of all rows and ``places`` the row (id, at) whose
    text stands for a class.
    """
    compared = _Compared(classes, texts, places, shingle, similarity)
    placed = written(islands(classes))
    members = connected(links(classes, placed, compared)).withColumnRenamed("node", "id")
    more = compared(apart(placed, members)).filter("linked")
    joined = connected(more.select(F.col("root_a").alias("a"), F.col("root_b").alias("b")))
    alone = joined.select(F.col("node").alias("id"), F.col("node").alias("root"))
    every = members.unionByName(alone.join(members, "id", "left_anti"))
    renamed = joined.select(F.col("node").alias("root"), F.col("root").alias("whole"))
    return every.join(renamed, "root", "left").select("id", F.coalesce("whole", "root").alias("root"))
