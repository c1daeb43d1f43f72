"""Near-duplicates by SimHash fingerprints, linked through pivot distance tables.

A fingerprint has 64 bits. Every distinct fingerprint gets the table of its Hamming distances to
fixed reference fingerprints: the zero word and one word per pair of neighbouring bits. Flipping one
bit moves the difference between a pair's distance and the zero distance for that pair alone, so two
fingerprints at most two bits apart agree in at least three of five groups of these coordinates:
they meet under one of ten keys. Pairs under a key are discarded by the largest coordinate
difference and the survivors verified by their distance.

Keys that more than ``bucket`` fingerprints share are not paired. Their fingerprints are linked
through all words one bit away: two fingerprints share such a word exactly if they are at most two
bits apart, so grouping by word finds the same links with 65 rows per fingerprint.

Defined cases: a null or wordless text has fingerprint zero and links like any other. Rows that
repeat keep their rows. A null id never is a component id unless the whole component has none. An
empty table gives an empty result. Columns other than the id and the text are ignored.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from restock.llm.common import as_bytes, fresh, identified, written
from restock.llm.components import connected

SEED = 42
SHINGLE = 3
PIVOT_BITS = 2
REFERENCES = [0] + [((1 << PIVOT_BITS) - 1) << at for at in range(0, 64, PIVOT_BITS)]
GROUPS = [range(0, 7), range(7, 14), range(14, 20), range(20, 26), range(26, 32)]
MAX_BITS = 2
BUCKET = 64


def fingerprint_of(text: bytes, shingle: int = SHINGLE) -> int:
    """The fingerprint as a signed number."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        hashes = [digest(joined, SEED)]
    else:
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes + 1) - 1
        starts = (ends - sizes)[: len(words) - shingle + 1].tolist()
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1 :].tolist(), strict=True)]
    bits = np.unpackbits(np.array(hashes, dtype=">u8").view(np.uint8)).reshape(-1, 64)
    majority = 2 * bits.sum(axis=0, dtype=np.int64) > len(hashes)
    return int.from_bytes(np.packbits(majority).tobytes(), "big", signed=True)


@F.pandas_udf(T.LongType())
def simhash(texts: pd.Series) -> pd.Series:
    return pd.Series([fingerprint_of(text) for text in as_bytes(texts)], dtype="int64")


def _signed(word: int) -> int:
    return word - (1 << 64) if word >= 1 << 63 else word


def pivot_distances(fingerprint: Column) -> Column:
    """Hamming distances to all reference fingerprints."""
    return F.array(*[F.bit_count(fingerprint.bitwiseXOR(F.lit(_signed(word)).cast("long"))) for word in REFERENCES])


def pivot_keys(distances: Column) -> Column:
    """Ten numbers; fingerprints at most two bits apart share one of them."""
    # Set bits of each pair, from the distances alone.
    moved = F.transform(F.slice(distances, 2, len(REFERENCES) - 1), lambda d: (distances[0] + PIVOT_BITS - d) / 2)
    numbers = [
        F.aggregate(
            F.slice(moved, group.start + 1, len(group)),
            F.lit(0).cast("long"),
            lambda total, c: total * (PIVOT_BITS + 1) + c.cast("long"),
        )
        for group in GROUPS
    ]
    keys = []
    for place, chosen in enumerate(combinations(range(len(GROUPS)), len(GROUPS) - MAX_BITS)):
        keys.append(reduce(lambda key, group: key * 4096 + numbers[group], chosen, F.lit(place).cast("long")))
    return F.array(*keys)


def _pairs(rows: DataFrame) -> DataFrame:
    """Verified links between fingerprints of one key."""
    left = rows.select("key", F.col("fp").alias("a"), F.col("pivots").alias("pivots_a"))
    right = rows.select("key", F.col("fp").alias("b"), F.col("pivots").alias("pivots_b"))
    far = F.exists(
        F.zip_with("pivots_a", "pivots_b", lambda x, y: F.abs(x - y)), lambda difference: difference > MAX_BITS
    )
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MAX_BITS
    return left.join(right, "key").filter(F.col("a") < F.col("b")).filter(~far).filter(near).select("a", "b")


def words_near(fingerprint: Column) -> Column:
    """The fingerprint and all words one bit away; two fingerprints share one exactly if at most two bits part them."""
    return F.array(fingerprint, *[fingerprint.bitwiseXOR(F.lit(_signed(1 << bit)).cast("long")) for bit in range(64)])


def _through_neighbours(fingerprints: DataFrame) -> DataFrame:
    """Links over words one bit away; exact for two bits, at most 65 fingerprints meet in a word."""
    words = fingerprints.select("fp", F.explode(words_near(F.col("fp"))).alias("word"))
    least = words.groupBy("word").agg(F.min("fp").alias("a"), F.max("fp").alias("top")).filter("a < top")
    return words.join(least, "word").filter("fp > a").select("a", F.col("fp").alias("b"))


def links(fingerprints: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Links (a, b) that connect all fingerprints at most two bits apart; one row per fingerprint comes in."""
    pivots = written(fingerprints.select("fp", pivot_distances(F.col("fp")).alias("pivots")))
    keyed = written(pivots.select("fp", "pivots", F.explode(pivot_keys(F.col("pivots"))).alias("key")))
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    shared = written(keyed.join(sizes, "key"))
    small = _pairs(shared.filter(F.col("size") <= bucket))
    large = _through_neighbours(shared.filter(F.col("size") > bucket).select("fp").distinct())
    return small.unionByName(large).distinct()


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", bucket: int = BUCKET) -> DataFrame:
    """Per row: id, ``fp``, ``component_id`` (smallest id reachable by links) and ``copies`` (rows with this fp)."""
    rows = written(docs.select(F.col(doc_id).alias("doc_id"), simhash(F.col(text)).alias("fp")))
    classes = written(rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("copies")))
    return rows.join(_labelled(classes, bucket), "fp").select("doc_id", "fp", "component_id", "copies")


def _labelled(classes: DataFrame, bucket: int) -> DataFrame:
    """Fingerprints with the smallest id of their component."""
    members = connected(links(classes.select("fp"), bucket))
    rooted = classes.join(members.withColumnRenamed("node", "fp"), "fp", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "fp"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.join(smallest, "root").select("fp", "component_id", "copies")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", bucket: int = BUCKET) -> DataFrame:
    """The documents with one row of every component: the smallest id, the first of rows that repeat."""
    row = fresh(docs, "_row")
    placed = identified(docs, row)
    rows = written(placed.select(F.col(row).alias("at"), F.col(doc_id).alias("doc_id"), simhash(F.col(text)).alias("fp")))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "at"))
    classes = written(rows.groupBy("fp").agg(first.alias("first")))
    members = connected(links(classes.select("fp"), bucket)).withColumnRenamed("node", "fp")
    rooted = classes.join(members, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    kept = rooted.groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.at").alias(row))
    return placed.join(kept, row, "left_semi").select(docs.columns)
