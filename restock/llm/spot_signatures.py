"""Document fingerprints: chains of content words that follow common words.

A word is a run of letters, digits and characters beyond ASCII, in lower case. Every common word of a
text (``ANCHORS``) is a spot; its signature is a hash of the anchor and the next ``CHAIN`` content
words, other anchors left out. Menus and headings hold few common words, so they leave few signatures.
The set of a text's signatures is its fingerprint; two texts are as alike as the Jaccard similarity of
their sets.

Sets are partitioned by length: partition ``k`` holds the lengths from ``(1 / similarity) ** k`` on, so
only sets of the same or of neighbouring partitions can reach a similarity, and a pair whose
lengths alone rule it out is never intersected.

Built-in functions only. Defined cases: a null text is empty. A text with words but without a whole
chain has one signature, that of all its words; a wordless text has none. Two empty sets are alike by
1, an empty and another set by 0. Rows are ordered by descending id, rows without an id last, rows of
one id by text; the row after the last is the first, so a single row follows itself. Rows that repeat
are rows of their own. Other columns of the input are not read.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Common words of English, German, French and Spanish.
ANCHORS = (
    "a an the of and to in is that for with on as at by from or it are be was this which have had has not but they you he his her we "
    "der die das und den dem des ein eine einer zu mit von auf für im ist nicht sich als auch es am aus bei wird nach "
    "le la les un une du de et à en que qui dans pour par sur au aux ne pas se ce il elle est avec son "
    "el los las una del y por con para no su al lo como más"
).split()
CHAIN = 3
SIMILARITY = 0.8
_BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

# Rows of one bucket of ids, the most buckets, and how many cut points one step of the search looks at.
BUCKET_ROWS = 2048
MOST_BUCKETS = 4096
_STEP = 64


def _hash(text: Column) -> Column:
    """The first sixty bits of MD5 as a number."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def with_signatures(rows: DataFrame, text: str, name: str, chain: int = CHAIN) -> DataFrame:
    """Adds the sorted set of a text's signatures."""
    words, content, spots, found = (f"{name}_{part}" for part in ("words", "content", "spots", "found"))
    whole = F.coalesce(F.lower(text), F.lit(""))
    split = rows.withColumn(words, F.array_remove(F.split(whole, _BETWEEN_WORDS), ""))
    marked = split.withColumns(
        {
            content: F.filter(words, lambda word: ~word.isin(ANCHORS)),
            spots: F.filter(
                F.transform(words, lambda word, at: F.when(word.isin(ANCHORS), at).otherwise(F.lit(-1))), lambda at: at >= 0
            ),
        }
    )

    def signature(at: Column, before: Column) -> Column:
        # Of the words ahead of this spot, ``before`` are anchors, so content goes on at their difference.
        following = [F.get(content, at - before + i) for i in range(chain)]
        anchored = F.get(words, at)
        for word in following:
            anchored = F.concat(anchored, F.lit(" "), word)
        return _hash(anchored)

    chains = F.filter(F.transform(spots, signature), lambda value: value.isNotNull())
    signed = marked.withColumn(found, F.sort_array(F.array_distinct(chains)))
    alone = F.when(F.size(words) > 0, F.array(_hash(F.concat_ws(" ", words)))).otherwise(F.array().cast("array<long>"))
    return signed.withColumn(name, F.when(F.size(found) > 0, F.col(found)).otherwise(alone)).drop(words, content, spots, found)


def length_partition(signatures: Column, similarity: float = SIMILARITY) -> Column:
    """Sets as similar as the bound lie in the same or in neighbouring partitions; -1: the empty set."""
    size = F.size(signatures)
    return F.when(size == 0, -1).otherwise(F.floor(F.log(size.cast("double")) / F.log(F.lit(1 / similarity)) + 1e-9).cast("int"))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two sets; equal ones, and those of which one is empty, are not intersected."""
    common = F.size(F.array_intersect(a, b))
    jaccard = common / (F.size(a) + F.size(b) - common)
    return F.when(a == b, 1.0).when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(jaccard)


def alike(a: Column, b: Column, similarity: float = SIMILARITY) -> Column:
    """Whether two sets reach the similarity, by their lengths first and only then by their members."""
    near = F.abs(length_partition(a, similarity) - length_partition(b, similarity)) <= 1
    sizes = F.least(F.size(a), F.size(b)) >= F.greatest(F.size(a), F.size(b)) * similarity - 1e-9
    return F.when(near & sizes, likeness(a, b) >= similarity - 1e-9).otherwise(False)


def fingerprint(signatures: Column) -> Column:
    """A digest of the set."""
    return F.md5(F.array_join(signatures.cast("array<string>"), ","))


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", chain: int = CHAIN) -> DataFrame:
    """(doc_id, text, n_chars, signatures, fingerprint, length_partition) of every row."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"))
    signed = with_signatures(rows, "text", "signatures", chain)
    return signed.select(
        "doc_id",
        "text",
        F.length("text").cast("long").alias("n_chars"),
        "signatures",
        fingerprint(F.col("signatures")).alias("fingerprint"),
        length_partition(F.col("signatures")).alias("length_partition"),
    )


def _bucket(doc_id: str, cuts: list) -> Column:
    """How many cut points, given in descending order, lie above the id; one more without an id.

    Two short searches, so that thousands of cut points cost a row little more than a hundred steps.
    """

    def above(points: Column) -> Column:
        return F.size(F.filter(points, lambda point: point > F.col(doc_id)))

    groups = F.from_json(F.lit(json.dumps(cuts[_STEP - 1 :: _STEP])), "array<long>")
    points = F.from_json(F.lit(json.dumps(cuts)), "array<long>")
    passed = above(groups) * _STEP
    return F.when(F.col(doc_id).isNull(), len(cuts) + 1).otherwise(passed + above(F.slice(points, passed + 1, F.lit(_STEP))))


def beside_next(rows: DataFrame, doc_id: str, columns: list[str], bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Adds ``next_<column>`` of the row after each, by descending id.

    Ids are cut into buckets by their quantiles, at most ``MOST_BUCKETS``; a bucket is sorted alone, and
    takes the first row of the bucket after it as a guest. One shuffle of the rows, and no order of
    all rows in one task. ``rows`` has whole-number ids and the column ``text``.
    """
    ids = rows.select(doc_id)
    count = ids.count()
    buckets = min(MOST_BUCKETS, max(1, count // bucket_rows))
    shares = [i / buckets for i in range(1, buckets)]
    quantiles = ids.agg(F.percentile_approx(doc_id, shares, 10_000).alias("cuts")).first().cuts if shares else []
    bucket = _bucket(doc_id, sorted(set(quantiles or []), reverse=True))
    firsts = ids.groupBy(bucket.alias("bucket")).agg(F.max(doc_id).alias("first")).orderBy("bucket").collect()
    hosts = [(row.first, before.bucket) for row, before in zip(firsts, firsts[-1:] + firsts[:-1], strict=True)]
    kind = f"array<struct<_first: {rows.schema[doc_id].dataType.simpleString()}, _host: int>>"
    listed = json.dumps([{"_first": first, "_host": host} for first, host in hosts])
    guests = F.broadcast(rows.sparkSession.range(1).select(F.inline(F.from_json(F.lit(listed), kind))))
    placed = rows.join(guests, F.col(doc_id).eqNullSafe(F.col("_first")), "left")
    own = F.struct(bucket.alias("bucket"), F.lit(False).alias("guest"))
    guest = F.struct(F.col("_host").alias("bucket"), F.lit(True).alias("guest"))
    places = F.when(F.col("_host").isNull(), F.array(own)).otherwise(F.array(own, guest))
    sent = placed.select(*rows.columns, F.explode(places).alias("_place"))
    order = Window.partitionBy("_place.bucket").orderBy("_place.guest", F.desc_nulls_last(doc_id), "text")
    following = sent.withColumns({f"next_{name}": F.lead(name).over(order) for name in columns})
    return following.filter(~F.col("_place.guest")).drop("_place")


def edited(signed: DataFrame, chain: int = CHAIN) -> DataFrame:
    """Rows of ``fingerprints`` beside the next row's, and an edited text with its signatures.

    In the edited text the last half of the code points is replaced by the first of the next text.
    """
    paired = beside_next(signed, "doc_id", ["text", "signatures"])
    half = F.floor(F.col("n_chars") / 2).cast("int")
    kept = F.substr("text", F.lit(1), F.col("n_chars").cast("int") - half)
    changed = paired.withColumn("edited_text", F.concat(kept, F.substr("next_text", F.lit(1), half)))
    return with_signatures(changed.drop("text", "next_text"), "edited_text", "edited_signatures", chain)
