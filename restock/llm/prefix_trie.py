"""Conversation prefix trie: which opening turns conversations share, and what sharing saves.

Every conversation is a path of turns, and a turn is known by MD5 of role and text and by its length.
Equal paths are one class with a count. Classes are range-partitioned by path, so a shard is a run of
neighbouring paths, and a trie node that lies in more than one shard is a prefix of a path at which
two shards part. These nodes are the skeleton. Only their shape is broadcast: per shard, how many
turns its first path shares with the shard before and its last path with the shard after, three
numbers a shard, whatever the paths' lengths.

A shard's sorted classes are streamed once, with the open nodes on a stack. A node that lies in the
shard alone is finished there; of a skeleton node the shard gives a partial aggregate. Partial
aggregates are summed by node, named by its first shard and depth, and as that order is the
trie's own, the sums over subtrees are differences of running totals over shards.

The digest of the ids that end at a node is streamed: ids are joined to pieces of a bounded range of
ids, and one class's pieces are read in order.

Defined cases: a null role or text is empty. Turns are ordered by number, nulls first, then by role and
MD5. A conversation's first ``h`` turns are replaced by those of conversation ``c - c % SHARED_BY``
(the remainder has the sign of ``c``); none if there is none. Rows without conv_id are one conversation
without a decimal form: it shares no turns, counts as a member, is never the smallest one unless alone
and adds no id to a digest. Rows that repeat are turns of their own. No rows give no nodes. Other
columns are not read. A path takes 40 bytes a turn in a row, whatever the texts' lengths.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from restock.llm.common import written

SHARED_BY = 100
MOST_SHARED = 5
# A turn in a path: 32 digits of MD5 and 8 of its length.
TURN = 40
# Ids of one class are joined in pieces of so many consecutive numbers.
PIECE = 4096
_NO_IDS = hashlib.sha256(b"").hexdigest()

# What a shard gives. A finished node names its parent's id, or the parent's first shard if that is a
# skeleton node; a partial one names itself by its first shard, ``start``.
_GIVEN = {
    "conv_id": pa.int64(), "depth": pa.int64(), "chars": pa.int64(), "n_convs": pa.int64(), "n_children": pa.int64(),
    "n_leaves": pa.int64(), "saved_tokens": pa.int64(), "ends": pa.string(), "parent_conv_id": pa.int64(),
    "parent_start": pa.int32(), "start": pa.int32(), "shard": pa.int32(),
}
_SCHEMA = pa.schema(list(_GIVEN.items()))
_SQL_TYPES = {pa.int64(): "long", pa.int32(): "int", pa.string(): "string"}


def turn_key(role: Column, text: Column) -> Column:
    """Forty digits that tell a turn from others; they hold its length in code points."""
    told = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return F.concat(F.md5(told), F.lpad(F.hex(F.length(text)), 8, "0"))


def paths(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): every conversation's own turns in order, as keys."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = conversations.select("conv_id", F.struct("turn", role.alias("role"), turn_key(role, text).alias("key")).alias("turn"))
    grouped = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    return grouped.select("conv_id", F.col("turns.key").alias("turns"))


def rebuilt(own: DataFrame) -> DataFrame:
    """(conv_id, path): the first turns taken from the conversation that leads the hundred."""
    shared = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (MOST_SHARED + 1)
    heads = own.filter(F.col("conv_id") % SHARED_BY == 0).select(
        F.col("conv_id").alias("head_id"), F.slice("turns", 1, MOST_SHARED).alias("head")
    )
    asked = own.withColumns({"shared": F.coalesce(shared, F.lit(0)).cast("int"), "head_id": F.col("conv_id") - F.col("conv_id") % SHARED_BY})
    joined = asked.join(heads, "head_id", "left")
    taken = F.slice(F.coalesce("head", F.array().cast("array<string>")), F.lit(1), F.col("shared"))
    left = F.slice("turns", F.col("shared") + 1, F.greatest(F.size("turns"), F.lit(1)))
    return joined.select("conv_id", F.array_join(F.concat(taken, left), "").alias("path"))


def _end_digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """SHA-256 of each class's pieces, read in order; a class may go on in the next batch."""
    current, digest = None, None
    for batch in batches:
        rows = []
        for key, ids in zip(batch["key"], batch["ids"], strict=True):
            if key != current:
                if current is not None:
                    rows.append((current, digest.hexdigest()))
                current, digest = key, hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        yield pd.DataFrame(rows, columns=["key", "ends"])
    if current is not None:
        yield pd.DataFrame([(current, digest.hexdigest())], columns=["key", "ends"])


def _ends(rows: DataFrame) -> DataFrame:
    """(key, ends): the digest of the ids of every path, by MD5 of the path."""
    known = rows.filter(F.col("conv_id").isNotNull()).select(F.md5("path").alias("key"), "conv_id")
    piece = F.floor(F.col("conv_id") / PIECE).alias("piece")
    ids = F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids")
    pieces = known.groupBy("key", piece).agg(ids)
    ordered = pieces.repartition("key").sortWithinPartitions("key", "piece")
    return ordered.select("key", "ids").mapInPandas(_end_digests, "key string, ends string")


def classes(rows: DataFrame) -> DataFrame:
    """(path, conv_id, n, ends): every distinct path with its smallest id, its members and their digest."""
    counted = rows.groupBy("path").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n"))
    keyed = counted.withColumn("key", F.md5("path"))
    return keyed.join(_ends(rows), "key", "left").select("path", "conv_id", "n", F.coalesce("ends", F.lit(_NO_IDS)).alias("ends"))


def common_turns(a: str, b: str) -> int:
    """Turns that two paths share from the first on, found by halving."""
    low, high = 0, min(len(a), len(b)) // TURN
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if a[low * TURN : middle * TURN] == b[low * TURN : middle * TURN] else (low, middle - 1)
    return low


@F.pandas_udf(T.LongType())
def _common(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([-1 if x is None or y is None else common_turns(x, y) for x, y in zip(a, b, strict=True)], dtype="int64")


def sharded(rows: DataFrame, shards: int | None = None) -> DataFrame:
    """Classes with the number of their shard, written; a shard holds a run of neighbouring paths."""
    ranged = rows.repartitionByRange(shards, "path") if shards else rows.repartitionByRange("path")
    return written(ranged.sortWithinPartitions("path").withColumn("shard", F.spark_partition_id()))


def skeleton(placed: DataFrame) -> list[tuple[int, int, int]]:
    """(shard, turns shared by its last path and the next shard, turns shared by its first and last path).

    One row per shard comes to the driver; paths meet in tasks, two at a time.
    """
    ends = placed.groupBy("shard").agg(F.min("path").alias("first"), F.max("path").alias("last"))
    numbers = Window.orderBy("shard")
    numbered = ends.select("shard").withColumn("i", F.row_number().over(numbers))
    numbered = written(ends.join(F.broadcast(numbered), "shard"))
    following = numbered.select((F.col("i") - 1).alias("i"), F.col("first").alias("next"))
    found = numbered.join(following, "i", "left")
    met = found.select("shard", _common("last", "next").alias("after"), _common("first", "last").alias("within"))
    return [tuple(row) for row in met.orderBy("shard").collect()]


def _starts(shape: list[tuple[int, int, int]]) -> list[list[tuple[int, int]]]:
    """Per shard the skeleton nodes on its first path, as runs (deepest, first shard) in rising depth.

    A node goes on from the shard before if it lies on that shard's first and last path; the nodes
    below, down to what the two shards share, begin in the shard before.
    """
    runs: list[list[tuple[int, int]]] = [[]]
    for shard, after, within in shape[:-1]:
        known = runs[-1]
        most = min(after, within, known[-1][0] if known else -1)
        kept: list[tuple[int, int]] = []
        for deepest, start in known:
            if (kept[-1][0] if kept else -1) < most:
                kept.append((min(deepest, most), start))
        if after > most:
            kept.append((after, shard))
        runs.append(kept)
    return runs


class _Node:
    """An open node: what its members in the shard have given so far."""

    __slots__ = ("depth", "chars", "on_first", "conv", "n", "children", "leaves", "saved", "ends", "done")

    def __init__(self, depth: int, chars: int, on_first: bool) -> None:
        self.depth, self.chars, self.on_first = depth, chars, on_first
        self.conv: int | None = None
        self.ends: str | None = None
        self.n = self.children = self.leaves = self.saved = 0
        self.done: list[tuple] = []

    def add(self, conv: int | None, n: int) -> None:
        self.n += n
        if conv is not None and (self.conv is None or conv < self.conv):
            self.conv = conv


class _Shard:
    """The stack over one shard's sorted classes."""

    def __init__(self, shard: int, before: int, after: int, runs: list[tuple[int, int]], rows: list[tuple]) -> None:
        self.shard, self.before, self.after, self.runs, self.rows = shard, before, after, runs, rows
        self.path: str | None = None
        self.stack = [_Node(0, 0, True)]

    def add(self, path: str, conv: int | None, n: int, ends: str) -> None:
        first = self.path is None
        self.close_to(0 if first else common_turns(self.path, path), False)
        for depth in range(self.stack[-1].depth + 1, len(path) // TURN + 1):
            self.stack.append(_Node(depth, int(path[depth * TURN - 8 : depth * TURN], 16), first))
        self.stack[-1].add(conv, n)
        self.stack[-1].ends = ends
        self.path = path

    def close_to(self, depth: int, at_end: bool) -> None:
        while self.stack and self.stack[-1].depth > depth:
            self._close(at_end)

    def _start(self, node: _Node | None, at_end: bool) -> int | None:
        """First shard of a skeleton node, none for a node that lies in this shard alone."""
        if node is None:
            return None
        if node.on_first and node.depth <= self.before:
            return next(start for deepest, start in self.runs if node.depth <= deepest)
        return self.shard if at_end and node.depth <= self.after else None

    def _close(self, at_end: bool) -> None:
        node = self.stack.pop()
        parent = self.stack[-1] if self.stack else None
        start, parent_start = self._start(node, at_end), self._start(parent, at_end)
        if parent is not None:
            parent.add(node.conv, node.n)
        if start is not None:
            given = node.conv, node.depth, node.chars, node.n, node.children, node.leaves, node.saved, node.ends
            self.rows.append((*given, None, parent_start, start, self.shard))
            self.rows += [(*child, None, start, None, self.shard) for child in node.done]
            return
        saved, leaves = node.saved + (node.n - 1) * node.chars, node.leaves if node.children else 1
        self.rows += [(*child, node.conv, None, None, self.shard) for child in node.done]
        finished = node.conv, node.depth, node.chars, node.n, node.children, leaves, saved, node.ends
        if parent is None:
            self.rows.append((*finished, None, None, None, self.shard))
            return
        parent.children, parent.leaves, parent.saved = parent.children + 1, parent.leaves + leaves, parent.saved + saved
        parent.done.append(finished)


def _walk(shape: list[tuple[int, int, int]]):
    """Streams sorted classes of whole shards; gives finished nodes and partial skeleton nodes."""
    place = {shard: i for i, (shard, _, _) in enumerate(shape)}
    runs = _starts(shape)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        current: _Shard | None = None
        for batch in batches:
            for shard, path, conv, n, ends in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                if current is None or shard != current.shard:
                    if current is not None:
                        current.close_to(-1, True)
                    i = place[shard]
                    current = _Shard(shard, shape[i - 1][1] if i else -1, shape[i][1], runs[i], rows)
                current.add(path, conv, n, ends)
            yield _batch(rows)
        if current is not None:
            current.close_to(-1, True)
            yield _batch(rows)

    return walk


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(_GIVEN)
    rows.clear()
    arrays = [pa.array(column, kind) for column, kind in zip(columns, _GIVEN.values(), strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=_SCHEMA)


def _reduced(parts: DataFrame, shape: list[tuple[int, int, int]]) -> DataFrame:
    """Skeleton nodes from their partial aggregates, one row each, with sums over subtrees.

    Ordered by (first shard, depth) the nodes are in the trie's order, parents first. The subtree of a
    node that begins in shard s and ends in shard e is what is as deep in s, and what begins between.
    """
    spark = parts.sparkSession
    nodes = parts.groupBy("start", "depth").agg(
        F.min("conv_id").alias("conv_id"),
        F.max("chars").alias("chars"),
        F.sum("n_convs").alias("n_convs"),
        F.sum("n_children").alias("n_local"),
        F.sum("n_leaves").alias("leaves"),
        F.sum("saved_tokens").alias("saved"),
        F.max("ends").alias("ends"),
        F.max("parent_start").alias("parent_start"),
        F.max("shard").alias("last"),
    )
    nodes = written(nodes.withColumn("saved", F.col("saved") + (F.col("n_convs") - 1) * F.col("chars")))
    listed = json.dumps([{"shard": shard} for shard, _, _ in shape])
    shards = spark.range(1).select(F.inline(F.from_json(F.lit(listed), "array<struct<shard: int>>")))
    begun = nodes.groupBy(F.col("start").alias("shard")).agg(F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves"))
    up_to = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = {name: F.sum(F.coalesce(name, F.lit(0))).over(up_to) for name in ("saved", "leaves")}
    totals = shards.join(begun, "shard", "left").select(
        "shard",
        *[sums[name].alias(f"{name}_with") for name in sums],
        *[(sums[name] - F.coalesce(name, F.lit(0))).alias(f"{name}_before") for name in sums],
    )
    totals = written(totals)
    at_start = F.broadcast(totals.select(F.col("shard").alias("start"), "saved_with", "leaves_with"))
    at_last = F.broadcast(totals.select(F.col("shard").alias("last"), "saved_before", "leaves_before"))
    deeper = Window.partitionBy("start").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    spread = nodes.join(at_start, "start").join(at_last, "last")
    below = nodes.filter("parent_start IS NOT NULL").groupBy(F.col("parent_start").alias("start"), (F.col("depth") - 1).alias("depth"))
    spread = spread.join(below.agg(F.count(F.lit(1)).alias("n_below")), ["start", "depth"], "left")
    return spread.select(
        "start",
        "depth",
        "conv_id",
        "parent_start",
        "n_convs",
        (F.col("n_local") + F.coalesce("n_below", F.lit(0))).alias("n_children"),
        (F.sum("leaves").over(deeper) + F.col("leaves_before") - F.col("leaves_with")).alias("n_leaves"),
        (F.sum("saved").over(deeper) + F.col("saved_before") - F.col("saved_with")).alias("saved_tokens"),
        "ends",
    )


def nodes(rows: DataFrame, shards: int | None = None) -> DataFrame:
    """All nodes of the trie of ``rows`` (conv_id, path), ``shards`` as the session has it if not given.

    Columns: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    """
    placed = sharded(classes(written(rows)), shards)
    shape = skeleton(placed)
    kinds = ", ".join(f"{name} {_SQL_TYPES[kind]}" for name, kind in _GIVEN.items())
    ordered = placed.repartitionByRange(max(1, len(shape)), "shard").sortWithinPartitions("shard", "path")
    given = written(ordered.select("shard", "path", "conv_id", "n", "ends").mapInArrow(_walk(shape), kinds))
    wide = written(_reduced(given.filter("start IS NOT NULL"), shape))
    measures = ["n_convs", "n_children", "n_leaves", "saved_tokens", "ends"]
    narrow = given.filter("start IS NULL").select("conv_id", "depth", "parent_start", "parent_conv_id", *measures)
    every = narrow.unionByName(wide.select("conv_id", "depth", "parent_start", F.lit(None).cast("long").alias("parent_conv_id"), *measures))
    parents = wide.select(
        F.col("start").alias("parent_start"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("wide_conv_id")
    )
    joined = every.join(parents, ["parent_start", "depth"], "left")
    return joined.select(
        "conv_id",
        "depth",
        F.coalesce("parent_conv_id", "wide_conv_id").alias("parent_conv_id"),
        *measures[:-1],
        F.coalesce("ends", F.lit(_NO_IDS)).alias("ends_sha256"),
    )
