"""Ranked lexical search: branch and bound over FP-trees of documents.

The items of a block give the vocabulary. A document becomes the vector of the block's terms that it
holds, the terms in falling document frequency, so that documents which share their frequent terms
share a path of the tree. A task builds one tree after another from its documents, each over a bounded
number of postings. A node knows, for every term below it, the largest tf, and the smallest m: that
bounds the score of each document below it. Per item the tree is walked depth first, the child with
the highest bound first; a subtree whose bound does not reach the item's 50th score so far is cut, and
what is left of a path is scored exactly. The best rows of all tasks are ranked at the end.

The score of a document is the sum over the item's terms of ``w * ((10**9 * tf) // (1000 * tf + 20 * m))``
with ``w = floor(1000 * ln((2N + 2) / (2 df + 1)))`` and ``m = 50 + (50 * n * N) // L``; it grows with tf
and falls with m, so largest tf and smallest m give a bound. Terms are counted over all documents.

Held at once: a task holds a block's items (``BLOCK_BYTES`` of text) and one tree (``TREE_POSTINGS``), the
driver a block's items and the document frequencies of their terms. More items take more blocks,
each one a scan of the documents.

Defined cases: null and empty texts and items have no terms; such an item has no rows, such a document
does not count for N. Repeated rows of documents or items are documents and items of their own. Equal
scores are ranked by document id, rows without an id last. Other columns are not read.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from restock.llm.common import as_bytes, written

BEST = 50
BLOCK_BYTES = 4_000_000
TREE_POSTINGS = 1_000_000
# Neighbours in the tree's order that are scored together; paths are not followed deeper than this.
LEAF = 16
DEEPEST = 64

# Everything that is no part of a term becomes a space, A to Z small letters.
_SMALL = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_SMALL).split()


class Block:
    """Items, their distinct terms by number, and each item's terms as numbers."""

    def __init__(self, items: list[tuple[int | None, str]]) -> None:
        self.ids = [item_id for item_id, _ in items]
        found = [sorted(set(terms_of(text.encode("utf-8", "surrogatepass")))) for _, text in items]
        self.terms = {term: i for i, term in enumerate(sorted({term for terms in found for term in terms}))}
        self.items = [np.array([self.terms[term] for term in terms], np.int64) for terms in found]


def item_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[Block]:
    """The items in parts of about ``block_bytes`` of text, split by hash."""
    items = benchmark.select("item_id", "text").filter("text IS NOT NULL")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = -(-size // block_bytes)
    for part in range(count):
        chosen = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == part).collect()
        yield Block(sorted(((row.item_id, row.text) for row in chosen), key=lambda x: (x[0] is None, x[0] or 0, x[1])))


def _vectors(terms: dict[bytes, int]):
    """(doc_id, n, terms, tfs) of all documents that hold a term of any kind."""

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sizes, held, tfs = [], [], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1).to_pylist()), strict=True):
                words = terms_of(text)
                if words:
                    counts = [(terms[word], tf) for word, tf in Counter(words).items() if word in terms]
                    ids.append(doc_id)
                    sizes.append(len(words))
                    held.append([term for term, _ in counts])
                    tfs.append([tf for _, tf in counts])
            lists = [pa.array(held, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int64()))]
            columns = [pa.array(ids, batch.column(0).type), pa.array(sizes, pa.int64()), *lists]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "terms", "tfs"])

    return vectors


def gains(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


class Tree:
    """An FP-tree over document vectors, its nodes numbered level by level so that siblings are neighbours."""

    def __init__(self, starts: np.ndarray, terms: np.ndarray, tfs: np.ndarray, m: np.ndarray, rank: np.ndarray) -> None:
        """``starts`` bounds each document's postings; ``rank`` orders terms by falling frequency."""
        self.order, self.starts, places = _by_path(starts, rank[terms])
        self.terms, tfs, self.m = terms[places], tfs[places], m[self.order]
        sizes = np.diff(self.starts)
        self.gains = gains(tfs, np.repeat(self.m, sizes))
        self._grow(rank[self.terms])
        self._bound(tfs, sizes)

    def _grow(self, path: np.ndarray) -> None:
        """Nodes as ranges of documents; a node's children are the numbers from ``first`` to ``last``."""
        low, high, depth, first, last, parent = [0], [len(self.order)], [0], [0], [0], [-1]
        starts, lengths = self.starts, np.diff(self.starts)
        at = 0
        while at < len(low):
            a, b, d = low[at], high[at], depth[at]
            if b - a > LEAF and d < DEEPEST:
                # Documents are in order, so what the first and the last one share, all share.
                most = min(lengths[a], lengths[b - 1], DEEPEST)
                one, other = path[starts[a] : starts[a] + most], path[starts[b - 1] : starts[b - 1] + most]
                apart = np.flatnonzero(one[d:most] != other[d:most])
                d = d + int(apart[0]) if len(apart) else most
                step = np.full(b - a, -1, np.int64)
                longer = np.flatnonzero(lengths[a:b] > d)
                step[longer] = path[starts[a:b][longer] + d]
                cuts = a + 1 + np.flatnonzero(step[1:] != step[:-1])
                if len(cuts) and d < DEEPEST:
                    first[at] = len(low)
                    ends, begin = [*cuts.tolist(), b], a
                    for end, after in zip(ends, [*ends[1:], None], strict=True):
                        # Small neighbours share a node.
                        if after is None or after - begin > LEAF:
                            for values, value in zip((low, high, depth, first, last, parent), (begin, end, d, 0, 0, at), strict=True):
                                values.append(value)
                            begin = end
                    last[at] = len(low)
            at += 1
        self.low, self.high = np.array(low), np.array(high)
        self.first, self.last, self.parent = first, last, np.array(parent)

    def _bound(self, tfs: np.ndarray, sizes: np.ndarray) -> None:
        """Per node the terms below it with the gain of their largest tf at the smallest m."""
        count, width = len(self.low), int(self.terms.max()) + 1 if len(self.terms) else 1
        leaves = np.array([i for i in range(count) if self.first[i] == self.last[i]])
        leaf_of = np.empty(len(self.order), np.int64)
        for i in leaves.tolist():
            leaf_of[self.low[i] : self.high[i]] = i
        least = np.array([self.m[a:b].min() for a, b in zip(self.low, self.high, strict=True)])
        keys, most = _largest(np.repeat(leaf_of, sizes) * width + self.terms, tfs)
        every_key, every_most = [keys], [most]
        levels = self._levels()
        for level in range(levels.max(), 0, -1):
            at = levels[keys // width] == level
            up = self.parent[keys[at] // width] * width + keys[at] % width
            more, larger = _largest(up, most[at])
            every_key.append(more)
            every_most.append(larger)
            keys, most = np.concatenate([keys[~at], more]), np.concatenate([most[~at], larger])
        keys, most = np.concatenate(every_key), np.concatenate(every_most)
        order = np.argsort(keys, kind="stable")
        keys, most = keys[order], most[order]
        nodes = keys // width
        self.node_terms, self.node_gains = keys % width, gains(most, least[nodes])
        self.node_starts = np.searchsorted(nodes, np.arange(count + 1))

    def _levels(self) -> np.ndarray:
        levels = np.zeros(len(self.low), np.int64)
        for i in range(1, len(levels)):
            levels[i] = levels[self.parent[i]] + 1
        return levels

    def search(self, weights: np.ndarray, best: Best) -> None:
        """Offers the documents that can be among the best; ``weights`` holds the item's, 0 for other terms."""
        open_nodes = [(0, None)]
        while open_nodes:
            node, bound = open_nodes.pop()
            if bound is not None and not best.can_take(bound):
                continue
            first, last = self.first[node], self.last[node]
            if first == last:
                scores = _sums(weights, self.terms, self.gains, self.starts[self.low[node] : self.high[node] + 1])
                best.offer(scores, self.order[self.low[node] : self.high[node]])
                continue
            bounds = _sums(weights, self.node_terms, self.node_gains, self.node_starts[first : last + 1])
            rising = np.argsort(bounds, kind="stable")
            open_nodes += [(first + int(i), int(bounds[i])) for i in rising if best.can_take(bounds[i])]


def _sums(weights: np.ndarray, terms: np.ndarray, gained: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sum of weight times gain over each range of postings."""
    a, b = starts[0], starts[-1]
    running = np.concatenate([[0], np.cumsum(weights[terms[a:b]] * gained[a:b])])
    return running[starts[1:] - a] - running[starts[:-1] - a]


def _largest(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return keys, values
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[starts], np.maximum.reduceat(values, starts)


def _by_path(starts: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents in the order of their paths: their numbers, where their postings begin now, and which."""
    sizes = np.diff(starts)
    places = np.lexsort((ranks, np.repeat(np.arange(len(sizes)), sizes)))
    sorted_ranks = ranks[places].astype(">u4")
    paths = [sorted_ranks[a:b].tobytes() for a, b in zip(starts[:-1], starts[1:], strict=True)]
    order = np.array(sorted(range(len(paths)), key=paths.__getitem__), np.int64)
    begin = np.concatenate([[0], np.cumsum(sizes[order])])
    moved = np.concatenate([places[starts[i] : starts[i + 1]] for i in order]) if len(order) else places
    return order, begin, moved


class Best:
    """The highest scores of an item so far, of equal ones the smaller ids; ids of None count as the largest."""

    def __init__(self, count: int = BEST) -> None:
        self.count, self.heap, self.ids = count, [], None

    def can_take(self, bound: int) -> bool:
        return bound > 0 and (len(self.heap) < self.count or bound >= self.heap[0][0])

    def offer(self, scores: np.ndarray, documents: np.ndarray) -> None:
        least = self.heap[0][0] if len(self.heap) >= self.count else 1
        for i in np.flatnonzero(scores >= max(1, least)):
            doc_id = self.ids[documents[i]]
            held = (int(scores[i]), -math.inf if doc_id is None else -doc_id)
            if len(self.heap) < self.count:
                heapq.heappush(self.heap, held)
            elif held > self.heap[0]:
                heapq.heapreplace(self.heap, held)


def _searched(block: Block, weights: np.ndarray, documents: int, terms: int, best_rows: int):
    """The best documents of a task for every item of the block."""
    rank = np.empty(len(weights), np.int64)
    rank[np.argsort(weights, kind="stable")] = np.arange(len(weights))  # a low weight is a high frequency

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [Best(best_rows) for _ in block.items]
        asked = np.zeros(len(weights), np.int64)
        waiting: list[pa.RecordBatch] = []
        postings = 0

        def search() -> None:
            rows = pa.Table.from_batches(waiting).combine_chunks()
            waiting.clear()
            held, tfs = rows.column("terms").combine_chunks(), rows.column("tfs").combine_chunks()
            m = 50 + (50 * rows.column("n").to_numpy() * documents) // terms
            starts = held.offsets.to_numpy().astype(np.int64)
            flat = held.values.to_numpy().astype(np.int64), tfs.values.to_numpy()
            tree = Tree(starts, *flat, m, rank)
            ids = rows.column("doc_id").to_pylist()
            for item, best in zip(block.items, found, strict=True):
                best.ids = ids
                asked[item] = weights[item]
                tree.search(asked, best)
                asked[item] = 0

        for batch in batches:
            if batch.num_rows:
                waiting.append(batch)
            postings += len(batch.column("terms").flatten())
            if postings >= TREE_POSTINGS:
                search()
                postings = 0
        if waiting:
            search()
        rows = [(i, None if held[1] == -math.inf else -held[1], held[0]) for i, best in enumerate(found) for held in best.heap]
        columns = [pa.array(column, pa.int64()) for column in zip(*rows, strict=True)] if rows else [pa.array([], pa.int64())] * 3
        yield pa.RecordBatch.from_arrays(columns, names=["item", "doc_id", "score"])

    return searched


def ranked(docs: DataFrame, benchmark: DataFrame, best: int = BEST, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): every item's highest-scoring documents with a score above 0."""
    spark, kind = docs.sparkSession, benchmark.schema["item_id"].dataType.simpleString()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = None
    for block in item_blocks(benchmark, block_bytes):
        if not block.terms:
            continue
        vectors = written(rows.mapInArrow(_vectors(block.terms), "doc_id long, n long, terms array<int>, tfs array<long>"))
        total = vectors.agg(F.count(F.lit(1)).alias("documents"), F.sum("n").alias("terms")).first()
        if not total.documents:
            break
        df = np.zeros(len(block.terms), np.int64)
        counts = vectors.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")).toPandas()
        df[counts["term"].to_numpy(np.int64)] = counts["df"]
        weights = np.array([math.floor(1000 * math.log((2 * total.documents + 2) / (2 * int(n) + 1))) for n in df], np.int64)
        task = _searched(block, weights, total.documents, total.terms, best)
        mine = vectors.mapInArrow(task, "item long, doc_id long, score long")
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        top = mine.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= best)
        names = spark.createDataFrame(list(enumerate(block.ids)), f"item long, item_id {kind}")
        named = top.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
        found = named if found is None else found.unionByName(named)
    if found is None:
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    return found
