"""Benchmark decontamination: pigeonhole pieces find candidates, Myers' bit-parallel distance verifies them.

Items and documents are read as words (letters and digits, case folded). An item of m words may occur
with up to ``error_rate`` * m words inserted, dropped or replaced. It is cut into one piece more than
that budget, so at least one piece occurs unchanged. One automaton over all pieces finds the hits in a
document; around each hit the item is aligned by the bit-parallel method, one step per word.

The items are read in blocks of bounded size, split by hash; documents are scanned once per block.

Defined cases: null or wordless items match nothing, null texts hold nothing. Items below
``SHORT_ITEM`` words must occur unchanged. Equal items are looked for once and reported under each of
their ids; rows that repeat are reported for each row. An empty benchmark gives no hits.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ERROR_RATE = 0.2
SHORT_ITEM = 5
BLOCK_BYTES = 8 << 20
HIT = "array<struct<item_id: bigint, distance: int, start: int, end: int>>"

_WORD = re.compile(r"\w+")
_built: dict[int, Matcher] = {}


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.casefold()) if text else []


def budget(size: int, error_rate: float = ERROR_RATE) -> int:
    return int(size * error_rate) if size >= SHORT_ITEM else 0


def pieces(size: int, count: int) -> list[tuple[int, int]]:
    """Bounds of ``count`` pieces of nearly equal size."""
    cuts = [size * i // count for i in range(count + 1)]
    return list(zip(cuts, cuts[1:]))  # noqa: B905


def best_end(pattern: list[str], window: list[str], limit: int) -> tuple[int, int] | None:
    """Least distance of the pattern to a stretch of the window and the first end that has it."""
    size = len(pattern)
    places: dict[str, int] = {}
    for i, word in enumerate(pattern):
        places[word] = places.get(word, 0) | 1 << i
    mask, top = (1 << size) - 1, 1 << (size - 1)
    rises, falls, distance = mask, 0, size
    best = None
    for end, word in enumerate(window, 1):
        equal = places.get(word, 0)
        diagonal = equal | falls
        across = (((equal & rises) + rises) ^ rises) | equal
        up = falls | (mask & ~(across | rises))
        down = rises & across
        if up & top:
            distance += 1
        elif down & top:
            distance -= 1
        up, down = (up << 1) & mask, (down << 1) & mask
        rises, falls = down | (mask & ~(diagonal | up)), up & diagonal
        if distance <= limit and (best is None or distance < best[0]):
            best = distance, end
    return best


class Matcher:
    """All items of one block."""

    def __init__(self, items: list[tuple[int, str]], error_rate: float):
        same: dict[tuple[str, ...], list[int]] = {}
        for item_id, text in items:
            found = tuple(words_of(text))
            if found:
                same.setdefault(found, []).append(item_id)
        self.items = [(list(found), sorted(ids), budget(len(found), error_rate)) for found, ids in sorted(same.items())]
        owners: dict[str, list[tuple[int, int]]] = {}
        for number, (found, _, errors) in enumerate(self.items):
            for start, stop in pieces(len(found), errors + 1):
                owners.setdefault(f" {' '.join(found[start:stop])} ", []).append((number, start))
        self.automaton = ahocorasick.Automaton()
        for piece, places in owners.items():
            self.automaton.add_word(piece, (len(piece), places))
        if owners:
            self.automaton.make_automaton()

    def windows(self, text: list[str]) -> Iterator[tuple[int, int, int]]:
        """(item, start, stop) of the stretches of the text where the item may occur, joined if they meet."""
        joined = f" {' '.join(text)} "
        starts, at = [], 1
        hits: dict[int, list[int]] = {}
        for last, (size, places) in self.automaton.iter(joined):
            if not starts:
                for word in text:
                    starts.append(at)
                    at += len(word) + 1
            word_at = bisect_right(starts, last - size + 2) - 1
            for number, offset in places:
                hits.setdefault(number, []).append(word_at - offset)
        for number, begins in hits.items():
            found, _, errors = self.items[number]
            low = high = None
            for begin in sorted(begins):
                a, b = max(0, begin - errors), min(len(text), begin + len(found) + errors)
                if high is not None and a <= high:
                    high = max(high, b)
                else:
                    if high is not None:
                        yield number, low, high
                    low, high = a, b
            yield number, low, high

    def find(self, text: list[str]) -> list[dict]:
        """The best occurrence of every item in the text, in words of it."""
        if not text or not self.items:
            return []
        best: dict[int, tuple[int, int, int]] = {}
        for number, low, high in self.windows(text):
            found, _, errors = self.items[number]
            forward = best_end(found, text[low:high], errors)
            if forward is None:
                continue
            distance, end = forward
            backward = best_end(found[::-1], text[low : low + end][::-1], distance)
            stop = low + end
            occurrence = distance, stop - backward[1], stop
            best[number] = min(best.get(number, occurrence), occurrence)
        rows = []
        for number, (distance, start, end) in best.items():
            rows += [{"item_id": i, "distance": distance, "start": start, "end": end} for i in self.items[number][1]]
        return sorted(rows, key=lambda row: row["item_id"])


def _matcher(key: int, items: list[tuple[int, str]], error_rate: float) -> Matcher:
    if key not in _built:
        _built.clear()
        _built[key] = Matcher(items, error_rate)
    return _built[key]


def _occurrences(items: list[tuple[int, str]], error_rate: float):
    key = hash((tuple(items), error_rate))

    @F.pandas_udf(HIT)
    def occurrences(texts: pd.Series) -> pd.Series:
        matcher = _matcher(key, items, error_rate)
        return pd.Series([matcher.find(words_of(text)) for text in texts], dtype=object)

    return occurrences


def item_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple[int, str]]]:
    """The items in parts of about ``block_bytes``, split by hash; each part is what a task holds at once."""
    items = benchmark.filter(F.col("text").isNotNull() & F.col("item_id").isNotNull()).select(
        F.col("item_id").cast("long").alias("item_id"), "text"
    )
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = -(-size // block_bytes)
    for part in range(count):
        chosen = items.filter(F.pmod(F.xxhash64("text"), F.lit(count)) == part).distinct()
        yield sorted((row.item_id, row.text) for row in chosen.collect())


def occurrences(
    docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """(doc_id, item_id, distance, start, end): the best occurrence of each item in each document."""
    found = None
    for items in item_blocks(benchmark, block_bytes):
        hits = F.explode(_occurrences(items, error_rate)("text")).alias("hit")
        rows = docs.select("doc_id", hits).select("doc_id", "hit.*")
        found = rows if found is None else found.unionByName(rows)
    if found is None:
        none = F.explode(F.from_json(F.lit("[]"), HIT)).alias("hit")
        return docs.select("doc_id", none).select("doc_id", "hit.*")
    return found


def clean(docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents in which no item occurs, unchanged."""
    free: Column = F.lit(True)
    for items in item_blocks(benchmark, block_bytes):
        free = free & (F.size(_occurrences(items, error_rate)("text")) == 0)
    return docs.filter(free)
