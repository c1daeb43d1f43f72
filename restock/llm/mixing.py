"""Mixing sources to target weights by Pfair scheduling.

Every source is cut into blocks of ``BLOCK_ROWS`` documents. With weight w of a sum of W, block i of a
source is released at floor(i*W/w) and due at ceil((i+1)*W/w), in whole numbers without rounding of the
weights; the earliest due block among the released ones takes the slot. So at every slot of a phase
each source is less than one block away from its weight, however long the phase is.

The schedule depends on all earlier slots and is worked out on the driver, which holds one entry for
each source and ``CHUNK`` blocks at a time; the blocks become a stored table that documents are joined
with. Its time grows with the blocks: rows divided by ``BLOCK_ROWS``.

A source that runs out ends a phase; the others go on at their weights, taken anew to a sum of one,
and the deviation counts from the start of the phase. Every document gets exactly one slot.

Documents of a source are ordered by a hash. Their ranks come from counts per (source, hash bucket),
so a source of any size is spread over buckets.

Defined cases: a null source is a source of its own. Sources without a positive weight come after all
others, in equal shares. Rows that repeat get slots of their own. A last block may be short.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from fractions import Fraction
from itertools import islice

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from restock.llm.common import fresh, identified, ready, written

BLOCK_ROWS = 16
BUCKETS = 4_096
CHUNK = 500_000
TEMPER = 0.5

_FIELDS = ("source", "block", "slot", "phase", "release", "deadline")
_TABLE = "source string, block long, slot long, phase int, release long, deadline long"


def whole(weights: dict[str, float]) -> dict[str, int]:
    """The weights times one number that makes all of them whole; nothing is rounded."""
    exact = {source: Fraction(weight) for source, weight in weights.items()}
    scale = math.lcm(*{weight.denominator for weight in exact.values()})
    return {source: weight.numerator * (scale // weight.denominator) for source, weight in exact.items()}


def placed(blocks: dict[str, int], weights: dict[str, float]) -> Iterator[tuple[str, int, int, int, int, int]]:
    """Source, block, slot, phase, release and deadline of every block, by slot.

    Sources that have no block in a phase yet are all released and wait by weight, so that a new phase
    touches only the sources of the one before.
    """
    number = start = 0
    wanted = {source: weights.get(source, 0.0) for source, count in blocks.items() if count}
    for group in (
        {source: weight for source, weight in wanted.items() if weight > 0},
        dict.fromkeys((source for source, weight in wanted.items() if not weight > 0), 1.0),
    ):
        weight = whole(group)
        total = sum(weight.values())
        done = dict.fromkeys(weight, 0)
        new = [(-own, source) for source, own in weight.items()]
        heapq.heapify(new)
        while new:
            waiting: list[tuple[int, str]] = []
            due: list[tuple[int, str]] = []
            turn: dict[str, int] = {}
            slot = 0
            while True:
                while waiting and waiting[0][0] <= slot:
                    _, source = heapq.heappop(waiting)
                    heapq.heappush(due, (-(-(turn[source] + 1) * total // weight[source]), source))
                deadline = -(-total // -new[0][0]) if new else 0
                if new and (not due or deadline <= due[0][0]):
                    _, source = heapq.heappop(new)
                    turn[source] = 0
                else:
                    deadline, source = heapq.heappop(due)
                i = turn[source]
                release = i * total // weight[source]
                yield source, done[source], start + slot, number, start + release, start + deadline
                done[source] += 1
                slot += 1
                if done[source] == blocks[source]:
                    break
                turn[source] = i + 1
                heapq.heappush(waiting, ((i + 1) * total // weight[source], source))
            total -= weight[source]
            del turn[source]
            for other in turn:
                heapq.heappush(new, (-weight[other], other))
            start += slot
            number += 1


def _block_table(spark: SparkSession, rows: Iterator[tuple]) -> DataFrame:
    """The blocks as a stored table; the driver holds a chunk at a time."""
    table = spark.createDataFrame([], _TABLE)
    while chunk := list(islice(rows, CHUNK)):
        table = table.unionByName(written(spark.createDataFrame(pd.DataFrame(chunk, columns=_FIELDS), _TABLE)))
    return table


def tempered(counts: dict[str, int], power: float = TEMPER) -> dict[str, float]:
    """Weights that even out large and small sources: rows to a power below one."""
    return {source: count**power for source, count in counts.items()}


def mixed(
    docs: DataFrame, weights: dict[str, float] | None = None, source: str = "source", block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """The documents with ``mix_block``, ``mix_slot``, ``mix_phase``, ``mix_release`` and ``mix_deadline``.

    Without ``weights`` the targets are ``tempered``. Columns of these names in the input are replaced.
    """
    spark = ready(docs.sparkSession)
    docs = docs.drop("mix_block", "mix_slot", "mix_phase", "mix_release", "mix_deadline")
    names = ("_source", "_mark", "_bucket", "_rank", "_n", "_before", "_of", "_plan", "_row")
    key, mark, bucket, rank, n, before, of, place, row = (fresh(docs, name) for name in names)
    rows = identified(docs, row)
    # Slots are worked out on narrow rows, and only then joined to the documents. A null source is told
    # from every text by a leading sign.
    keyed = rows.select(
        row,
        F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("-")).alias(key),
        F.xxhash64(*docs.columns).alias(mark),
    ).withColumn(bucket, F.pmod(mark, F.lit(BUCKETS)))
    keyed = written(keyed)
    counts = written(keyed.groupBy(key, bucket).agg(F.count(F.lit(1)).alias(n)))
    sizes = {found[0]: found[1] for found in counts.groupBy(key).agg(F.sum(n)).collect()}
    targets = {f"={name}": weight for name, weight in weights.items()} if weights else tempered(sizes)
    table = _block_table(spark, placed({name: -(-count // block_rows) for name, count in sizes.items()}, targets))
    table = table.select(F.col("source").alias(of), F.struct(*_FIELDS[1:]).alias(place))

    inside = Window.partitionBy(key, bucket).orderBy(mark, row)
    earlier = Window.partitionBy(key).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(key, bucket, F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(before))
    ranked = keyed.withColumn(rank, F.row_number().over(inside)).join(offsets, [key, bucket])
    block = F.floor((F.col(rank) + F.col(before) - 1) / block_rows).cast("long")
    part = F.col(place)
    slots = ranked.withColumn("mix_block", block).join(
        table, (F.col(key) == F.col(of)) & (F.col("mix_block") == part["block"])
    )
    mixed_as = slots.select(
        row,
        "mix_block",
        part["slot"].alias("mix_slot"),
        part["phase"].alias("mix_phase"),
        part["release"].alias("mix_release"),
        part["deadline"].alias("mix_deadline"),
    )
    return rows.join(mixed_as, row).drop(row)
