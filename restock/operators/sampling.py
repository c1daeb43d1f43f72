"""Exact samplers. Orders are total and given as key columns; positions come from
:mod:`restock.operators.ordering`, so no group and no cap has to fit in one task."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from restock.functions.hashing import hash_text, hash_unit
from restock.operators.ordering import first_rows, ordered_position, running_total
from restock.session import materialise, never_broadcast


def resolve_cap(split: str, shared: int | None, per_split: dict[str, int] | None = None) -> int | None:
    """The cap of one split: its own before the shared one."""
    specific = (per_split or {}).get(split)
    cap = specific if specific is not None else shared
    if cap is not None and cap <= 0:
        raise ValueError("a row cap must be greater than zero")
    return cap


def split_caps(
    obs: DataFrame, order: list[str], shared: int | None, per_split: dict[str, int] | None = None
) -> DataFrame:
    """The first rows of each split up to its cap; splits without a cap stay whole."""
    from restock.schema import SPLITS

    train, evaluation = (
        sample_head(obs.filter(F.col("source_split") == split), order, cap)
        if (cap := resolve_cap(split, shared, per_split)) is not None
        else obs.filter(F.col("source_split") == split)
        for split in SPLITS
    )
    return train.unionByName(evaluation)


def sample_head(df: DataFrame, order: list[str], n: int) -> DataFrame:
    return first_rows(df, order, n)


def _by_file(df: DataFrame) -> DataFrame:
    """Rows of files with the place they have there; it does not depend on how files are split."""
    about = df.metadataColumn("_metadata")
    return df.select("*", *[about[name].alias(f"_{name}") for name in ("file_path", "file_name", "row_index")])


def sample_file_head(df: DataFrame, n: int) -> DataFrame:
    """The first n rows as they lie in the files, files by path. ``df`` is a scan of files."""
    return first_rows(_by_file(df), ["_file_path", "_row_index"], n).select(df.columns)


def sample_file_blocks(df: DataFrame, n: int, block_rows: int = 10_000, seed: int = 42) -> DataFrame:
    """n rows from random blocks of neighbouring rows: blocks in hash order, the last one cut where n is reached.

    Blocks are chosen from their sizes, for which no column of the rows is read; of the rows only those of
    chosen blocks are ordered.
    """
    placed = _by_file(df).withColumn("_block", F.floor(F.col("_row_index") / block_rows))
    block = ["_file_path", "_file_name", "_block"]
    sizes = placed.groupBy(*block).agg(F.count(F.lit(1)).alias("_rows")).withColumn("_hash", hash_text(seed, block[1:]))
    reached = running_total(sizes, ["_hash", "_file_path", "_block"], "_rows", "_reached")
    chosen = reached.filter(F.col("_reached") - F.col("_rows") < n).select("_file_path", "_block", "_reached")
    return first_rows(placed.join(chosen, ["_file_path", "_block"]), ["_reached", "_row_index"], n).select(df.columns)


def _exact(value: Column) -> Column:
    """Products of two row counts can pass 64 bits."""
    return value.cast("decimal(19,0)")


def is_evenly_spaced(rank: Column, count: Column, quota: Column) -> Column:
    """Whether a 0-based rank is one of floor((i + 0.5) * count / quota) for i in 0..quota-1.

    The number of those ranks up to r is floor(ceil(2 quota (r + 1) / count) / 2), in whole numbers;
    r is one of them where that number grows.
    """

    def chosen_up_to(steps: Column) -> Column:
        product = _exact(2 * quota) * _exact(steps)
        rounded_up = F.floor((product + _exact(count) - 1) / _exact(count)).cast("bigint")
        return F.floor(rounded_up / 2)

    return (quota >= count) | (chosen_up_to(rank + 1) > chosen_up_to(rank))


def sample_even(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """n rows spread evenly over the order; everything when n reaches the number of rows."""
    placed = ordered_position(df, order, "_rank")
    count = placed.agg(F.count(F.lit(1))).scalar()
    return placed.withColumn("_count", count).filter(
        is_evenly_spaced(F.col("_rank"), F.col("_count"), F.lit(n).cast("bigint"))
    ).drop("_rank", "_count")


def stratified_quota(sizes: DataFrame, groups: list[str], n: int) -> DataFrame:
    """Add ``quota`` to a table of group sizes (column ``size``): n rows by largest remainder.

    With room for it every group gets one row first. The rest goes by the remaining sizes, and what
    rounding leaves over by the largest fraction, then by key.
    """
    totals = sizes.agg(F.struct(F.count(F.lit(1)).alias("groups"), F.sum("size").alias("rows"))).scalar()
    limit = F.lit(n).cast("bigint")
    shared = sizes.withColumn("_all", totals).withColumn(
        "_base", F.when(limit >= F.col("_all.groups"), 1).otherwise(0).cast("bigint")
    )
    remaining = limit - F.col("_base") * F.col("_all.groups")
    room = F.col("_all.rows") - F.col("_base") * F.col("_all.groups")
    share = _exact(remaining) * _exact(F.col("size") - F.col("_base"))
    divisor = _exact(F.nullif(room, F.lit(0)))
    split = shared.withColumns({"_share": share, "_room": divisor}).withColumns(
        {
            "_part": F.coalesce(F.expr("_share div _room"), F.lit(0)),
            "_rest": F.coalesce(F.expr("_share % _room"), F.lit(0)),
        }
    )
    ranked = ordered_position(split, [F.desc("_rest"), *[F.col(g) for g in groups]], "_place")
    given = ranked.agg(F.sum(F.col("_base") + F.col("_part"))).scalar()
    quota = F.col("_base") + F.col("_part") + (F.col("_place") < limit - given).cast("bigint")
    whole = limit >= F.col("_all.rows")
    return ranked.withColumn("quota", F.when(whole, F.col("size")).otherwise(quota)).select(*sizes.columns, "quota")


def group_sizes(df: DataFrame, groups: list[str]) -> DataFrame:
    return df.groupBy(*groups).agg(F.count(F.lit(1)).alias("size"))


def sample_stratified(df: DataFrame, groups: list[str], order: list[str], n: int) -> DataFrame:
    """Quotas per group, then evenly spaced rows inside each group.

    Rows are placed in the order of group and key at once; a row's rank in its group is its
    position minus the group's first one. A group may be any share of the rows.
    """
    placed = ordered_position(df, [*groups, *order], "_position")
    sizes = placed.groupBy(*groups).agg(F.count(F.lit(1)).alias("size"), F.min("_position").alias("_first"))
    quotas = stratified_quota(sizes, groups, n).filter(F.col("quota") > 0)
    ranked = placed.join(quotas, groups).withColumn("_rank", F.col("_position") - F.col("_first"))
    return ranked.filter(is_evenly_spaced(F.col("_rank"), F.col("size"), F.col("quota"))).select(*df.columns)


def panel_select(obs: DataFrame, target_rows: int | None, seed: int) -> DataFrame:
    """(store, product) pairs in seeded random order, until the number of their rows is nearest the target.

    A pair is taken while the target is not reached and taking it comes strictly nearer; one pair is
    always taken. Once a pair fails the test all later ones do, so the rule is a filter.
    """
    pairs = group_sizes(obs, ["store_id", "product_id"])
    if target_rows is None:
        return pairs
    hashed = pairs.withColumn("_hash", hash_text(seed, ["store_id", "product_id"]))
    totals = running_total(hashed, ["_hash", "store_id", "product_id"], "size", "_after")
    before = F.col("_after") - F.col("size")
    nearer = F.lit(target_rows) - before > F.abs(F.lit(target_rows) - F.col("_after"))
    taken = (before == 0) | ((before < target_rows) & nearer)
    return totals.filter(taken).select(*pairs.columns)


def panel_apply(obs: DataFrame, pairs: DataFrame) -> DataFrame:
    """Whole histories of the selected pairs, in both splits."""
    return obs.join(never_broadcast(pairs.select("store_id", "product_id")), ["store_id", "product_id"], "left_semi")


def sample_bernoulli(df: DataFrame, keys: list[str], p: float, seed: int, cap: int | None = None) -> DataFrame:
    """Keep each row with probability p, the same rows on every run; optionally at most ``cap`` of them."""
    if not 0 < p <= 1:
        raise ValueError("the sample rate must be in the range (0, 1]")
    kept = df.filter(hash_unit(seed, keys) < p)
    return kept if cap is None else first_rows(kept, keys, cap)


def sample_cap_random(df: DataFrame, keys: list[str], n: int, seed: int) -> DataFrame:
    """n rows drawn uniformly without replacement: the first n in hash order.

    The first n hashes lie below a bound that follows from the number of rows, give or take some
    deviations. Rows above it are dropped before anything is sorted; should too few lie below it,
    which is next to impossible, all rows are sorted.
    """
    hashed = df.withColumn("_hash", hash_text(seed, keys))
    order = ["_hash", *keys]
    total = df.count()
    share = (n + 8 * math.sqrt(n) + 16) / max(total, 1)
    if share < 1:
        low = hashed.filter(hash_unit(seed, keys) < share)
        if low.count() >= n:
            hashed = low
    return first_rows(hashed, [F.col(name) for name in order], n).drop("_hash")


def sample_cap_ordered(df: DataFrame, keys: list[str], n: int) -> DataFrame:
    return first_rows(df, keys, n)


def sample_exact_n(df: DataFrame, keys: list[str], n: int | None, seed: int) -> DataFrame:
    """n rows drawn uniformly when there are more, else all of them."""
    return df if n is None else sample_cap_random(df, keys, n, seed)


def sample_rank(df: DataFrame, groups: list[str], keys: list[str], seed: int) -> DataFrame:
    """Rank of every row, from 1, in the random order of its group."""
    hashed = df.withColumn("_hash", hash_text(seed, keys))
    placed = ordered_position(hashed, [*groups, "_hash", *keys], "_position")
    first = placed.groupBy(*groups).agg(F.min("_position").alias("_first"))
    rank = F.col("_position") - F.col("_first") + 1
    return placed.join(first, groups).withColumn("sample_rank", rank).select(*df.columns, "sample_rank")


def sample_cap_per_group(df: DataFrame, groups: list[str], keys: list[str], n: int, seed: int) -> DataFrame:
    """At most ceil(n / groups) random rows of each group, then at most n rows by group and rank.

    With the quota known as a number, every task passes on no more than a quota of each group, so
    only those rows are shuffled and sorted.
    """
    total = max(df.select(*groups).distinct().count(), 1)
    place = Window.partitionBy(*groups).orderBy("_hash", *keys)
    ranked = df.withColumn("_hash", hash_text(seed, keys)).withColumn("sample_rank", F.row_number().over(place))
    kept = materialise(ranked.filter(F.col("sample_rank") <= -(-n // total)).drop("_hash"))
    return first_rows(kept, [*groups, "sample_rank"], n).drop("sample_rank")


def eval_or_train_sample(
    train: DataFrame, evaluation: DataFrame, keys: list[str], seed: int, n: int | None = None
) -> DataFrame:
    """The evaluation rows, or where there are none the training rows: all, or a sample of n of them."""
    return sample_exact_n(train, keys, n, seed) if evaluation.isEmpty() else evaluation
