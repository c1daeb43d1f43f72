"""Upserts and deletes on DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from restock.session import never_broadcast


class DuplicateKeyError(ValueError):
    """Two incoming rows share a key, so one statement would change a row twice."""


def upsert_conflicts(incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Incoming keys that occur more than once, with their number of rows."""
    return incoming.groupBy(*keys).agg(F.count(F.lit(1)).alias("incoming_rows")).filter(F.col("incoming_rows") > 1)


def require_unique(incoming: DataFrame, keys: list[str]) -> None:
    clash = upsert_conflicts(incoming, keys).first()
    if clash is not None:
        raise DuplicateKeyError(f"several incoming rows for {clash.asDict()}")


def upsert(
    existing: DataFrame,
    incoming: DataFrame,
    keys: list[str],
    update: list[str] | None = None,
    on_match: str = "replace",
) -> DataFrame:
    """Existing rows with the incoming ones inserted or, on the same key, taking their place.

    ``update`` limits a match to the named columns; ``on_match="keep"`` leaves matched rows alone.
    A key that comes twice raises :class:`DuplicateKeyError`, except under ``keep``, where any one
    of equal rows would do.
    """
    if on_match not in ("replace", "keep"):
        raise ValueError("on_match is 'replace' or 'keep'")
    columns = existing.columns
    if on_match == "keep":
        fresh = incoming.dropDuplicates(keys).join(never_broadcast(existing.select(*keys)), keys, "left_anti")
        return existing.unionByName(fresh.select(*columns))
    require_unique(incoming, keys)
    if update is None:
        others = existing.join(never_broadcast(incoming.select(*keys)), keys, "left_anti")
        return others.unionByName(incoming.select(*columns))
    patch = incoming.select(*keys, F.struct(*update).alias("_patch"))
    matched = existing.join(never_broadcast(patch), keys, "left")
    changed = [
        F.when(F.col("_patch").isNotNull(), F.col(f"_patch.{name}")).otherwise(F.col(name)).alias(name)
        if name in update
        else F.col(name)
        for name in columns
    ]
    fresh = incoming.join(never_broadcast(existing.select(*keys)), keys, "left_anti")
    return matched.select(*changed).unionByName(fresh.select(*columns))


def without_model(fact: DataFrame, model_key: int | Column) -> DataFrame:
    """A model fact without the rows of one model, as before a reimport."""
    return fact.filter(F.col("model_key") != model_key)
