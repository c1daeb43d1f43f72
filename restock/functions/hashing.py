"""Seeded pseudo-random order and probability from key columns, the same on every run."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# Stands for a null key, so that a null in one place differs from a null in another.
_NULL = "\\N"


def hash_text(seed: int, keys: list[str]) -> Column:
    values = [F.coalesce(F.col(key).cast("string"), F.lit(_NULL)) for key in keys]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *values))


def hash_unit(seed: int, keys: list[str]) -> Column:
    """A number in [0, 1) from the first 32 bits of the hash."""
    bits = F.conv(F.substring(hash_text(seed, keys), 1, 8), 16, 10).cast("double")
    return bits / F.lit(4294967296.0)
