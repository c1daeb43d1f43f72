"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from copy import copy

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from restock.session import materialise, prepare

# Rows computed once and read back from the shared folder; a lost executor loses none of them.
written = materialise

SETTINGS = {
    # Rows per Arrow batch: whole texts may be long, so a batch holds few of them.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "500",
}


def ready(spark: SparkSession) -> SparkSession:
    """The session with the library's settings and small Arrow batches."""
    prepare(spark)
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def remainder(doc_id: str | Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo the divisor; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % divisor


def is_held_out(doc_id: str, divisor: int, rest: int) -> Column:
    """Whether the id falls in the held-out part; a null id never does."""
    return F.coalesce(remainder(doc_id, divisor) == rest, F.lit(False))


def as_bytes(texts: pd.Series) -> Iterator[bytes]:
    """UTF-8 of every text, a null one as empty."""
    for text in texts:
        yield b"" if text is None or text != text else text.encode("utf-8", "surrogatepass")


_BUCKET = 32_768
_HALF = np.uint64(32)


class Places:
    """Hash places of a set of 64-bit codes, two bits each: every code of the set is found, and few others.

    ``size`` is a power of two from 32,768 on; what tasks receive is ``size`` / 8 bytes, whatever the set.
    """

    def __init__(self, size: int):
        self.size = size
        self.bits = np.zeros(size // 8, np.uint8)

    @classmethod
    def of(cls, codes: DataFrame, column: str, size: int) -> Places:
        places = cls(size)
        marked = codes.select(column).mapInArrow(_marked(size), "bucket long, bits binary")
        found = marked.groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits")).collect()
        for row in found:
            start = row.bucket * (_BUCKET // 8)
            places.bits[start : start + _BUCKET // 8] = np.frombuffer(row.bits, np.uint8)
        return places

    def __getstate__(self) -> dict:
        return {"size": self.size, "bits": zlib.compress(self.bits, 1)}

    def __setstate__(self, state: dict) -> None:
        self.size = state["size"]
        self.bits = np.frombuffer(zlib.decompress(state["bits"]), np.uint8)

    def _spots(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = codes & np.uint64(self.size - 1)
        return at >> np.uint64(3), (at & np.uint64(7)).astype(np.uint8)

    def add(self, codes: np.ndarray) -> None:
        for part in (codes, codes >> _HALF):
            spot, bit = self._spots(part)
            np.bitwise_or.at(self.bits, spot, np.uint8(1) << bit)

    def joined(self, codes: np.ndarray) -> Places:
        """Places of the set and of some more codes."""
        more = copy(self)
        more.bits = self.bits.copy()
        more.add(codes)
        return more

    def hold(self, codes: np.ndarray) -> np.ndarray:
        spot, bit = self._spots(codes)
        found = (self.bits[spot] >> bit) & 1 == 1
        left = np.flatnonzero(found)
        spot, bit = self._spots(codes[left] >> _HALF)
        found[left] = (self.bits[spot] >> bit) & 1 == 1
        return found


def _marked(size: int):
    """The places of one task's codes, by buckets that hold any."""

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = Places(size)
        for batch in batches:
            places.add(batch.column(0).to_numpy().view(np.uint64))
        buckets = places.bits.reshape(-1, _BUCKET // 8)
        held = np.flatnonzero(buckets.any(axis=1))
        bits = [buckets[i].tobytes() for i in held]
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(bits, pa.binary())], names=["bucket", "bits"])

    return marked


# Hash places that stand for keys in a filter; what is broadcast is never larger than this many rows.
PLACES = 1 << 20


def likely(rows: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """Rows whose key shares a hash place with a key of ``keys``: all that match and few others.

    It goes ahead of a join, so that texts without a match are not shuffled. With far more keys than
    places every row passes and the join does all the work.
    """
    place = F.pmod(F.xxhash64(F.col(column).cast("string")), F.lit(PLACES))
    name = fresh(rows, "_place")
    taken = F.broadcast(keys.select(place.alias(name)).distinct())
    return rows.withColumn(name, place).join(taken, name, "left_semi").drop(name)


def identified(docs: DataFrame, name: str) -> DataFrame:
    """The rows with a struct that tells each from all others: its file and its number in the file.

    Unlike a number drawn by tasks it does not depend on how files are cut into splits, so two scans
    agree even if executors came or went between them. Rows that come from no file are written first.
    """

    def place(rows: DataFrame) -> Column:
        about = rows.metadataColumn("_metadata")
        return F.struct(F.xxhash64(about["file_path"]).alias("file"), about["row_index"].alias("number")).alias(name)

    try:
        return docs.select("*", place(docs))
    except AnalysisException:
        stored = written(docs)
        return stored.select("*", place(stored))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that the rows do not have yet."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
