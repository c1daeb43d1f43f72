"""The training-data pipeline over ``documents``: each stage works on all its predecessor kept."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from restock.llm import decontamination, mixing, near_copies, quality_classifier, secret_scan
from restock.llm.common import ready, table, written
from restock.session import remove_steps, steps

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# What the stage before has written on its way, by application; nobody reads it once its result is stored.
_passed: dict[str, list[str]] = {}


def stage(work: Stage) -> Stage:
    """A stage that first removes what the stage before has written, unless ``docs`` still reads it.

    The result of a stage has to be written before the next one begins, as ``run`` does it.
    """

    @wraps(work)
    def started(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ready(spark)
        passed = _passed.pop(spark.sparkContext.applicationId, [])
        if passed:
            read = docs.inputFiles()
            remove_steps(spark, [step for step in passed if not any(step in file for file in read)])
        before = set(steps(spark))
        found = work(spark, docs, sf_dir)
        _passed[spark.sparkContext.applicationId] = [step for step in steps(spark) if step not in before]
        return found

    return started


@stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality classifier rejects."""
    return quality_classifier.accepted(docs, table(spark, sf_dir, "labels"))


@stage
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of every group of near copies: five-word shingles at a similarity of 0.8.

    Candidates are linked by ``op7``'s fingerprints over these shingles and by keys of least hashes; all are verified.
    """
    return near_copies.keep_one(docs)


@stage
def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a benchmark item."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


@stage
def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks secrets in the texts and counts their characters anew."""
    return secret_scan.redacted(docs, F.col("doc_id"), F.col("source"))


@stage
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Gives every document its slot in the mixture of sources."""
    return mixing.mixed(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality),
    ("near duplicates", near_dedup),
    ("decontamination", decontaminate),
    ("secret scan", secrets),
    ("mixing", mix),
]

# Fingerprints, the classifier and the schedule have no form in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, work in STAGES:
        docs = written(work(spark, docs, sf_dir))
    return docs
