"""Rows keep their identity when executors, and with them the splits of files, change between two scans."""

import contextlib

import pytest
from cases import documents
from pyspark.sql import functions as F

from restock.llm import near_copies, secret_scan, simhash_dedup
from restock.llm.common import identified


@contextlib.contextmanager
def splits(spark, count):
    spark.conf.set("spark.sql.files.minPartitionNum", count)
    try:
        yield
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum")


@pytest.fixture()
def docs(spark, tmp_path):
    texts = [f"text {i} holds AKIA{'ABCDEFGHIJKL'}{i:04d}XYZ and more words" for i in range(40)]
    texts += [f"copy of {i // 2} with the same few words again and again" for i in range(40)]
    return documents(spark, tmp_path, texts)


@pytest.mark.parametrize("counts", [(1, 64), (64, 1)])
def test_results_do_not_depend_on_splits(spark, docs, counts):
    owner, repo = F.col("source"), F.col("doc_id")
    builds = {
        "scan": lambda: secret_scan.scan(docs, repo, owner),
        "redacted": lambda: secret_scan.redacted(docs, repo, owner),
        "copies": lambda: near_copies.keep_one(docs),
        "simhash": lambda: simhash_dedup.keep_one(docs),
    }
    for build in builds.values():
        expected = sorted(map(tuple, build().collect()))
        with splits(spark, counts[0]):
            df = build()
        with splits(spark, counts[1]):
            assert sorted(map(tuple, df.collect())) == expected


def test_identity_with_clashing_columns_and_without_files(spark, docs):
    clashing = docs.withColumn("_metadata", F.lit(1))
    assert identified(clashing, "at").select("at").distinct().count() == 80
    assert identified(docs.union(docs), "at").select("at").distinct().count() == 160
