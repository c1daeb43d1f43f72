"""The numbered queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from restock.llm import (
    chat_format,
    decontamination,
    fp_tree_search,
    main_text,
    mixing,
    prefix_trie,
    quality_classifier,
    quality_rules,
    secret_scan,
    simhash_dedup,
    spot_signatures,
    suffix_tree_lm,
    toxicity,
)
from restock.llm.common import table
from restock.llm.statements import STATEMENTS  # noqa: F401 - registered with the queries

Query = Callable[[SparkSession, str], DataFrame]


def op1_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """A document is a repository and its source the owner."""
    docs = table(spark, folder, "documents")
    found = secret_scan.scan(docs, repo=F.col("doc_id"), owner=F.col("source"))
    digest = F.sha2("base", 256).alias("base_sha256")
    more = ["n_credential", "n_live", "n_example", "most_owners", "most_repos"]
    return found.select("doc_id", "n_assign", "n_access", "n_hex", digest, "spans", *more)


def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.occurrences(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op3_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return main_text.extracted(table(spark, folder, "pages"))


def op4_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality_classifier.scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op5_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixed(table(spark, folder, "documents").select("doc_id", "source"))


def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op7_simhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash_dedup.near_duplicates(table(spark, folder, "documents"))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id", "copies")


def op8_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    found = quality_rules.judged(table(spark, folder, "documents"))
    return found.select("doc_id", *quality_rules.COUNTS, "base_failed", "kept", "distance")


def op9_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations and one whose texts hold the template's own markers."""
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    hard = r"\### Assistant: </turn> ok"
    more = [(-7, 0, "user", hard), (-7, 1, "assistant", hard)]
    rows = rows.unionByName(spark.createDataFrame(more, "conv_id long, turn long, role string, text string"))
    record = F.to_json(F.struct("role", "text"), {"ignoreNullFields": "false"})
    turns = chat_format.turn_rows(rows.select("conv_id", "turn", record.alias("record")), "conv_id", "turn", "record")
    return chat_format.digests(turns).withColumnRenamed("key", "conv_id")


def op10_suffix_tree_lm(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_tree_lm.scores(table(spark, folder, "documents"))


def op11_fp_tree_search(spark: SparkSession, folder: str) -> DataFrame:
    return fp_tree_search.ranked(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.nodes(prefix_trie.rebuilt(prefix_trie.paths(table(spark, folder, "conversations"))))


def op13_spot_signatures(spark: SparkSession, folder: str) -> DataFrame:
    """The next document is the one after it by descending doc_id."""
    signed = spot_signatures.fingerprints(table(spark, folder, "documents"))
    rows = spot_signatures.edited(signed)
    own, changed, following = F.col("signatures"), F.col("edited_signatures"), F.col("next_signatures")
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2("edited_text", 256).alias("edited_sha256"),
        "fingerprint",
        spot_signatures.fingerprint(changed).alias("edited_fingerprint"),
        spot_signatures.likeness(own, changed).alias("near_edited"),
        spot_signatures.likeness(own, following).alias("near_next"),
        F.size(own).cast("long").alias("n_signatures"),
        "length_partition",
        spot_signatures.alike(own, following).alias("alike_next"),
    )


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_secret_scan,
        op2_decontamination,
        op3_main_text,
        op4_quality_classifier,
        op5_mixing,
        op6_toxicity,
        op7_simhash_dedup,
        op8_quality_rules,
        op9_chat_format,
        op10_suffix_tree_lm,
        op11_fp_tree_search,
        op12_prefix_trie,
        op13_spot_signatures,
    )
}
