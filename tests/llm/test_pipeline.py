import __spark_entry__ as entry
import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from restock.llm import decontamination, near_copies, quality_classifier, secret_scan
from restock.llm.common import table
from restock.llm.queries import QUERIES
from restock.session import steps

NUMBERED = {name.split("_")[0] for name in QUERIES}


def test_all_queries_are_registered():
    assert {f"op{n}" for n in range(1, 14)} == NUMBERED
    assert {*QUERIES, "pipeline"} <= set(entry.queries())
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "near duplicates", "decontamination", "secret scan", "mixing",
    ]


@pytest.fixture(scope="module")
def stages(spark, folder):
    docs = [table(spark, folder, "documents")]
    for _, stage in corpus_pipeline.STAGES:
        docs.append(corpus_pipeline.written(stage(spark, docs[-1], folder)))
    return docs


def ids(df):
    return {row[0] for row in df.select("doc_id").collect()}


def not_near(df):
    """Whether no two texts share four fifths of their five-word shingles, by brute force."""
    held, by_shingle = [], {}
    for row in df.collect():
        words = (row.text or "").lower().split()
        held.append({" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set())
    for i, shingles in enumerate(held):
        common = {}
        for shingle in shingles:
            for j in by_shingle.setdefault(shingle, []):
                common[j] = common.get(j, 0) + 1
            by_shingle[shingle].append(i)
        if any(5 * n >= 4 * (len(shingles) + len(held[j]) - n) for j, n in common.items()):
            return False
    return True


def test_each_stage_does_its_work_on_its_input(spark, folder, stages):
    start, good, single, clean, masked, mixed = stages
    scored = quality_classifier.scores(start, table(spark, folder, "labels"))
    assert ids(good) == ids(scored.filter("predicted = 1")) and good.count() < start.count()
    assert ids(single) == ids(near_copies.keep_one(good))
    assert not_near(single) and single.count() < good.count()
    assert single.count() == len(ids(single))
    leaks = decontamination.occurrences(single, table(spark, folder, "benchmark"))
    assert ids(clean) == ids(single) - ids(leaks) and leaks.count() > 0
    assert ids(masked) == ids(clean) == ids(mixed) and mixed.count() == masked.count() == clean.count()
    found = secret_scan.scan(masked, F.col("doc_id"), F.col("source"))
    assert found.filter("spans <> ''").count() == 0
    touched = secret_scan.scan(clean, F.col("doc_id"), F.col("source")).filter("spans <> ''")
    before = clean.join(touched, "doc_id", "left_anti").select("doc_id", "text", "n_chars")
    assert before.exceptAll(masked.select("doc_id", "text", "n_chars")).count() == 0
    for df in (good, single, clean, masked):
        assert df.columns == start.columns
    assert set(start.columns) < set(mixed.columns)


def test_run_gives_the_rows_of_the_last_stage(spark, folder, stages):
    assert ids(corpus_pipeline.run(spark, folder)) == ids(stages[-1])


def test_every_query_gives_rows(spark, folder):
    documents = table(spark, folder, "documents").count()
    for name in ("op1_secret_scan", "op4_quality_classifier", "op5_mixing", "op6_toxicity", "op7_simhash_dedup", "op8_quality_rules", "op10_suffix_tree_lm"):
        assert QUERIES[name](spark, folder).count() == documents
    assert QUERIES["op3_main_text"](spark, folder).count() == table(spark, folder, "pages").count()
    conversations = table(spark, folder, "conversations").select("conv_id").distinct().count()
    assert QUERIES["op9_chat_format"](spark, folder).count() == conversations + 1


def test_a_stage_removes_what_the_one_before_has_written(spark, folder, tmp_path):
    docs = table(spark, folder, "documents").limit(60)
    single = corpus_pipeline.near_dedup(spark, docs, folder)
    mine = set(steps(spark))
    single.write.parquet(str(tmp_path / "single"))
    corpus_pipeline.decontaminate(spark, spark.read.parquet(str(tmp_path / "single")), folder).count()
    assert len(mine - set(steps(spark))) > 3


def test_a_stage_keeps_what_its_input_still_reads(spark, folder):
    docs = table(spark, folder, "documents").limit(60)
    single = corpus_pipeline.near_dedup(spark, docs, folder)
    clean = corpus_pipeline.decontaminate(spark, single, folder)
    assert clean.count() <= single.count()


def test_no_documents(spark, folder, tmp_path):
    docs = table(spark, folder, "documents").limit(0)
    docs.write.parquet(str(tmp_path / "none"))
    docs = spark.read.parquet(str(tmp_path / "none"))
    for _, work in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(work(spark, docs, folder))
    assert docs.count() == 0
