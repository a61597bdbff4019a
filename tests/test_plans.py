"""Plan shapes that must hold at any size."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in entry.queries() if not n.startswith("stream_")))
def test_no_product_of_tables(spark, sf_dir, name):
    text = plan(entry.queries()[name](spark, sf_dir))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text


@pytest.mark.parametrize("name", ["fact_standardize", "collapse_duplicates", "keep_first"])
def test_collapse_is_one_shuffle_without_joins(spark, sf_dir, name):
    text = plan(entry.queries()[name](spark, sf_dir))
    assert len(re.findall(r"\bExchange\b", text)) == 1 and "Join" not in text and "partial_min_by" in text


@pytest.mark.parametrize("name", ["knn_topk", "knn_filtered", "dq_row_checks", "dq_passthrough"])
def test_rank_limits_precede_the_shuffle(spark, sf_dir, name):
    text = plan(entry.queries()[name](spark, sf_dir))
    assert re.search(r"WindowGroupLimit.*Partial", text) and re.search(r"WindowGroupLimit.*Final", text)


def test_search_reads_vectors_only(spark, tmp_path):
    from reviewmill.operators.search import best_hits, plan_searches
    path = str(tmp_path / "index")
    spark.range(50).selectExpr(
        "cast(id AS string) AS review_id", "concat('r', id % 3) AS restaurant_id", "1f AS rating", "'t' AS review_text", "array(1f, 2f) AS embedding"
    ).write.partitionBy("restaurant_id").parquet(path)
    index = spark.read.parquet(path)
    questions = spark.createDataFrame([(1, [1.0, 0.0], ["R1"])], "q_id bigint, embedding array<double>, targets array<string>")
    text = plan(best_hits(index, plan_searches(questions)))
    assert re.search(r"PartitionFilters: \[[^\]]*restaurant_id[^\]]*r1", text)
    assert re.search(r"ReadSchema: struct<review_id:string,embedding:array<float>>", text)


def test_row_local_jobs_do_not_shuffle(spark, sf_dir):
    for name in ("rating_normalize", "date_normalize", "text_chunks", "index_documents", "question_rejected", "question_resolution", "hash_embed"):
        text = plan(entry.queries()[name](spark, sf_dir))
        assert "Exchange hashpartitioning" not in text, name


def test_evidence_reads_the_files_of_the_hits(spark, tmp_path):
    from reviewmill.operators.context import with_documents
    from reviewmill.operators.search import hit_bound, retrieve
    path = str(tmp_path / "index")
    rows = spark.range(400).selectExpr(
        "cast(id AS string) AS review_id", "concat('r', id div 100) AS restaurant_id", "1f AS rating", "concat('text ', id) AS review_text",
        "array(cast(id AS float), 2f) AS embedding")
    rows.repartitionByRange(8, F.col("review_id").cast("int")).write.parquet(path)
    index = spark.read.parquet(path)
    questions = spark.createDataFrame([(1, [1.0, 0.0], ["R1"]), (2, [1.0, 0.0], ["r3"])], "q_id bigint, embedding array<double>, targets array<string>")
    evidence = with_documents(retrieve(index, questions, located=True), index, hit_bound(questions))
    assert {r["review_text"] for r in evidence.collect()} == {f"text {i}" for k in (199, 399) for i in range(k - 4, k + 1)}
    text = plan(evidence)
    scan = next(line for line in text.split("\n") if "review_text" in line and "FileScan" in line or "Scan parquet" in line and "review_text" in line)
    assert re.search(r"restaurant_id, \[r1,r3\]|In\(restaurant_id", text)
    names = set(re.findall(r"part-\d+", text))
    assert 1 <= len(names) <= 2, scan
