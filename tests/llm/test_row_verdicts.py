"""Rows that share a doc_id, or have none, are dropped each for its own text."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from reviewmill.llm import exact_dedup, rule_ensemble, simhash

DOCS = "doc_id long, text string, sha256 string"


def prose(seed):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(60))


def kept(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=repr)


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "x") for i, t in rows], DOCS).repartition(3)


def test_quality_stage_drops_rows_not_ids(spark, sf_dir, monkeypatch):
    import corpus_pipeline

    rows = [(None, "clean one"), (None, "junk"), (7, "clean two"), (7, "junk"), (8, "junk"), (None, None)]

    def classify(docs, labels, carried=()):
        return docs.select("doc_id", *carried, (~F.coalesce("text", F.lit("")).contains("junk")).cast("int").alias("predicted"))

    monkeypatch.setattr(rule_ensemble, "classify", classify)
    got = corpus_pipeline.quality_classifier(spark, docs_of(spark, rows), sf_dir)
    assert got.columns == ["doc_id", "text", "sha256"]
    assert kept(got) == sorted([(None, "clean one"), (7, "clean two"), (None, None)], key=repr)


def test_classify_carries_the_digest(spark, sf_dir):
    from reviewmill.llm.common import DIGEST, text_digest

    docs = docs_of(spark, [(1, "a b"), (1, "c d"), (None, None)])
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    got = rule_ensemble.classify(docs, labels, carried=(text_digest(),))
    assert got.columns == ["doc_id", DIGEST, "held_out", "score", "predicted"]
    assert got.select(DIGEST).distinct().count() == 3


def test_near_duplicate_stage_drops_rows_not_ids(spark):
    one, two, three, four = (prose(k) for k in range(4))
    rows = [(1, one), (None, one), (None, two), (9, three), (9, one), (None, four), (None, four)]
    assert kept(simhash.keep_one(docs_of(spark, rows))) == sorted([(1, one), (None, two), (9, three), (None, four)], key=repr)


def test_one_row_of_each_component_stays(spark):
    one, two = prose(1), prose(2)
    near = one.replace(" ", "  ")  # the same words, another text
    rows = [(None, one), (None, near), (None, one), (4, two), (4, two), (4, two + " "), (7, two)]
    got = simhash.keep_one(docs_of(spark, rows))
    assert got.columns == ["doc_id", "text", "sha256"]
    answer = kept(got)
    assert [i for i, _ in answer] == [4, None] and answer[0][1] in (two, two + " ") and answer[1][1] in (one, near)


def test_exact_stage_tells_equal_beginnings_apart(spark):
    head = "p" * 300
    rows = [(None, head + "1"), (None, head + "2"), (None, head + "2"), (3, head + "1"), (5, head + "3"), (5, head + "4"), (4, head + "3")]
    got = exact_dedup.keep_first(docs_of(spark, rows))
    assert got.columns == ["doc_id", "text", "sha256"] and {r.sha256 for r in got.collect()} == {"x"}
    assert kept(got) == sorted([(3, head + "1"), (None, head + "2"), (5, head + "4"), (4, head + "3")], key=repr)
