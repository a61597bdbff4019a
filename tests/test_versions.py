"""Keyed updates: what changes is written, versions stay readable."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from reviewmill.operators.index import failures
from reviewmill.operators.versions import bucket_of, create_versions, manifest, read_version, upsert

ROWS = "pos long, review_id string, restaurant_id string, rating double, review_date date, review_text string"


def load():
    def model(texts, mode):
        if any("unreadable" in t for t in texts):
            raise ValueError("unreadable")
        return [[float(len(t)), 1.0] for t in texts]
    return model


def frame(spark, texts):
    return spark.createDataFrame([(k, i, "r", 1.0, None, t) for k, (i, t) in enumerate(texts)], ROWS)


def texts_of(df):
    rows = df.collect()
    assert len({r["review_id"] for r in rows}) == len(rows) and all(r["embedding"][0] == len(r["review_text"]) for r in rows)
    return {r["review_id"]: r["review_text"] for r in rows}


def test_versions(spark, tmp_path):
    path = str(tmp_path / "index")
    first = {f"id{k}": f"text {k}" for k in range(200)}
    assert upsert(frame(spark, first.items()), path, load=load, buckets=32) == 1
    assert texts_of(read_version(spark, path)) == first
    opened = read_version(spark, path)

    changes = [("id7", "another text"), ("new", "brand new"), ("id8", "text 8"), ("id9", "unreadable"), ("also", "unreadable"), ("id10", " "), ("", "x"), (None, "y"), ("new", "late")]
    assert upsert(frame(spark, changes), path, load=load) == 2
    second = first | {"id7": "another text", "new": "brand new"}
    assert texts_of(read_version(spark, path)) == second
    assert texts_of(read_version(spark, path, 1)) == first and texts_of(opened) == first
    assert {r["review_id"] for r in failures(spark, path).collect()} == {"id9", "also"}
    moved = {r["b"] for r in spark.createDataFrame([("id7",), ("new",)], "i string").select(bucket_of(F.col("i"), 32).alias("b")).collect()}
    written = {int(d.split("=")[1]) for d in os.listdir(f"{path}/data/written_in=2") if d.startswith("bucket")}
    assert written == moved == {r["bucket"] for r in manifest(spark, path).collect() if r["written_in"] == 2}

    gone = spark.createDataFrame([("id1",), ("unknown",), ("id2",)], "review_id string")
    assert upsert(frame(spark, [("id2", "back again")]), path, load=load, delete=gone) == 3
    assert texts_of(read_version(spark, path)) == {k: v for k, v in second.items() if k != "id1"} | {"id2": "back again"}
    assert upsert(frame(spark, [("id2", "back again")]), path, load=load) == 3
    assert upsert(frame(spark, []), path, load=load) == 3
    assert sum(r["n_rows"] for r in manifest(spark, path).collect()) == 200


def test_a_version_is_written_once(spark, tmp_path):
    path = str(tmp_path / "index")
    create_versions(spark, path, 4)
    create_versions(spark, path, 8)
    assert manifest(spark, path).count() == 4 and read_version(spark, path).count() == 0
    manifest(spark, path).withColumn("version", F.lit(1)).limit(0).write.parquet(f"{path}/manifest/of_version=1")
    with pytest.raises(Exception):
        upsert(frame(spark, [("a", "b")]), path, load=load)
