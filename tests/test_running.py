"""Kept state: after increments and replaced files it equals one run over everything."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewmill.operators import quality
from reviewmill.operators.running import record_increment, running_counts, running_documents, running_summary, update_sums
from reviewmill.plans.catalog import _damaged, raw_reviews

FACTS = "file_key string, restaurant_id string, review_id string, rating double, transaction_count bigint"


def test_summary_follows_replaced_files(spark, tmp_path):
    path = str(tmp_path / "sums")
    places = spark.createDataFrame([("a", "A"), ("b", "B"), ("c", "C")], "restaurant_id string, restaurant_name string")
    first = [("f1", "a", "1", 4.0, 1), ("f1", "a", "2", None, 2), ("f1", "b", "3", 1.0, 1), ("f2", "a", "4", 2.5, 1), ("f2", None, None, 5.0, 1)]
    update_sums(spark.createDataFrame(first, FACTS), path)
    update_sums(spark.createDataFrame([("f1", "b", "5", 2.0, 3)], FACTS), path)
    update_sums(spark.createDataFrame([("f3", "a", "6", 3.5, 1)], FACTS), path)
    got = {r["restaurant_id"]: tuple(r)[1:] for r in running_summary(spark, path, places).collect()}
    assert got == {"a": ("A", 3.0, 2, 2, 2), "b": ("B", 2.0, 1, 1, 3), "c": ("C", None, 0, 0, 0)}
    docs = {(r["scope"], r["restaurant_id"]): r["docs"] for r in running_documents(spark, path).collect()}
    assert docs == {("total", None): 4, ("restaurant", "a"): 2, ("restaurant", "b"): 1, ("restaurant", None): 1}


def test_counters_add_up_and_replace(spark, tmp_path):
    path = str(tmp_path / "counts")
    columns = "indexed bigint, skipped bigint, blank bigint, missing_id bigint, bad_rating bigint"
    record_increment(spark.createDataFrame([(9, 9, 9, 9, 9)], columns), path, "one")
    record_increment(spark.createDataFrame([(1, 2, 3, 4, 5)], columns), path, "one")
    record_increment(spark.createDataFrame([(1, 1, 1, 1, 1)], columns), path, "two")
    assert tuple(running_counts(spark, path).first()) == (2, 3, 4, 5, 6)


def test_check_state_over_increments(spark, sf_dir, tmp_path):
    raw, facts = raw_reviews(spark, sf_dir), _damaged(spark, sf_dir)
    path = str(tmp_path / "state")
    for part in (0, 1, 0):
        quality.add_to_state(raw.filter(F.col("pos") % 2 == part), facts.filter(F.crc32("review_id") % 2 == part), path, f"p{part}")

    def rows(df):
        return sorted(map(tuple, df.select("dataset", "review_id", "flags", "must_derive", "processed_rows").collect()))

    whole = rows(quality.id_flags(raw, facts))
    assert rows(quality.state_flags(spark, path)) == whole
    quality.compact_state(spark, path, str(tmp_path / "compact"))
    assert rows(quality.state_flags(spark, str(tmp_path / "compact"))) == whole
    assert spark.read.parquet(str(tmp_path / "compact")).count() == len(whole)
