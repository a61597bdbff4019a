"""Aggregates that are kept up to date: partial sums per file, replaced when the file arrives again.

A file's rows are summed once, when it arrives. The summary adds the partial sums of all files, a few rows each, and equals a
recount over all rows at any time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SUMS = "restaurant_id string, rating_sum double, rated bigint, reviews bigint, submissions bigint, n_rows bigint, file_key string"
COUNTS = ("indexed", "skipped", "blank", "missing_id", "bad_rating")


def update_sums(facts: DataFrame, path: str) -> None:
    """Partial sums of the files in ``facts`` (processed facts with ``file_key``); those files' former sums are replaced."""
    sums = facts.groupBy("file_key", "restaurant_id").agg(
        F.sum("rating").alias("rating_sum"), F.count("rating").alias("rated"), F.count("review_id").alias("reviews"),
        F.sum("transaction_count").alias("submissions"), F.count(F.lit(1)).alias("n_rows"))
    sums.hint("rebalance", "file_key").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("file_key").parquet(path)


def _sums(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SUMS).parquet(path)


def running_summary(spark: SparkSession, path: str, dimension: DataFrame) -> DataFrame:
    """Rating and review figures per restaurant of the dimension, from the partial sums."""
    per = _sums(spark, path).groupBy("restaurant_id").agg(*[F.sum(c).alias(c) for c in ("rating_sum", "rated", "reviews", "submissions")])
    held = dimension.select("restaurant_id", "restaurant_name").join(per, "restaurant_id", "left")
    return held.select(
        "restaurant_id", "restaurant_name", F.round(F.try_divide("rating_sum", "rated"), 6).alias("avg_rating"),
        *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("reviews", "rated", "submissions")])


def running_documents(spark: SparkSession, path: str, top: int = 10) -> DataFrame:
    """``scope, restaurant_id, docs``: rows in all, and the restaurants with most."""
    per = _sums(spark, path).groupBy("restaurant_id").agg(F.sum("n_rows").alias("docs"))
    total = per.agg(F.coalesce(F.sum("docs"), F.lit(0)).alias("docs")).select(F.lit("total").alias("scope"), F.lit(None).cast("string").alias("restaurant_id"), "docs")
    best = per.orderBy(F.desc("docs"), "restaurant_id").limit(top).select(F.lit("restaurant").alias("scope"), "restaurant_id", "docs")
    return total.unionByName(best)


def record_increment(counts: DataFrame, path: str, increment: str) -> None:
    """Keep the counters of one index increment (``index.increment_counts``); the same increment again replaces itself."""
    counts.select(*COUNTS, F.lit(increment).alias("increment")).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy("increment").parquet(path)


def running_counts(spark: SparkSession, path: str) -> DataFrame:
    """The counters over all increments."""
    held = spark.read.schema(", ".join(f"{c} bigint" for c in COUNTS)).parquet(path)
    return held.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in COUNTS])
