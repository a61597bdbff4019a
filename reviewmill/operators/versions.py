"""A review index with keyed updates: buckets of review ids, and a manifest per version that says which files hold each bucket.

Documents lie in a fixed number of buckets by hash of the id. An update reads ids and text hashes of the buckets its rows fall into,
embeds what is new or changed, and writes only the buckets that change, under the number of the new version; the manifest of that
version names them and takes the other buckets from the versions before. No file is ever written over, so a reader that opened a version
keeps it, and an update that fails leaves nothing that a manifest names. Two writers of one version cannot both succeed.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.contracts import INDEX_SCHEMA
from reviewmill.operators.embed import embed
from reviewmill.operators.index import failures_path, new_documents
from reviewmill.session import fresh_path

MANIFEST = "version int, bucket int, written_in int, n_rows bigint"
BUCKETS = 256


def bucket_of(review_id: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(review_id), F.lit(buckets)).cast("int")


def create_versions(spark: SparkSession, path: str, buckets: int = BUCKETS) -> None:
    """Version 0: empty buckets. Nothing happens where there is one."""
    rows = spark.range(buckets).select(
        F.lit(0).alias("version"), F.col("id").cast("int").alias("bucket"), F.lit(None).cast("int").alias("written_in"), F.lit(0).cast("bigint").alias("n_rows"))
    rows.coalesce(1).write.mode("ignore").parquet(f"{path}/manifest/of_version=0")


def manifest(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """``version, bucket, written_in, n_rows``, a row per bucket of one version, the latest if not given."""
    every = spark.read.schema(f"{MANIFEST}, of_version int").parquet(f"{path}/manifest").drop("of_version")
    if version is None:
        version = every.agg(F.max("version")).first()[0]
    return every.where(F.col("version") == version)


def _files(path: str, held: list, buckets: set[int] | None = None) -> list[str]:
    return [f"{path}/data/written_in={r['written_in']}/bucket={r['bucket']}" for r in held
            if r["written_in"] is not None and r["n_rows"] and (buckets is None or r["bucket"] in buckets)]


def _read(spark: SparkSession, files: list[str]) -> DataFrame:
    return spark.read.schema(INDEX_SCHEMA).parquet(*files) if files else spark.createDataFrame([], INDEX_SCHEMA)


def read_version(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The index as one version has it. The manifest has a row per bucket, so its files are few."""
    return _read(spark, _files(path, manifest(spark, path, version).collect()))


def upsert(
    rows: DataFrame, path: str, order: Sequence[str] = ("pos",), load: Callable | None = None, buckets: int = BUCKETS, delete: DataFrame | None = None
) -> int:
    """Write a new version with new and changed documents of ``rows`` and without the ids of ``delete``; returns its number.

    A document is the first row with text of its id. One whose text the index has already is not embedded again. What the model fails on
    keeps its old document and goes to the failures table. Without a change the version stays as it is.
    """
    spark = rows.sparkSession
    create_versions(spark, path, buckets)
    held = sorted(manifest(spark, path).collect(), key=lambda r: r["bucket"])
    current, buckets = held[0]["version"], len(held)
    nobody = spark.createDataFrame([], "review_id string")
    keyed = new_documents(rows, nobody, order).withColumn("bucket", bucket_of(F.col("review_id"), buckets))
    docs = _staged(keyed, "arrived")
    gone = (delete if delete is not None else nobody).select("review_id").distinct().withColumn("bucket", bucket_of(F.col("review_id"), buckets))
    touched = {r["bucket"] for r in docs.select("bucket").unionByName(gone.select("bucket")).distinct().collect()}
    old = _read(spark, _files(path, held, touched))

    known = old.select("review_id", F.xxhash64("review_text").alias("_known"))
    fresh = docs.join(known, "review_id", "left").where(F.col("_known").isNull() | (F.col("_known") != F.xxhash64("review_text"))).drop("_known")
    vectors = embed(fresh.hint("rebalance", "bucket"), "review_text", load=load)
    tried = _staged(vectors.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in INDEX_SCHEMA.fields], "bucket"), "embedded")
    lost = tried.where(F.col("embedding").isNull()).drop("bucket")
    if not lost.isEmpty():
        lost.write.mode("append").parquet(failures_path(path))
    changed = tried.where(F.col("embedding").isNotNull())
    removed = gone.join(old.select("review_id"), "review_id", "left_semi").join(changed.select("review_id"), "review_id", "left_anti")
    replaced = _staged(changed.select("review_id", "bucket").unionByName(removed.select("review_id", "bucket")), "replaced")
    moved = {r["bucket"] for r in replaced.select("bucket").distinct().collect()}
    if not moved:
        return current

    version = current + 1
    kept = _read(spark, _files(path, held, moved)).join(replaced.select("review_id"), "review_id", "left_anti")
    now = kept.withColumn("bucket", bucket_of(F.col("review_id"), buckets)).unionByName(changed)
    now.hint("rebalance", "bucket").sortWithinPartitions("bucket", "restaurant_id").write.mode("overwrite").partitionBy("bucket").parquet(
        f"{path}/data/written_in={version}")
    sizes = {r["bucket"]: r["n"] for r in _counts(spark, f"{path}/data/written_in={version}")}
    listed = [(version, r["bucket"], version if r["bucket"] in moved else r["written_in"], sizes.get(r["bucket"], 0) if r["bucket"] in moved else r["n_rows"]) for r in held]
    spark.createDataFrame(listed, MANIFEST).coalesce(1).write.mode("errorifexists").parquet(f"{path}/manifest/of_version={version}")
    return version


def _counts(spark: SparkSession, path: str) -> list:
    return spark.read.schema("review_id string, bucket int").parquet(path).groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).collect()


def _staged(df: DataFrame, name: str) -> DataFrame:
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
