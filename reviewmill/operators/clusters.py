"""Exact top-k over a clustered index: clusters that cannot hold a hit are not read.

Every document lies in the cluster of its nearest centre, and a cluster keeps its centre and radius (the greatest distance of a member).
The inner product of a question q with any member is at most q·centre + |q|·radius. The clusters with the highest bounds are searched
first; the k-th score found there closes every cluster whose bound is below it, and only the rest is searched in a second
pass. Nothing is approximate: centres come from a bounded sample and only decide how much can be skipped.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reviewmill.operators.search import SCORE_DECIMALS, SEARCH_BYTES, SEARCH_COLUMNS, best_hits
from reviewmill.session import fresh_path

SAMPLE_ROWS = 20_000  # vectors the centres are fitted on, taken by hash of the id
MAX_CLUSTERS = 4_096  # their centres travel to the tasks
ROUNDS = 5
FIRST = 4  # clusters a search looks into before any is closed
_STATS = "cluster int, centre array<double>, radius double, n_rows bigint"


def _centres(index: DataFrame, clusters: int, sample_rows: int) -> np.ndarray:
    """Some rounds of k-means on the rows with the smallest hashes; as many centres as there are different rows at most."""
    order = F.xxhash64("review_id")
    rows = index.where(F.col("embedding").isNotNull()).select("review_id", "embedding", order.alias("o")).orderBy("o", "review_id").limit(sample_rows)
    vectors = rows.select("embedding").toArrow().column("embedding").combine_chunks()
    if not len(vectors):
        return np.zeros((0, 0))
    points = vectors.flatten().to_numpy().astype(np.float64).reshape(len(vectors), -1)
    centres = np.unique(points, axis=0)
    centres = centres[np.linspace(0, len(centres) - 1, min(clusters, len(centres), MAX_CLUSTERS)).astype(int)]
    for _ in range(ROUNDS):
        near = _nearest(points, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, points)
        counts = np.bincount(near, minlength=len(centres))
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
    return centres


def _nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres**2).sum(axis=1) - 2 * points @ centres.T, axis=1)


def _matrix(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def build_clusters(index: DataFrame, path: str, clusters: int = 64, sample_rows: int = SAMPLE_ROWS) -> None:
    """Write the documents by cluster, and centre, radius and size of every cluster."""
    spark = index.sparkSession
    centres = spark.sparkContext.broadcast(_centres(index, clusters, sample_rows))
    held = index.where(F.col("embedding").isNotNull()).select("review_id", "restaurant_id", F.col("embedding").cast("array<float>").alias("embedding"))

    def assign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                points = _matrix(batch.column("embedding"))
                near = _nearest(points, centres.value)
                far = np.sqrt(((points - centres.value[near]) ** 2).sum(axis=1))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(far), pa.array(near.astype(np.int32))], [*batch.schema.names, "distance", "cluster"])

    placed = held.mapInArrow(assign, "review_id string, restaurant_id string, embedding array<float>, distance double, cluster int")
    placed.hint("rebalance", "cluster").write.partitionBy("cluster").parquet(f"{path}/rows")
    rows = spark.read.schema("review_id string, restaurant_id string, embedding array<float>, distance double, cluster int").parquet(f"{path}/rows")
    sizes = {r["cluster"]: (r["radius"], r["n"]) for r in rows.groupBy("cluster").agg(F.max("distance").alias("radius"), F.count(F.lit(1)).alias("n")).collect()}
    stats = [(k, centre.tolist(), *sizes[k]) for k, centre in enumerate(centres.value) if k in sizes]
    spark.createDataFrame(stats, _STATS).coalesce(1).write.parquet(f"{path}/clusters")


def _chosen(searches: DataFrame, stats: pa.Table, first: int, floors: bool) -> DataFrame:
    """A row per search and cluster to look into: the ``first`` highest bounds, or with ``floors`` the others that reach the floor."""
    centres = _matrix(stats.column("centre").combine_chunks())
    radius, names = stats.column("radius").to_numpy(), stats.column("cluster").to_numpy()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            asked = _matrix(batch.column("embedding"))
            bounds = asked @ centres.T + np.linalg.norm(asked, axis=1)[:, None] * radius
            order = np.argsort(-bounds, axis=1, kind="stable")
            wanted = np.zeros(bounds.shape, bool)
            np.put_along_axis(wanted, order[:, :first], True, axis=1)
            if floors:
                floor = batch.column("floor").fill_null(-np.inf).to_numpy(zero_copy_only=False)
                # scores are rounded, and the bound is a sum in floating point: leave room for both
                room = 10.0**-SCORE_DECIMALS + 1e-9 * np.abs(bounds)
                wanted = ~wanted & (bounds + room >= floor[:, None])
            row, column = np.nonzero(wanted)
            part = batch.select(["q_id", "target_no", "asked", "n_targets", "k", "embedding"]).take(pa.array(row))
            target = pa.array(names[column]).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*part.columns[:5], target, part.columns[5]], list(SEARCH_COLUMNS))

    types = dict(searches.dtypes)
    schema = f"q_id {types['q_id']}, target_no int, asked string, n_targets int, k int, target string, embedding {types['embedding']}"
    return searches.mapInArrow(run, schema)


def _written(df: DataFrame, name: str) -> DataFrame:
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cluster_hits(
    spark: SparkSession, path: str, searches: DataFrame, first: int = FIRST, max_bytes: int = SEARCH_BYTES
) -> tuple[DataFrame, DataFrame]:
    """Hits of open searches in ``rank`` order, equal to ``best_hits`` over the whole index, and one row with ``searched`` and ``skipped``
    pairs of search and cluster."""
    stats = spark.read.schema(_STATS).parquet(f"{path}/clusters").orderBy("cluster").toArrow()
    rows = spark.read.schema("review_id string, restaurant_id string, embedding array<float>, distance double, cluster int").parquet(f"{path}/rows")
    lanes = rows.select("review_id", F.col("cluster").cast("string").alias("restaurant_id"), "embedding")
    asked = _written(searches.select(*SEARCH_COLUMNS), "searches").where(F.col("embedding").isNotNull())
    if not stats.num_rows:
        nothing = best_hits(lanes.limit(0), asked.limit(0))
        return nothing, spark.createDataFrame([(0, 0)], "searched bigint, skipped bigint")

    near = _written(_chosen(asked, stats, first, False), "near-clusters")
    early = _written(best_hits(lanes, near, max_bytes), "near-hits")
    floor = early.where(F.col("rank") == F.col("k")).select("q_id", "target_no", F.col("score").alias("floor"))
    rest = _written(_chosen(asked.join(floor, ["q_id", "target_no"], "left"), stats, first, True), "far-clusters")
    late = best_hits(lanes, rest, max_bytes)

    order = Window.partitionBy("q_id", "target_no").orderBy(F.desc("score"), "review_id")
    both = early.unionByName(late).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= F.col("k"))
    named = both.drop("restaurant_id").join(rows.select("review_id", "restaurant_id"), "review_id")
    looked = near.count() + rest.count()
    pairs = asked.count() * stats.num_rows
    return named, spark.createDataFrame([(looked, pairs - looked)], "searched bigint, skipped bigint")
