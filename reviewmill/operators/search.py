"""Exact top-k review search for a table of searches.

A search is one question vector limited to one restaurant, or to none. Reviews are read
once in Arrow batches; each task multiplies its batches with the search matrix and keeps
the k best per search, so it sends k rows per search however much it read, and pairs are
never written out. Scores are rounded to nine decimals before ranking: equal scores are
ties, and the smaller review id comes first.

The search matrix travels to the tasks, so its size is bounded. Past the bound searches and
reviews are cut into blocks and parts by hash, per searched restaurant, and every block meets
every part of its restaurant in one job (``_grid``).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewmill.contracts import RELATIVE_CUTOFF, TOP_K
from reviewmill.session import fresh_path

SCORE_DECIMALS = 9
SEARCH_BYTES = 64 << 20
PART_ROWS = 16_384  # reviews of one cell of the grid: 64 MB of vectors of 1,024
BLOCK = 1024  # searches multiplied at a time; bounds the score matrix of one batch
SEARCH_COLUMNS = ("q_id", "target_no", "asked", "n_targets", "k", "target", "embedding")
HIT_COLUMNS = "q_id bigint, target_no int, asked string, n_targets int, k int, review_id string, restaurant_id string, score double, place string"


def _matrix(column: pa.Array) -> np.ndarray:
    """List column to a two-dimensional double array; ragged vectors are refused."""
    lengths = np.unique(column.value_lengths().to_numpy(zero_copy_only=False))
    if len(lengths) != 1:
        raise ValueError(f"embeddings of differing lengths in one batch: {lengths.tolist()}")
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), int(lengths[0]))


def _rows_by_name(column: pa.Array) -> tuple[pa.Array, dict[str | None, np.ndarray]]:
    """The names, and the row numbers of each name present in the batch."""
    encoded = column.dictionary_encode()
    codes = encoded.indices.fill_null(-1).to_numpy(zero_copy_only=False)
    order = np.argsort(codes, kind="stable")
    values = encoded.dictionary.to_pylist()
    edges = np.searchsorted(codes[order], np.arange(len(values) + 1))
    return column, {name: order[edges[i]:edges[i + 1]] for i, name in enumerate(values)}


def _scorer(searches: pa.Table) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Arrow batch function: reviews in, the task's best hits per search out."""
    matrix = _matrix(searches.column("embedding").combine_chunks())
    carried = searches.select(["q_id", "target_no", "asked", "n_targets", "k"]).combine_chunks()
    ks = np.asarray(searches.column("k").to_pylist())
    members: dict[str | None, list[int]] = {}
    for i, target in enumerate(searches.column("target").to_pylist()):
        members.setdefault(target, []).append(i)
    blocks = [(t, np.asarray(m[s:s + BLOCK])) for t, m in members.items() for s in range(0, len(m), BLOCK)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[list[tuple[float, str, str, str | None]]] = [[] for _ in ks]
        floors = np.full(len(ks), -np.inf)
        for batch in batches:
            if batch.num_rows == 0:
                continue
            vectors = _matrix(batch.column("embedding"))
            ids = batch.column("review_id")
            names, rows_of = _rows_by_name(batch.column("restaurant_id"))
            places = batch.column("place")
            for target, block in blocks:
                rows = np.arange(batch.num_rows) if target is None else rows_of.get(target)
                if rows is None:
                    continue
                scores = np.round(vectors[rows] @ matrix[block].T, SCORE_DECIMALS)
                candidate = scores >= floors[block]
                heavy = np.flatnonzero(candidate.sum(axis=0) > ks[block])
                if len(heavy):
                    # Keep what reaches the k-th score of the batch, ties included.
                    depth = len(rows) - min(int(ks[block].max()), len(rows))
                    kth = np.partition(scores[:, heavy], depth, axis=0)[depth]
                    candidate[:, heavy] &= scores[:, heavy] >= kth
                columns, hits = np.nonzero(candidate.T)
                starts = np.searchsorted(columns, np.arange(len(block) + 1))
                for j in np.unique(columns):
                    search, at = block[j], hits[starts[j]:starts[j + 1]]
                    best_ids = ids.take(pa.array(rows[at])).to_pylist()
                    chosen = pa.array(rows[at])
                    fresh = zip(scores[at, j].tolist(), best_ids, names.take(chosen).to_pylist(), places.take(chosen).to_pylist())
                    best = sorted([*kept[search], *fresh], key=lambda h: (-h[0], h[1]))[: ks[search]]
                    kept[search] = best
                    if len(best) == ks[search]:
                        floors[search] = best[-1][0]
        owners = [s for s, best in enumerate(kept) for _ in best]
        if owners:
            score, rid, rest, place = zip(*[h for best in kept for h in best])
            head = carried.take(pa.array(owners))
            yield pa.RecordBatch.from_arrays(
                [*[c.combine_chunks() for c in head.columns], pa.array(rid, pa.string()), pa.array(rest, pa.string()),
                 pa.array(score, pa.float64()), pa.array(place, pa.string())],
                names=[*head.column_names, "review_id", "restaurant_id", "score", "place"],
            )

    return run


def _one_pass(reviews: DataFrame, searches: pa.Table) -> DataFrame:
    targets = set(searches.column("target").to_pylist())
    if None not in targets and len(targets) <= 1000:
        # Reaches the scan as a partition or row-group filter.
        reviews = reviews.filter(F.col("restaurant_id").isin(sorted(targets)))
    return reviews.mapInArrow(_scorer(searches), HIT_COLUMNS)


def place_of(index: DataFrame) -> Column:
    """The file a row of the index stands in, null where the index is not read from files."""
    try:
        index.select("_metadata.file_path")
    except AnalysisException:
        return F.lit(None).cast("string").alias("place")
    return F.col("_metadata.file_path").alias("place")


def best_hits(index: DataFrame, searches: DataFrame, max_bytes: int = SEARCH_BYTES, located: bool = False) -> DataFrame:
    """Hits of each search in ``rank`` order, k at most.

    Only id, restaurant and vector are read here; texts join the few hits afterwards, with ``located`` from the files named in
    ``place`` (for an index that is one table of files). The searches are written once, so
    whatever embeds the questions runs once. More searches than fit ``max_bytes`` meet the reviews in a grid of blocks and parts.
    """
    spark = index.sparkSession
    place = place_of(index) if located else F.lit(None).cast("string").alias("place")
    reviews = index.select("review_id", "restaurant_id", "embedding", place).filter(F.col("embedding").isNotNull())
    # filtered after the write: a filter on a model's output ahead of it would run the model twice
    slim = _written(searches.select(*SEARCH_COLUMNS), "searches").filter(F.col("embedding").isNotNull())
    stats = slim.agg(F.count(F.lit(1)).alias("n"), F.max("k").alias("k"), F.max(F.size("embedding")).alias("dim")).first()
    if not stats["n"]:
        nothing = spark.createDataFrame([], HIT_COLUMNS + ", rank int")
        return nothing if located else nothing.drop("place")
    bound = max(1, max_bytes // (8 * stats["dim"] + 256))
    hits = _one_pass(reviews, slim.toArrow()) if stats["n"] <= bound else _grid(reviews, slim, bound)
    return _ranked(hits if located else hits.drop("place"), stats["k"])


def _lanes(reviews: DataFrame, slim: DataFrame, bound: int) -> DataFrame:
    """``target, blocks, parts`` of every restaurant that is searched: slices of its searches and of its reviews."""
    searched = slim.filter(F.col("target").isNotNull()).groupBy("target").agg(F.ceil(F.count(F.lit(1)) / bound).alias("blocks"))
    held = reviews.groupBy(F.col("restaurant_id").alias("target")).agg(F.ceil(F.count(F.lit(1)) / PART_ROWS).alias("parts"))
    return searched.join(held, "target")


def _grid(reviews: DataFrame, slim: DataFrame, bound: int) -> DataFrame:
    """Hits of more searches than fit one pass, as one job.

    A lane is a restaurant, or all reviews for open searches. Its searches are cut into blocks and its reviews into parts by hash;
    every block meets every part in a cell of its own, where the k best per search are kept. Searches and reviews of a cell fit a
    task; a cell's hits are k per search, and they are merged by rank. Nothing but counts comes to the driver.
    """
    spark = reviews.sparkSession
    lanes = _written(_lanes(reviews, slim, bound), "lanes")
    cells = ["lane", "part", "block"]
    aimed = reviews.join(lanes, reviews["restaurant_id"] == lanes["target"]).select(
        F.concat(F.lit("="), "target").alias("lane"), F.pmod(F.xxhash64("review_id"), "parts").alias("part"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("block"), *reviews.columns)
    asked = slim.join(lanes, "target").select(
        F.concat(F.lit("="), "target").alias("lane"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("part"),
        F.pmod(F.xxhash64("q_id", "target_no"), "blocks").alias("block"), *SEARCH_COLUMNS)
    n_open = slim.filter(F.col("target").isNull()).count()
    if n_open:
        blocks, parts = -(-n_open // bound), max(1, -(-reviews.count() // PART_ROWS))
        every = F.lit("*").alias("lane")
        aimed = aimed.unionByName(reviews.select(
            every, F.pmod(F.xxhash64("review_id"), F.lit(parts)).alias("part"),
            F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))).alias("block"), *reviews.columns))
        asked = asked.unionByName(slim.filter(F.col("target").isNull()).select(
            every, F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(parts - 1).cast("bigint"))).alias("part"),
            F.pmod(F.xxhash64("q_id", "target_no"), F.lit(blocks)).alias("block"), *SEARCH_COLUMNS))

    empty = spark.createDataFrame([], HIT_COLUMNS).toArrow()

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return empty
        found = list(_scorer(right.drop(cells))(iter(left.drop(cells).to_batches())))
        return pa.Table.from_batches(found).cast(empty.schema) if found else empty

    return aimed.groupBy(*cells).cogroup(asked.groupBy(*cells)).applyInArrow(score, HIT_COLUMNS)


def _written(df: DataFrame, name: str) -> DataFrame:
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _ranked(hits: DataFrame, deepest: int) -> DataFrame:
    order = Window.partitionBy("q_id", "target_no").orderBy(F.desc("score"), "review_id")
    ranked = hits.withColumn("rank", F.row_number().over(order))
    # The literal bound becomes a group limit ahead of the shuffle; k then trims each search.
    return ranked.filter((F.col("rank") <= deepest) & (F.col("rank") <= F.col("k")))


def apply_cutoff(hits: DataFrame, fraction: float = RELATIVE_CUTOFF, keep: Column | None = None) -> DataFrame:
    """Drop hits scoring below a fraction of their question's best score.

    ``keep`` marks rows the rule does not touch. A best score of zero or less gives no
    scale to compare with, so such a question keeps its hits.
    """
    best = F.max("score").over(Window.partitionBy("q_id"))
    passes = (best <= 0) | (F.col("score") >= best * fraction)
    if keep is not None:
        passes = passes | keep
    return hits.withColumn("_passes", passes).filter("_passes").drop("_passes")


def per_target_k(n_targets: Column, top_k: int = TOP_K) -> Column:
    """k of one search: all of it for up to one target, an even share of at least two beyond."""
    share = F.greatest(F.lit(2), F.floor(F.lit(top_k) / n_targets).cast("int"))
    return F.when(n_targets > 1, share).otherwise(F.lit(top_k)).cast("int")


def plan_searches(questions: DataFrame, top_k: int = TOP_K, filter_mode: str = "pre") -> DataFrame:
    """One row per search from ``q_id, targets array<string>, embedding``.

    Targets are lower-cased as the index stores ids; a repeated target stays repeated.
    ``filter_mode='post'`` searches everything and leaves the restaurant to a later filter.
    """
    if filter_mode not in ("pre", "post"):
        raise ValueError(f"unknown filter_mode {filter_mode!r}")
    rows = questions.select(
        F.col("q_id").cast("bigint").alias("q_id"), "embedding",
        F.greatest(F.coalesce(F.size("targets"), F.lit(0)), F.lit(0)).alias("n_targets"),
        F.posexplode_outer("targets").alias("target_no", "asked"),
    )
    asked = F.lower("asked")
    return rows.select(
        "q_id", F.coalesce("target_no", F.lit(0)).alias("target_no"), asked.alias("asked"), "n_targets",
        per_target_k(F.col("n_targets"), top_k).alias("k"),
        (asked if filter_mode == "pre" else F.lit(None).cast("string")).alias("target"), "embedding",
    )


def first_rows(index: DataFrame, targets: DataFrame, k: int) -> DataFrame:
    """The k smallest ids of each wanted restaurant: ``review_id, restaurant_id, rank``."""
    order = Window.partitionBy("restaurant_id").orderBy("review_id")
    return (
        index.select("review_id", "restaurant_id")
        .join(targets.select("restaurant_id").distinct(), "restaurant_id", "left_semi")
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
    )


def with_fallback(hits: DataFrame, searches: DataFrame, index: DataFrame, top_k: int = TOP_K) -> DataFrame:
    """Give each targeted search without hits the first rows of its restaurant.

    ``fallback`` marks them; their score is null. One left join serves both cases, so the
    hits are computed once.
    """
    keys = ["q_id", "target_no"]
    wanted = searches.select(*keys, "asked", "n_targets", "k")
    located = [c for c in hits.columns if c == "place"]
    joined = wanted.join(hits.select(*keys, "review_id", "restaurant_id", "score", "rank", *located), keys, "left")
    targets = wanted.filter(F.col("asked").isNotNull()).select(F.col("asked").alias("restaurant_id"))
    spare = first_rows(index, targets, top_k).select(
        F.col("review_id").alias("_spare_id"), F.col("restaurant_id").alias("_spare_of"), F.col("rank").alias("_spare_rank")
    )
    needs = F.col("review_id").isNull() & (F.col("asked") == F.col("_spare_of")) & (F.col("_spare_rank") <= F.col("k"))
    filled = joined.join(spare, needs, "left")
    return filled.select(
        *keys, "asked", "n_targets", "k",
        F.coalesce("review_id", "_spare_id").alias("review_id"), F.coalesce("restaurant_id", "_spare_of").alias("restaurant_id"),
        "score", F.coalesce("rank", "_spare_rank").alias("rank"), F.col("review_id").isNull().alias("fallback"), *located,
    ).filter(F.col("review_id").isNotNull())


def retrieve(
    index: DataFrame,
    questions: DataFrame,
    top_k: int = TOP_K,
    fraction: float = RELATIVE_CUTOFF,
    filter_mode: str = "pre",
    transform: Callable[[Column], Column] | None = None,
    max_bytes: int = SEARCH_BYTES,
    located: bool = False,
) -> DataFrame:
    """Evidence per question: ``q_id, target_no, rank, review_id, restaurant_id, score, fallback``, with ``located`` also ``place``.

    No target: best of all, cut off. One: best of the restaurant, cut off. Several: an
    even share each, not cut off. With ``filter_mode='post'`` the best of all are picked
    first, and a target left without hits falls back to rows of its restaurant by id; with
    ``'pre'`` a restaurant that has any row has hits, so no fallback can arise.
    ``transform`` maps scores monotonically ahead of the cut-off.
    """
    searches = plan_searches(questions, top_k, filter_mode)
    hits = best_hits(index, searches, max_bytes, located)
    if transform is not None:
        hits = hits.withColumn("score", transform(F.col("score")))
    if filter_mode == "post":
        inside = hits.filter(F.col("asked").isNull() | (F.col("asked") == F.col("restaurant_id")))
        hits = with_fallback(inside, searches, index, top_k)
    else:
        hits = hits.withColumn("fallback", F.lit(False))
    kept = apply_cutoff(hits, fraction, keep=F.col("fallback") | (F.col("n_targets") > 1))
    return kept.select("q_id", "target_no", "rank", "review_id", "restaurant_id", "score", "fallback", *(["place"] if located else []))


def hit_bound(questions: DataFrame, top_k: int = TOP_K) -> int:
    """Most hits a retrieval can return, from the questions alone."""
    searches = plan_searches(questions, top_k)
    return searches.agg(F.sum("k")).first()[0] or 0
