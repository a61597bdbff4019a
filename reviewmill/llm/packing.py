"""Packing into length buckets that minimise padding, and token-budget batches inside each bucket.

The histogram has a row per length that occurs. Dynamic programming over it finds the ``buckets``
boundaries with the least padding; a bucket is as long as its longest text. For one more bucket the cost of a boundary is a line in
the length of the bucket, so the best of them lie on a hull that is walked once: the time follows the lengths. A batch holds as many
texts as fit into the token budget at the bucket's length, one at least: nothing is cut or dropped.

Order inside a bucket is by hash. Rows are dealt to slots of about ``SLOT`` rows, ranked there, and shifted by the counts of
the slots before, so no task sorts a whole bucket and every batch but a bucket's last is full. Equal rows are counted ahead of that and
numbered, so they spread over slots like others. Null and empty texts have
length zero and sit in the shortest bucket; repeated rows each take a place, and null ids are placed like others. An empty
table gives no rows. Columns beside ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewmill.llm.common import whole_text, words, written

SLOT = 4096
COPIES = 4096  # equal rows that are numbered in one piece
BUCKETS = 16
BUDGET = 32_768


@dataclass(frozen=True)
class Bucket:
    longest: int
    rows: int
    capacity: int  # texts of a full batch
    first_batch: int


def best_bounds(rows: np.ndarray, longest: np.ndarray, buckets: int) -> list[int]:
    """Last lengths of at most ``buckets`` runs of lengths with the least padding in all, in order."""
    n = len(rows)
    before = [0, *np.cumsum(rows).tolist()]
    top = longest.tolist()
    # padding of a run is its rows at its longest, less its tokens; the tokens are the same for every choice
    best = [top[j] * before[j + 1] for j in range(n)]
    came = [[-1] * n]
    for _ in range(1, min(buckets, n)):
        grown, start = best.copy(), [-2] * n
        hull: list[int] = []  # ends i of the runs before, as lines best[i] - length * before[i + 1]
        at = 0
        for j in range(1, n):
            i = j - 1
            while len(hull) > at + 1 and (best[i] - best[hull[-2]]) * (before[hull[-1] + 1] - before[hull[-2] + 1]) <= (
                    best[hull[-1]] - best[hull[-2]]) * (before[i + 1] - before[hull[-2] + 1]):
                hull.pop()
            hull.append(i)
            while at + 1 < len(hull) and best[hull[at + 1]] - top[j] * before[hull[at + 1] + 1] <= best[hull[at]] - top[j] * before[hull[at] + 1]:
                at += 1
            cost = best[hull[at]] + top[j] * (before[j + 1] - before[hull[at] + 1])
            if cost < grown[j]:
                grown[j], start[j] = cost, hull[at]
        best = grown
        came.append(start)
    ends, j = [], n - 1
    for start in reversed(came):
        if j < 0:
            break
        if start[j] >= -1:
            ends.append(j)
            j = start[j]
    return ends[::-1]


def plan_buckets(lengths: DataFrame, buckets: int = BUCKETS, budget: int = BUDGET) -> list[Bucket]:
    """The buckets for a table with columns ``n_tokens`` and ``copies``; only the histogram of lengths reaches the driver."""
    cells = lengths.groupBy("n_tokens").agg(F.sum("copies").alias("rows")).toArrow()
    if not cells.num_rows:
        return []
    order = np.argsort(cells["n_tokens"].to_numpy())
    longest, rows = (cells[name].to_numpy()[order] for name in ("n_tokens", "rows"))
    planned, start, batch = [], 0, 0
    for end in best_bounds(rows, longest, buckets):
        top, n = int(longest[end]), int(rows[start:end + 1].sum())
        capacity = max(1, budget // max(1, top))
        planned.append(Bucket(top, n, capacity, batch))
        batch += -(-n // capacity)
        start = end + 1
    return planned


def _numbered(counted: DataFrame) -> DataFrame:
    """A row per copy, in an order by hash. Many copies are cut into pieces that other tasks number."""
    piece = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(COPIES).cast("long"))).alias("low")
    many = counted.where(F.col("copies") > COPIES).select("*", piece)
    pieces = many.repartition("row", "low").unionByName(counted.where(F.col("copies") <= COPIES).withColumn("low", F.lit(0).cast("long")))
    copy = F.explode(F.sequence("low", F.least(F.col("low") + COPIES, F.col("copies")) - 1)).alias("copy")
    return pieces.select("doc_id", "n_tokens", "row", copy).withColumn(
        "order", F.when(F.col("copy") == 0, F.col("row")).otherwise(F.xxhash64("row", "copy"))).drop("row", "copy")


def pack(docs: DataFrame, length: Column | None = None, buckets: int = BUCKETS, budget: int = BUDGET) -> DataFrame:
    """doc_id, n_tokens, bucket, bucket_length, batch_id and batch_position of every row.

    ``length`` is the number of tokens of a text, words if not given.
    """
    tokens = F.size(words(whole_text())) if length is None else length
    measured = docs.select("doc_id", F.coalesce(tokens, F.lit(0)).cast("long").alias("n_tokens"), F.xxhash64("doc_id", "text").alias("row"))
    counted = written(measured.groupBy("doc_id", "n_tokens", "row").agg(F.count("*").alias("copies")), "pack-lengths")
    planned = plan_buckets(counted, buckets, budget) or [Bucket(0, 0, 1, 0)]
    lengths = _numbered(counted)

    bucket = F.lit(len(planned) - 1)
    for number, one in reversed(list(enumerate(planned[:-1]))):
        bucket = F.when(F.col("n_tokens") <= one.longest, number).otherwise(bucket)

    def of_bucket(values: list[int]) -> Column:
        return F.array(*(F.lit(v).cast("long") for v in values))[F.col("bucket")]

    dealt = lengths.withColumn("bucket", bucket).withColumn(
        "slot", F.pmod("order", of_bucket([max(1, -(-one.rows // SLOT)) for one in planned])))
    before = Window.partitionBy("bucket").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = written(dealt.groupBy("bucket", "slot").agg(F.count("*").alias("n")).select(
        "bucket", "slot", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")), "pack-offsets")
    within = Window.partitionBy("bucket", "slot").orderBy("order", "doc_id")
    ranked = dealt.withColumn("rank", F.row_number().over(within)).join(offsets, ["bucket", "slot"])
    place = F.col("offset") + F.col("rank") - 1
    capacity = of_bucket([one.capacity for one in planned])
    return ranked.select(
        "doc_id", "n_tokens", "bucket", of_bucket([one.longest for one in planned]).alias("bucket_length"),
        (of_bucket([one.first_batch for one in planned]) + F.floor(place / capacity)).alias("batch_id"),
        F.pmod(place, capacity).alias("batch_position"))
