"""The review index: a Parquet table that grows by unseen review ids only."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from reviewmill.contracts import INDEX_SCHEMA, MAX_CHARS
from reviewmill.functions.numbers import to_number
from reviewmill.functions.text import chunk_array, has_text
from reviewmill.operators.embed import embed
from reviewmill.session import fresh_path

ROWS_PER_TASK = 20_000  # documents that one task embeds and writes
DOC_COLUMNS = ("review_id", "restaurant_id", "rating", "review_date", "review_text")


def as_documents(rows: DataFrame) -> DataFrame:
    """Index document columns: rating to float, malformed dates and ratings to null."""
    types = dict(rows.dtypes)
    rating = to_number(F.col("rating")) if types["rating"] == "string" else F.col("rating")
    date = F.try_to_date(F.nullif(F.col("review_date"), F.lit("")), "yyyy-MM-dd") if types["review_date"] == "string" else F.col("review_date")
    return rows.withColumns({"rating": rating.cast("float"), "review_date": date.cast("date")})


def chunks(docs: DataFrame, width: int = MAX_CHARS) -> DataFrame:
    """All fixed-width pieces of each text: ``review_id, chunk_no, chunk``."""
    return docs.select("review_id", F.posexplode(chunk_array(F.col("review_text"), width)).alias("chunk_no", "chunk"))


def _usable(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("review_id").isNotNull() & (F.col("review_id") != ""))


def new_documents(rows: DataFrame, indexed: DataFrame, order: Sequence[str] = ("pos",)) -> DataFrame:
    """One document per unseen id: its first row with text, in file order.

    The first row is picked by aggregation, so an id shared by many rows shrinks before the
    shuffle; the anti-join then meets unique ids and reads the id column of the index alone.
    """
    position = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    docs = as_documents(_usable(rows).filter(has_text(F.col("review_text"))))
    first = docs.groupBy("review_id").agg(F.min_by(F.struct(*DOC_COLUMNS[1:]), position).alias("doc"))
    return first.join(indexed.select("review_id"), "review_id", "left_anti").select("review_id", "doc.*")


def changed_documents(rows: DataFrame, index: DataFrame, order: Sequence[str] = ("pos",)) -> DataFrame:
    """Documents whose text is new or differs from the indexed text, by hash."""
    known = index.select("review_id", F.xxhash64("review_text").alias("_known"))
    docs = new_documents(rows, index.select("review_id").limit(0), order)
    joined = docs.join(known, "review_id", "left")
    return joined.filter(F.col("_known").isNull() | (F.col("_known") != F.xxhash64("review_text"))).drop("_known")


def increment_counts(rows: DataFrame, indexed: DataFrame, order: Sequence[str] = ("pos",)) -> DataFrame:
    """``indexed, skipped, blank, missing_id, bad_rating`` of one increment.

    A row is skipped when its id is in the index by the time its turn comes; a blank row
    ahead of that counts as blank.
    """
    position = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    usable = _usable(rows)
    full = has_text(F.col("review_text"))
    per_id = usable.groupBy("review_id").agg(
        F.min(F.when(full, position)).alias("first_full"), F.count_if(full).alias("full"), F.count_if(~full).alias("blank")
    ).join(indexed.select("review_id").distinct().withColumn("known", F.lit(True)), "review_id", "left")
    known = F.coalesce("known", F.lit(False))
    ids = per_id.agg(
        F.coalesce(F.count_if(~known & (F.col("full") > 0)), F.lit(0)).alias("indexed"),
        F.coalesce(F.sum(F.when(known, F.col("full") + F.col("blank")).when(F.col("full") > 0, F.col("full") - 1).otherwise(0)), F.lit(0)).alias("skipped"),
        F.coalesce(F.sum(F.when(~known, F.col("blank"))), F.lit(0)).alias("blank"),
    )
    # Blank rows behind the row that got indexed were skipped, not blank. Only blank rows
    # of such ids move, and the other side has one row per id.
    late = (
        usable.filter(~full).select("review_id", position.alias("at"))
        .join(per_id.filter(~known & (F.col("full") > 0) & (F.col("blank") > 0)).select("review_id", "first_full"), "review_id")
        .filter(F.col("at") > F.col("first_full"))
        .agg(F.count(F.lit(1)).alias("late"))
    )
    unreadable = F.col("rating").isNotNull() & ~F.col("rating").cast("string").isin("", "nan") & to_number(F.col("rating").cast("string")).isNull()
    totals = rows.agg(
        F.count_if(F.col("review_id").isNull() | (F.col("review_id") == "")).alias("missing_id"),
        F.count_if(unreadable).alias("bad_rating"),
    )
    # Three single-row results become one by summing their union; no join of constants.
    names = ("indexed", "skipped", "blank", "late", "missing_id", "bad_rating")
    rows_of_one = [
        f.select(*[(F.col(n) if n in f.columns else F.lit(0)).cast("bigint").alias(n) for n in names]) for f in (ids, late, totals)
    ]
    merged = rows_of_one[0].unionByName(rows_of_one[1]).unionByName(rows_of_one[2]).agg(*[F.sum(n).alias(n) for n in names])
    return merged.select(
        "indexed", (F.col("skipped") + F.col("late")).alias("skipped"), (F.col("blank") - F.col("late")).alias("blank"),
        "missing_id", "bad_rating",
    )


def ensure_index(spark: SparkSession, path: str) -> DataFrame:
    """Open the index, creating an empty one with the fixed schema on first use."""
    spark.createDataFrame([], INDEX_SCHEMA).write.mode("ignore").parquet(path)
    return spark.read.schema(INDEX_SCHEMA).parquet(path)


def append_documents(rows: DataFrame, path: str, order: Sequence[str] = ("pos",), load: Callable | None = None) -> None:
    """Embed and append unseen documents. The anti-join sits ahead of the vectoriser."""
    docs = new_documents(rows, ensure_index(rows.sparkSession, path), order)
    write_documents(embed(_spread(docs), "review_text", load=load), path, may_fail=load is not None)


def clustered(docs: DataFrame) -> DataFrame:
    """Group documents by restaurant.

    Row groups then cover few restaurants, so a targeted search skips most of them; the
    rebalance splits a restaurant too large for one task.
    """
    return docs.hint("rebalance", "restaurant_id").sortWithinPartitions("restaurant_id")


def _spread(docs: DataFrame, rows_per_task: int | None = None) -> DataFrame:
    """``clustered`` ahead of the vectoriser, while rows are still narrow.

    Tasks are cut by number of rows, a large restaurant into several: by the bytes of the narrow rows, a task would get many more
    vectors than one should make.
    """
    path = fresh_path(docs.sparkSession, "narrow")
    docs.write.parquet(path)
    staged = docs.sparkSession.read.schema(docs.schema).parquet(path)
    tasks = max(1, -(-staged.count() // (rows_per_task or ROWS_PER_TASK)))
    ranged = staged.coalesce(1) if tasks == 1 else staged.repartitionByRange(tasks, "restaurant_id", F.xxhash64("review_id"))
    return ranged.sortWithinPartitions("restaurant_id")


def _conformed(vectors: DataFrame) -> DataFrame:
    return vectors.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in INDEX_SCHEMA.fields])


def failures_path(path: str) -> str:
    """Where the documents stand that a model failed on, beside the index."""
    return f"{path.rstrip('/')}_failures"


def write_documents(vectors: DataFrame, path: str, may_fail: bool = True) -> None:
    """Append embedded documents; those the model failed on go to the failures table beside the index.

    The vectors are written once, by whether there is one, so the model sees every text once. Where none can be
    missing, as with the hashing vectoriser, they go to the index directly.
    """
    spark = vectors.sparkSession
    if not may_fail:
        _conformed(vectors).write.mode("append").parquet(path)
        return
    staged = fresh_path(spark, "embedded")
    _conformed(vectors).withColumn("failed", F.col("embedding").isNull()).write.partitionBy("failed").parquet(staged)
    tried = spark.read.schema(StructType([*INDEX_SCHEMA.fields, StructField("failed", BooleanType())])).parquet(staged)
    tried.filter(~F.col("failed")).drop("failed").write.mode("append").parquet(path)
    lost = tried.filter("failed").drop("failed")
    if not lost.isEmpty():
        lost.write.mode("append").parquet(failures_path(path))


def failures(spark: SparkSession, path: str) -> DataFrame:
    """The failures table of an index; it is created empty where it is missing."""
    return ensure_index(spark, failures_path(path))


def failed_documents(spark: SparkSession, path: str) -> DataFrame:
    """Documents in the failures table that the index still lacks, one row per id."""
    lost = failures(spark, path).drop("embedding").dropDuplicates(["review_id"])
    return lost.join(ensure_index(spark, path).select("review_id"), "review_id", "left_anti")


def retry_failures(spark: SparkSession, path: str, load: Callable | None = None) -> None:
    """Try the failed documents again. What fails once more stays in the failures table."""
    write_documents(embed(_spread(failed_documents(spark, path)), "review_text", load=load), path, may_fail=load is not None)


def refresh_index(rows: DataFrame, path: str, new_path: str, order: Sequence[str] = ("pos",), load: Callable | None = None) -> None:
    """Write a new version of the index in which changed texts are re-embedded.

    Texts are embedded first and written once. A changed document that the model fails on keeps its old row, so a new version
    never has fewer documents than the old one.
    """
    spark = rows.sparkSession
    index = ensure_index(spark, path)
    staged = fresh_path(spark, "changed")
    _conformed(embed(_spread(changed_documents(rows, index, order)), "review_text", load=load)).write.parquet(staged)
    tried = spark.read.schema(INDEX_SCHEMA).parquet(staged)
    fresh = tried.filter(F.col("embedding").isNotNull())
    kept = index.join(fresh.select("review_id"), "review_id", "left_anti")
    kept.unionByName(fresh).write.mode("errorifexists").parquet(new_path)
    lost = tried.filter(F.col("embedding").isNull())
    if not lost.isEmpty():
        lost.write.mode("append").parquet(failures_path(new_path))
