"""Grounded context and source lists per question."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.contracts import NO_EVIDENCE_ANSWER
from reviewmill.operators.bounds import BROADCAST_ROWS
from reviewmill.session import fresh_path

MAX_FILES = 10_000  # files and restaurants named in the filter of the second read
EVIDENCE = ("review_id", "restaurant_id", "rating", "review_text")


def with_documents(hits: DataFrame, index: DataFrame, bound: int | None = None) -> DataFrame:
    """Rating and text for the hits, from the index that was searched.

    ``bound`` is the most hits there can be (``search.hit_bound``); when that many ids fit
    a broadcast they filter the index scan in place, otherwise the join shuffles. Hits that
    know the file they stand in (``place``) are written, and only their files and restaurants are read again.
    """
    small = bound is not None and bound <= BROADCAST_ROWS
    if small and "place" in hits.columns:
        hits = _written(hits, "hits")
        found = hits.select("place", "restaurant_id").distinct().limit(MAX_FILES + 1).collect()
        files, restaurants = ({r[c] for r in found} for c in ("place", "restaurant_id"))
        if found and len(found) <= MAX_FILES and None not in files:
            index = index.where(F.col("_metadata.file_path").isin(sorted(files)) & F.col("restaurant_id").isin(sorted(restaurants)))
    hits = hits.drop("place")
    docs = index.select("review_id", "rating", "review_text")
    return docs.join(F.broadcast(hits) if small else hits, "review_id")


def _written(df: DataFrame, name: str) -> DataFrame:
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def context_line(restaurant: Column, rating: Column, text: Column) -> Column:
    return F.concat(
        F.lit("- Restaurant: "), F.coalesce(restaurant, F.lit("unknown")),
        F.lit(" | Rating: "), F.coalesce(rating.cast("string"), F.lit("n/a")),
        F.lit(" | Review: "), F.coalesce(text, F.lit("")),
    )


def context_blocks(evidence: DataFrame) -> DataFrame:
    """``q_id, n_sources, context, sources``: evidence in target then rank order.

    Retrieval bounds the rows of a question, so its list stays short.
    """
    line = context_line(F.col("restaurant_id"), F.col("rating"), F.col("review_text"))
    row = F.struct("target_no", "rank", line.alias("line"), F.struct(*EVIDENCE).alias("source"))
    grouped = evidence.groupBy("q_id").agg(F.sort_array(F.collect_list(row)).alias("rows"))
    return grouped.select(
        "q_id", F.size("rows").alias("n_sources"),
        F.array_join(F.transform("rows", lambda r: r["line"]), "\n").alias("context"),
        F.transform("rows", lambda r: r["source"]).alias("sources"),
    )


def prompt(question: Column, context: Column) -> Column:
    return F.concat(F.lit("Use only these reviews.\n"), context, F.lit("\n\nAsked: "), question, F.lit("\nReply:"))


def answer_payload(questions: DataFrame, blocks: DataFrame, answers: DataFrame | None = None) -> DataFrame:
    """``q_id, prompt, answer, sources`` for every question.

    A question without evidence gets the fixed answer and no sources. ``answers``
    (q_id, answer) comes from whatever model the caller runs over the prompts.
    """
    joined = questions.select("q_id", "question").join(blocks, "q_id", "left")
    joined = joined.join(answers, "q_id", "left") if answers is not None else joined.withColumn("answer", F.lit(None).cast("string"))
    nothing = F.col("sources").isNull()
    return joined.select(
        "q_id", prompt(F.col("question"), F.col("context")).alias("prompt"),
        F.when(nothing, F.lit(NO_EVIDENCE_ANSWER)).otherwise(F.col("answer")).alias("answer"),
        F.coalesce("sources", F.array().cast(dict(blocks.dtypes)["sources"])).alias("sources"),
    )
