"""Which restaurants a question is about."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.contracts import MISSING_QUESTION_ERROR
from reviewmill.functions.text import strip
from reviewmill.operators.matching import LITERAL_LIMIT, holds, match_substrings


def split_questions(questions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Questions with text, stripped, and the rejected rest with ``error``."""
    stripped = questions.withColumn("question", F.coalesce(strip(F.col("question")), F.lit("")))
    rejected = stripped.filter(F.col("question") == "").withColumn("error", F.lit(MISSING_QUESTION_ERROR))
    return stripped.filter(F.col("question") != ""), rejected


def add_text_targets(
    questions: DataFrame, names: DataFrame, tags: DataFrame, match: str = "substring", literal_limit: int = LITERAL_LIMIT
) -> DataFrame:
    """Add ``text_targets``: ids of all tags and names found in the question, sorted.

    ``names`` is the name dictionary (name, restaurant_id), ``tags`` holds ``tag``; both in
    lower case. A small dictionary is filtered in place, row by row and without a shuffle;
    a larger one is joined on substrings of the text.
    """
    entries = names.select("name", "restaurant_id").unionByName(
        tags.select(F.col("tag").alias("name"), F.col("tag").alias("restaurant_id"))
    ).filter(F.length("name") > 0).distinct()
    word = match == "word"
    text = F.lower("question")
    few = entries.limit(literal_limit + 1).collect()
    if 0 < len(few) <= literal_limit:
        known = F.array(*[F.struct(F.lit(r["name"]).alias("name"), F.lit(r["restaurant_id"]).alias("id")) for r in few])
        found = F.transform(F.filter(known, lambda e: holds(text, e["name"], word)), lambda e: e["id"])
        return questions.withColumn("text_targets", F.array_sort(F.array_distinct(found)))
    lowered = questions.select("q_id", text.alias("text"))
    matched = match_substrings(lowered, entries.select("name"), "q_id", "text", "name", word, literal_limit)
    grouped = matched.join(entries, "name").groupBy("q_id").agg(
        F.sort_array(F.collect_set("restaurant_id")).alias("text_targets")
    )
    return questions.join(grouped, "q_id", "left").withColumn(
        "text_targets", F.coalesce("text_targets", F.array().cast("array<string>"))
    )


def resolve_targets(questions: DataFrame, empty_is_absent: bool = True) -> DataFrame:
    """Add ``targets``: several text matches win, else the payload, else the text match.

    ``payload_ids`` is the request's id list: null when absent. An empty list counts as
    absent; with ``empty_is_absent=False`` it clears the targets, so the search is open.
    """
    given = F.col("payload_ids").isNotNull()
    if empty_is_absent:
        given = given & (F.size("payload_ids") > 0)
    text = F.col("text_targets")
    targets = F.when(F.size(text) > 1, text).when(given, F.col("payload_ids")).otherwise(text)
    origin = (
        F.when(F.size(text) > 1, "text").when(given, "payload").when(F.size(text) == 1, "text").otherwise("none")
    )
    return questions.withColumns({"origin": origin, "targets": targets}).drop("text_targets")


def payload_ids(single: Column, several: Column) -> Column:
    """Request fields to one list: a non-empty single id first, then a non-empty list."""
    listed = F.when(F.size(several) > 0, several)
    return F.coalesce(F.when(single != "", F.array(single)), listed)


def unknown_targets(resolved: DataFrame, known: DataFrame) -> DataFrame:
    """Requested ids that no known restaurant has: ``q_id, target``."""
    asked = resolved.select("q_id", F.explode("targets").alias("target")).withColumn("restaurant_id", F.lower("target"))
    return asked.join(known.select("restaurant_id").distinct(), "restaurant_id", "left_anti").select("q_id", "target").distinct()
