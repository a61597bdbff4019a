"""A table of questions to a table of answer payloads."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.contracts import TOP_K
from reviewmill.operators.context import answer_payload, context_blocks, with_documents
from reviewmill.operators.dimension import name_dictionary
from reviewmill.operators.embed import QUERY, embed
from reviewmill.operators.search import hit_bound, retrieve
from reviewmill.operators.targets import add_text_targets, payload_ids, resolve_targets, split_questions
from reviewmill.session import fresh_path


def targeted_questions(questions: DataFrame, dimension: DataFrame, tags: DataFrame, match: str = "substring") -> tuple[DataFrame, DataFrame]:
    """Valid questions with ``targets``, and rejected ones with ``error``.

    ``questions`` holds ``q_id, question, restaurant_id string, restaurant_ids array<string>``;
    the last two are the request's optional filters.
    """
    asked = questions.select(
        "q_id", "question", payload_ids(F.col("restaurant_id"), F.col("restaurant_ids")).alias("payload_ids")
    )
    valid, rejected = split_questions(asked)
    found = add_text_targets(valid, name_dictionary(dimension), tags, match)
    return resolve_targets(found).drop("payload_ids"), rejected.select("q_id", "question", "error")


def answer_questions(
    questions: DataFrame,
    index: DataFrame,
    dimension: DataFrame,
    tags: DataFrame,
    answers: Callable[[DataFrame], DataFrame] | None = None,
    load: Callable | None = None,
    match: str = "substring",
    top_k: int = TOP_K,
    dim: int | None = None,
    **search,
) -> DataFrame:
    """``q_id, prompt, answer, sources, error`` for every question.

    ``answers`` maps the prompt table (q_id, prompt) to ``q_id, answer``; without it the
    answer of a question with evidence stays null. ``load`` names the embedding model the
    index was built with.
    """
    valid, rejected = targeted_questions(questions, dimension, tags, match)
    vectors = embed(valid, "question", QUERY, load, **({"dim": dim} if dim else {}))
    hits = retrieve(index, vectors, top_k, **search)
    blocks = context_blocks(with_documents(hits, index, hit_bound(valid.withColumn("embedding", F.lit(None)), top_k)))
    if answers is not None:
        # The model's prompts and the payload must show the same evidence, searched once.
        path = fresh_path(index.sparkSession, "evidence")
        blocks.write.parquet(path)
        blocks = index.sparkSession.read.schema(blocks.schema).parquet(path)
    payload = answer_payload(valid, blocks)
    if answers is not None:
        written = answers(payload.filter(F.col("prompt").isNotNull()).select("q_id", "prompt"))
        payload = answer_payload(valid, blocks, written)
    return payload.withColumn("error", F.lit(None).cast("string")).unionByName(
        rejected.select("q_id", "error"), allowMissingColumns=True
    )
