"""Scoring of answers against expected keywords and the latency target."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.contracts import LATENCY_TARGET_SECONDS, REFUSAL_CATEGORIES, REFUSAL_MARK, REFUSAL_PHRASES
from reviewmill.functions.text import contains_any, matched_keywords
from reviewmill.operators.profile import interpolated_percentile


def score_answers(cases: DataFrame, answers: DataFrame) -> DataFrame:
    """Add ``matched_keywords, refused, passed`` to cases joined with ``id, answer``.

    A pass is a non-empty answer holding a keyword, or a refusal where the category
    allows one. A case without an answer fails.
    """
    joined = cases.join(answers, "id", "left").withColumn("answer", F.coalesce("answer", F.lit("")))
    category_refuses = F.upper(F.coalesce("category", F.lit(""))).isin(list(REFUSAL_CATEGORIES))
    scored = joined.withColumns({
        "_matched": matched_keywords(F.col("answer"), F.coalesce("expected_keywords", F.array().cast("array<string>"))),
        "refused": category_refuses & contains_any(F.col("answer"), REFUSAL_PHRASES),
    })
    passed = (F.length("answer") > 0) & ((F.size("_matched") > 0) | F.col("refused"))
    marked = F.when(F.col("refused"), F.array_append("_matched", F.lit(REFUSAL_MARK))).otherwise(F.col("_matched"))
    return scored.withColumns({"passed": passed, "matched_keywords": marked}).drop("_matched")


def summarize(scored: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Tests, passes and pass rate in percent, one decimal."""
    return scored.groupBy(*by).agg(
        F.count(F.lit(1)).alias("tests"),
        F.count_if("passed").alias("passed"),
        F.round(F.avg(F.col("passed").cast("int")) * 100, 1).alias("pass_rate"),
    )


def latency_report(answers: DataFrame, target: float = LATENCY_TARGET_SECONDS) -> DataFrame:
    """Share of answers within the target, mean and 95th percentile, all exact; no row where there is no latency.

    The percentile reads one bin of latencies, so no task holds them all.
    """
    timed = answers.filter(F.col("latency").isNotNull()).select(F.lit("all").alias("_group"), "latency")
    totals = timed.agg(
        F.count(F.lit(1)).alias("answers"), F.round(F.avg("latency"), 4).alias("mean"),
        F.round(F.avg((F.col("latency") <= target).cast("int")), 6).alias("within_target")).withColumn("p95", F.lit(None).cast("double"))
    p95 = interpolated_percentile(timed, "_group", "latency", 0.95, "p95").select(F.round("p95", 4).alias("p95"))
    # two rows of one, brought together without a join
    merged = totals.unionByName(p95, allowMissingColumns=True).agg(*[F.max(c).alias(c) for c in ("answers", "p95", "mean", "within_target")])
    return merged.filter(F.col("answers") > 0)
