"""Quality classifier: a sparse rule ensemble.

Shallow trees are grown over document statistics; every path from a root to a node is a conjunction of intervals, a
rule. A lasso logistic regression weighs the rules, and the few with a weight are compiled into one column expression.

Statistics are built-in functions over the whole text; null, empty and blank texts have all statistics at zero and are
scored like any other text. Labels that are null are left out; a document labelled several times counts with the mean
of its labels. Without labels of both classes every score is the share of label 1 among them, 0.5 without any.
Very long texts are measured whole, row by row. Repeated rows are scored each on its own; input columns beside ``doc_id`` and ``text`` are never read.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.llm.common import whole_text, words, written
from reviewmill.llm.quality_rules import STOP_WORDS

MAX_TRAINING_ROWS = 200_000  # labelled rows the trees and the lasso see at most, picked by a hash of doc_id

STATISTICS = (
    "log_words", "word_length", "symbols", "marks", "capitals", "digits", "distinct_words", "distinct_pairs",
    "stop_words", "one_letter", "repeated_lines", "line_words",
)


def statistics(docs: DataFrame, *carried: Column) -> DataFrame:
    """doc_id, the carried columns and the statistics, one row per input row."""
    read = docs.select("doc_id", *carried, whole_text().alias("text"))
    own = [c for c in read.columns if c != "text"]
    cut = read.select(
        *own, "text", words(F.col("text")).alias("words"),
        F.filter(F.split("text", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
    )
    items, lines = F.col("words"), F.col("lines")
    hashed = F.transform(items, lambda w: F.xxhash64(w))
    pairs = F.zip_with(F.col("hashed"), F.slice("hashed", 2, F.greatest(F.size("hashed") - 1, F.lit(0))), lambda a, b: F.xxhash64(a, b))
    counted = cut.withColumn("hashed", hashed).select(
        *own,
        F.size(items).alias("n"), F.length(F.array_join(items, "")).alias("chars"), F.size(lines).alias("n_lines"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).alias("symbols"),
        F.regexp_count("text", F.lit(r"\p{P}")).alias("marks"),
        F.regexp_count("text", F.lit(r"\p{Lu}")).alias("capitals"),
        F.regexp_count("text", F.lit(r"[0-9]")).alias("digits"),
        F.size(F.array_distinct("hashed")).alias("distinct_words"),
        F.size(F.array_distinct(pairs)).alias("distinct_pairs"),
        F.size(F.filter(items, lambda w: F.lower(w).isin(*STOP_WORDS))).alias("stop_words"),
        F.size(F.filter(items, lambda w: F.length(w) == 1)).alias("one_letter"),
        (F.size(lines) - F.size(F.array_distinct(lines))).alias("repeated_lines"),
    )

    def share(of: str, whole: str) -> Column:
        return F.when(F.col(whole) > 0, F.col(of) / F.col(whole)).otherwise(0.0)

    return counted.select(
        *own,
        F.log1p("n").alias("log_words"), share("chars", "n").alias("word_length"),
        *(share(name, "chars").alias(name) for name in ("symbols", "marks", "capitals", "digits")),
        *(share(name, "n").alias(name) for name in ("distinct_words", "distinct_pairs", "stop_words", "one_letter")),
        share("repeated_lines", "n_lines").alias("repeated_lines"), share("n", "n_lines").alias("line_words"),
    )


@dataclass(frozen=True)
class Rule:
    """Intervals ``lowest < statistic <= highest`` that must all hold."""

    bounds: tuple[tuple[str, float, float], ...]

    def holds(self) -> Column:
        both = F.lit(True)
        for name, lowest, highest in self.bounds:
            if lowest > -math.inf:
                both = both & (F.col(name) > lowest)
            if highest < math.inf:
                both = both & (F.col(name) <= highest)
        return both


@dataclass(frozen=True)
class RuleModel:
    intercept: float
    weighted: tuple[tuple[Rule, float], ...]

    def score(self) -> Column:
        """Probability of label 1 as an expression over the statistics."""
        margin = F.lit(self.intercept)
        for rule, weight in self.weighted:
            margin = margin + F.when(rule.holds(), weight).otherwise(0.0)
        return 1.0 / (1.0 + F.exp(-margin))


_BRANCH = re.compile(r"^( *)(If|Else) \(feature (\d+) (<=|>) (\S+)\)$")


def paths(description: str, names: tuple[str, ...] = STATISTICS) -> list[Rule]:
    """Every distinct root-to-node path in the printed form of a tree ensemble."""
    rules: dict[Rule, None] = {}
    stack: list[tuple[int, str, str, float]] = []
    for line in description.splitlines():
        if not (found := _BRANCH.match(line)):
            if line.lstrip().startswith("Tree"):
                stack.clear()
            continue
        depth = len(found[1])
        while stack and stack[-1][0] >= depth:
            stack.pop()
        stack.append((depth, names[int(found[3])], found[4], float(found[5])))
        bounds: dict[str, tuple[float, float]] = {}
        for _, name, side, at in stack:
            lowest, highest = bounds.get(name, (-math.inf, math.inf))
            bounds[name] = (lowest, min(highest, at)) if side == "<=" else (max(lowest, at), highest)
        rules[Rule(tuple((name, *bounds[name]) for name in sorted(bounds)))] = None
    return list(rules)


def training_rows(measured: DataFrame, labels: DataFrame, most: int = MAX_TRAINING_ROWS) -> DataFrame:
    """Statistics and label of the labelled documents; beyond ``most`` rows those with the smallest hash share."""
    label = labels.where(F.col("quality").isNotNull()).groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("double").alias("label"))
    rows = written(measured.join(label, "doc_id").select("doc_id", "label", *STATISTICS), "quality-training")
    n = rows.count()
    if n > most:
        rows = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(1_000_000 * most / n))
    return rows


def fit(rows: DataFrame, trees: int = 24, depth: int = 3, penalty: float = 0.001, seed: int = 11) -> RuleModel:
    """Trees, their paths, then lasso weights over the paths."""
    seen = {row["label"]: row["n"] for row in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(seen) < 2:
        share = seen.get(1.0, 0) / sum(seen.values()) if seen else 0.5
        share = min(max(share, 1e-6), 1 - 1e-6)
        return RuleModel(math.log(share / (1 - share)), ())
    vectors = rows.select("label", array_to_vector(F.array(*STATISTICS)).alias("features"))
    forest = RandomForestClassifier(
        numTrees=trees, maxDepth=depth, featureSubsetStrategy="onethird", minInstancesPerNode=5, seed=seed,
    ).fit(vectors)
    rules = paths(forest.toDebugString)
    if not rules:
        return RuleModel(math.log(seen[1.0] / seen[0.0]), ())
    matched = rows.select("label", array_to_vector(F.array(*(rule.holds().cast("double") for rule in rules))).alias("features"))
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=penalty, maxIter=60, standardization=False).fit(matched)
    weights = lasso.coefficients.toArray().tolist()
    return RuleModel(lasso.intercept, tuple((rule, weight) for rule, weight in zip(rules, weights, strict=True) if weight))


def held_out() -> Column:
    """Rows never learned from: crc32 of the id as text leaves 1 when divided by 3. A null id is not held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


def classify(docs: DataFrame, labels: DataFrame, most: int = MAX_TRAINING_ROWS, carried: tuple[Column, ...] = ()) -> DataFrame:
    """doc_id, the carried columns, held_out, score and predicted of every document; texts are read once."""
    measured = written(statistics(docs, *carried), "quality-statistics")
    own = [c for c in measured.columns if c not in STATISTICS]
    model = fit(training_rows(measured.where(~held_out()), labels, most))
    return measured.select(*own, held_out().alias("held_out"), model.score().alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int"))
