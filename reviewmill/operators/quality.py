"""Data-quality checks as tables of ``check_id, dataset, n_bad, sample_ids``.

Row checks share one scan of the processed facts. Checks that compare raw with processed
share one aggregation: both sides become flag rows under (dataset, review_id), and the
flags combine by bit operations, so hot ids shrink before the shuffle and no join runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.contracts import (
    FACT_COLUMNS, NULLED_ON_DUPLICATE, PASSTHROUGH_FIELDS, REFERENCE_COLUMNS, VALID_RATINGS,
)
from reviewmill.functions.dates import is_iso_date
from reviewmill.functions.ids import is_base64url, is_near_dup
from reviewmill.functions.text import is_blank
from reviewmill.operators.headers import schema_issues
from reviewmill.operators.reports import counted_with_sample

RESULT = "check_id string, dataset string, n_bad bigint, sample_ids array<string>"
KEYS = ("check_id", "dataset")


def _blank(df: DataFrame, column: str) -> Column:
    return is_blank(F.col(column), dict(df.dtypes)[column])


def row_failures(facts: DataFrame, dataset: str | None = None) -> DataFrame:
    """``check_id, dataset, review_id`` of every failed row check on processed facts.

    ``dataset`` names the column with the source of a row's file: ``source`` where there is one. A restaurant id that is null
    or not its source's fails.
    """
    types = dict(facts.dtypes)
    dataset = dataset or ("source" if "source" in types else "restaurant_id")
    rating_text = F.col("rating")
    date_ok = F.col("review_date").isNotNull() if types["review_date"] == "date" else is_iso_date(F.col("review_date"))
    several = F.col("transaction_count") > 1
    rules: dict[str, Column] = {
        "rating_domain": ~_blank(facts, "rating") & ~rating_text.isin(list(VALID_RATINGS)),
        "date_format": ~date_ok,
        "near_dup_left": is_near_dup(F.col("review_id")),
        "id_encoding": ~is_base64url(F.col("review_id"), allow_empty=False),
        "restaurant_mismatch": ~F.lower("restaurant_id").eqNullSafe(F.lower(F.col(dataset))),
    }
    for field in NULLED_ON_DUPLICATE:
        if field in types:
            rules[f"not_nulled_{field}"] = several & ~_blank(facts, field)
    failed = F.array_compact(F.array(*[F.when(rule, F.lit(name)) for name, rule in rules.items()]))
    return facts.select(F.col(dataset).alias("dataset"), "review_id", F.explode(failed).alias("check_id")).select(
        "check_id", "dataset", "review_id"
    )


# Bit per fact that holds of a review id on one side or the other.
_RAW, _PROCESSED, _RAW_RATED, _UNRATED, _TOTAL_MISSING, _COLLAPSED, _UNIQUE = (1 << i for i in range(7))
_FIRST_FIELD = 7
_LOSABLE = len(PASSTHROUGH_FIELDS)


def _flag(condition: Column, bit: int) -> Column:
    return F.when(condition, F.lit(bit)).otherwise(F.lit(0))


def _any_of(flags: list[Column]) -> Column:
    total = flags[0]
    for flag in flags[1:]:
        total = total.bitwiseOR(flag)
    return total


def id_flags(raw: DataFrame, facts: DataFrame) -> DataFrame:
    """Everything the raw-to-processed checks need, one row per (dataset, review_id).

    ``raw`` holds the raw contract with ``source`` and ``pos``, before any cleaning;
    ``must_derive`` looks at the first raw row of an id only.
    """
    had = [_flag(~_blank(raw, c), 1 << (_FIRST_FIELD + i)) for i, c in enumerate(PASSTHROUGH_FIELDS)]
    lost = [_flag(_blank(facts, c), 1 << (_FIRST_FIELD + _LOSABLE + i)) for i, c in enumerate(PASSTHROUGH_FIELDS)]
    derivable = F.coalesce(
        ~is_near_dup(F.col("review_id")) & _blank(raw, "total_spent")
        & (F.col("tip_amount").try_cast("double") > 0) & (F.col("tip_percentage").try_cast("double") > 0),
        F.lit(False),
    )
    raw_side = raw.filter(F.col("review_id").isNotNull()).select(
        F.col("source").alias("dataset"), "review_id",
        _any_of([F.lit(_RAW), _flag(~_blank(raw, "rating"), _RAW_RATED), *had]).alias("flags"),
        "pos", derivable.alias("must_derive"), F.lit(0).alias("processed_rows"),
    )
    count = F.coalesce("transaction_count", F.lit(1))
    total_bad = _blank(facts, "total_spent") | ~(F.col("total_spent") > 0)
    processed_side = facts.select(
        F.col("restaurant_id").alias("dataset"), "review_id",
        _any_of([
            F.lit(_PROCESSED), _flag(_blank(facts, "rating"), _UNRATED), _flag(F.coalesce(total_bad, F.lit(True)), _TOTAL_MISSING),
            _flag(count > 1, _COLLAPSED), _flag(count == 1, _UNIQUE), *lost,
        ]).alias("flags"),
        F.lit(None).cast("bigint").alias("pos"), F.lit(None).cast("boolean").alias("must_derive"),
        F.lit(1).alias("processed_rows"),
    )
    return merge_flags(raw_side.unionByName(processed_side))


def merge_flags(flags: DataFrame) -> DataFrame:
    """Flag rows of any number of increments, combined to one per (dataset, review_id); rows of the result combine again."""
    return flags.groupBy("dataset", "review_id").agg(
        F.bit_or("flags").alias("flags"),
        F.min_by("must_derive", "pos").alias("must_derive"),
        F.min("pos").alias("pos"),
        F.sum("processed_rows").alias("processed_rows"),
    )


STATE = "dataset string, review_id string, flags int, must_derive boolean, pos bigint, processed_rows bigint, increment string"


def add_to_state(raw: DataFrame, facts: DataFrame, path: str, increment: str) -> None:
    """Keep the flags of one increment's raw rows and processed facts; the same increment again replaces itself.

    An increment costs its own rows: what was kept before is neither read nor written.
    """
    flags = id_flags(raw, facts).withColumn("increment", F.lit(increment))
    flags.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("increment").parquet(path)


def state_flags(spark: SparkSession, path: str) -> DataFrame:
    """The flags of all increments together, as ``id_flags`` has them over all rows at once. ``pos`` orders rows across increments."""
    return merge_flags(spark.read.schema(STATE).parquet(path).drop("increment"))


def compact_state(spark: SparkSession, path: str, new_path: str, increment: str = "compacted") -> None:
    """The increments as one, beside the old table."""
    state_flags(spark, path).withColumn("increment", F.lit(increment)).write.partitionBy("increment").parquet(new_path)


def id_failures(raw: DataFrame, facts: DataFrame) -> DataFrame:
    """``check_id, dataset, review_id`` of every failed raw-to-processed check."""
    return flag_failures(id_flags(raw, facts))


def flag_failures(grouped: DataFrame) -> DataFrame:
    """``check_id, dataset, review_id`` of every check that the flags say failed."""

    def has(bit: int) -> Column:
        return F.col("flags").bitwiseAND(F.lit(bit)) != 0

    rules = {
        "rating_lost": has(_PROCESSED) & has(_UNRATED) & has(_RAW_RATED),
        "total_not_derived": F.coalesce("must_derive", F.lit(False))
        & (~has(_PROCESSED) | (~has(_COLLAPSED) & has(_TOTAL_MISSING))),
        "id_not_unique": F.col("processed_rows") > 1,
    }
    for i, field in enumerate(PASSTHROUGH_FIELDS):
        rules[f"lost_{field}"] = (
            has(_UNIQUE) & has(1 << (_FIRST_FIELD + i)) & has(1 << (_FIRST_FIELD + _LOSABLE + i))
        )
    failed = F.array_compact(F.array(*[F.when(rule, F.lit(name)) for name, rule in rules.items()]))
    return grouped.select("dataset", "review_id", F.explode(failed).alias("check_id")).select(
        "check_id", "dataset", "review_id"
    )


def reconciliation(raw: DataFrame, facts: DataFrame, orphans: DataFrame, quarantined: DataFrame) -> DataFrame:
    """Raw rows against processed rows weighted by transaction count, per dataset.

    ``unexplained`` is what is left after orphan near-duplicates and rows without an id.
    """
    def tagged(df: DataFrame, key: str, measure: str, value: Column) -> DataFrame:
        names = ("raw_rows", "weighted_rows", "orphan_rows", "quarantined_rows")
        return df.select(
            F.col(key).alias("dataset"), *[(value if n == measure else F.lit(0)).cast("bigint").alias(n) for n in names]
        )

    one = F.lit(1)
    parts = (
        tagged(raw, "source", "raw_rows", one)
        .unionByName(tagged(facts, "restaurant_id", "weighted_rows", F.coalesce("transaction_count", one)))
        .unionByName(tagged(orphans, "source", "orphan_rows", F.col("orphan_rows")))
        .unionByName(tagged(quarantined, "source", "quarantined_rows", one))
    )
    sums = parts.groupBy("dataset").agg(
        *[F.sum(c).alias(c) for c in ("raw_rows", "weighted_rows", "orphan_rows", "quarantined_rows")]
    )
    difference = F.col("raw_rows") - F.col("weighted_rows")
    return sums.withColumns({
        "difference": difference,
        "unexplained": difference - F.col("orphan_rows") - F.col("quarantined_rows"),
    })


def restaurant_ids(facts: DataFrame, dimension: DataFrame) -> DataFrame:
    """Ids found on one side only: ``restaurant_id, in_facts, in_reference``."""
    fact_ids = facts.select(F.lower("restaurant_id").alias("restaurant_id")).distinct().withColumn("in_facts", F.lit(True))
    reference_ids = (
        dimension.filter(F.col("restaurant_id").isNotNull())
        .select(F.lower("restaurant_id").alias("restaurant_id")).distinct().withColumn("in_reference", F.lit(True))
    )
    both = fact_ids.join(reference_ids, "restaurant_id", "full_outer").fillna(False, ["in_facts", "in_reference"])
    return both.filter(~(F.col("in_facts") & F.col("in_reference")))


def contract_failures(facts: DataFrame, dimension: DataFrame) -> DataFrame:
    """Column-set and column-order findings; the column names stand in as ids."""
    rows = []
    for dataset, df, contract in (("facts", facts, FACT_COLUMNS), ("reference", dimension, REFERENCE_COLUMNS)):
        issues = schema_issues(df, contract)
        rows.append((f"{dataset}_schema", dataset, len(issues["missing"]) + len(issues["extra"]), issues["missing"] + issues["extra"]))
        rows.append((f"{dataset}_column_order", dataset, int(bool(issues["disordered"])), issues["disordered"]))
    return facts.sparkSession.createDataFrame(rows, RESULT)


def reference_null_ids(dimension: DataFrame) -> DataFrame:
    return dimension.agg(F.count_if(F.col("restaurant_id").isNull()).alias("n_bad")).select(
        F.lit("reference_null_id").alias("check_id"), F.lit("reference").alias("dataset"), "n_bad",
        F.array().cast("array<string>").alias("sample_ids"),
    )


def cross_id_results(facts: DataFrame, dimension: DataFrame) -> DataFrame:
    lone = restaurant_ids(facts, dimension).select(
        F.when(F.col("in_facts"), "restaurant_not_in_reference").otherwise("restaurant_without_facts").alias("check_id"),
        F.lit("all").alias("dataset"), "restaurant_id",
    )
    return counted_with_sample(lone, KEYS, "restaurant_id")


def dq_results(raw: DataFrame, facts: DataFrame, dimension: DataFrame) -> DataFrame:
    """All checks that found something, plus the contract checks whether or not they did."""
    failures = row_failures(facts).unionByName(id_failures(raw, facts))
    return (
        counted_with_sample(failures, KEYS, "review_id")
        .unionByName(cross_id_results(facts, dimension))
        .unionByName(reference_null_ids(dimension))
        .unionByName(contract_failures(facts, dimension))
    )
