"""Schemas and fixed values shared by all jobs."""

from __future__ import annotations

from pyspark.sql import types as T

# ---- fixed values: column contracts, markers, phrases and thresholds ----

RAW_FACT_COLUMNS = (
    "review_id", "customer_id", "review_date", "rating", "review_text", "location", "restaurant_name",
    "total_spent", "tip_amount", "tip_percentage", "party_size", "age_range", "gender", "ethnicity",
)
FACT_COLUMNS = (
    "review_id", "customer_id", "review_date", "rating", "review_text", "total_spent", "tip_amount",
    "party_size", "age_range", "gender", "ethnicity", "transaction_count", "restaurant_id",
)
REFERENCE_COLUMNS = (
    "source_file_tag", "restaurant_name", "original_city", "address", "categories", "restaurant_id",
)
RAW_REFERENCE_COLUMNS = (
    "location", "restaurant_name", "original_city", "address", "categories", "avg_stars", "total_reviews",
)
NULLED_ON_DUPLICATE = (
    "customer_id", "total_spent", "tip_amount", "tip_percentage", "party_size", "age_range", "gender", "ethnicity",
)
COALESCED_FIELDS = ("review_date", "rating", "review_text")
PASSTHROUGH_FIELDS = (
    "review_text", "customer_id", "party_size", "age_range", "gender", "ethnicity", "total_spent", "tip_amount",
)
CONFIDENCE = {
    "high": ("review_id", "rating", "review_text", "review_date"),
    "medium": ("customer_id", "total_spent", "tip_amount", "tip_percentage"),
    "low": ("party_size", "age_range", "gender", "ethnicity"),
}
REFERENCE_MARKERS = ("restaurant_info", "reference")
VALID_RATINGS = (1, 2, 3, 4, 5)
MAX_CHARS = 2000
EMBEDDING_DIM = 1024
TOP_K = 5
RELATIVE_CUTOFF = 0.7
REFUSAL_CATEGORIES = ("RATINGS", "CALCULATIONS")
REFUSAL_PHRASES = ("not authorized", "cannot calculate", "quantitative questions", "typically say")
REFUSAL_MARK = "GUARDRAIL_INTERCEPTED"
NO_EVIDENCE_ANSWER = "I couldn't find any relevant reviews to answer that question."
MISSING_QUESTION_ERROR = 'Missing "question" in request body.'
LATENCY_TARGET_SECONDS = 3.0
# Cells pandas reads as missing by default (pandas documentation, read_csv, na_values).
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A",
    "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# ---- schemas ----

CONFIG_SCHEMA = T.StructType([
    T.StructField("source_dataset", T.StringType()),
    T.StructField("input_column", T.StringType()),
    T.StructField("target_column", T.StringType()),
    T.StructField("rating_divisor", T.DoubleType()),
])


def _tier(column: str) -> dict:
    return next(({"confidence": tier} for tier, cols in CONFIDENCE.items() if column in cols), {})


_FACT_TYPES = {
    "review_date": T.DateType(), "rating": T.DoubleType(), "total_spent": T.DoubleType(),
    "tip_amount": T.DoubleType(), "party_size": T.IntegerType(), "transaction_count": T.LongType(),
}
FACT_SCHEMA = T.StructType([
    T.StructField(c, _FACT_TYPES.get(c, T.StringType()), True, _tier(c)) for c in FACT_COLUMNS
])
REFERENCE_SCHEMA = T.StructType([
    T.StructField(c, T.ArrayType(T.StringType()) if c == "categories" else T.StringType())
    for c in REFERENCE_COLUMNS
])
INDEX_SCHEMA = T.StructType([
    T.StructField("review_id", T.StringType()),
    T.StructField("restaurant_id", T.StringType()),
    T.StructField("rating", T.FloatType()),
    T.StructField("review_date", T.DateType()),
    T.StructField("review_text", T.StringType()),
    T.StructField("embedding", T.ArrayType(T.FloatType())),
])
EVAL_CASE_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("query", T.StringType()),
    T.StructField("expected_keywords", T.ArrayType(T.StringType())),
])
