"""From documents to packed training batches: five stages, each over what the one before kept.

Every stage takes (spark, docs, sf_dir); its result is written as Parquet and read again as the next one's docs. All but the
last keep the columns of documents. A verdict holds for rows of one doc_id and one text, so rows that share an id, or have none,
are dropped each for its own text; null texts count as empty throughout.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reviewmill.llm import blob_ledger, exact_dedup, packing, rule_ensemble, simhash
from reviewmill.llm.common import DIGEST, table, text_digest, without, written
from reviewmill.session import fresh_path

SHINGLE_WORDS = 3
RADIUS = 2


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble does not reject."""
    judged = rule_ensemble.classify(docs, table(spark, sf_dir, "labels"), carried=(text_digest(),))
    return without(docs.select("*", text_digest()), judged.where("predicted = 0"), "doc_id", DIGEST).select(*docs.columns)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.keep_first(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near-equal fingerprints."""
    return simhash.keep_one(docs, SHINGLE_WORDS, RADIUS)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with what the secret scan found replaced by its kind."""
    ledger = fresh_path(spark, "blob-ledger")
    blob_ledger.update_ledger(docs, ledger)
    return blob_ledger.redact(docs, ledger)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bucket, batch and place of every document."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("exact dedup", exact_duplicates),
    ("simhash near-dedup", near_duplicates),
    ("secret scans", secrets),
    ("packing", pack),
]

ORACLE_SQL = None  # the classifier is fitted and components are closed by iteration, which SQL does not express


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "pipeline")
    return docs
