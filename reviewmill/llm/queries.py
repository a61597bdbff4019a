"""The queries of the training-data operators: production parameters, whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.llm import (
    blob_ledger, bpe, collocations, disclosure, exact_dedup, lexical, license, merkle, packing, quality_rules, rule_ensemble, simhash, spans,
    url_rules,
)
from reviewmill.llm.common import table
from reviewmill.session import fresh_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


@query
def op1_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_ensemble.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.quality_rules(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _of_kind(found: Column, kind: str) -> Column:
    return F.size(F.filter(found, lambda s: s["kind"] == kind)).cast("long")


@query
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@query
def op4_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = disclosure.personal_data(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", *(_of_kind(F.col("base"), kind).alias(f"n_{kind}") for kind in disclosure.KINDS),
        F.sha2(spans.joined(F.col("base")), 256).alias("base_sha256"), spans.joined(F.col("spans")).alias("spans"),
    )


@query
def op5_blob_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    ledger = fresh_path(spark, "blob-ledger")
    # two increments: the second holds the first, whose blobs are not scanned again
    blob_ledger.update_ledger(docs.where(F.crc32(F.col("doc_id").cast("string")) % 2 == 0), ledger)
    blob_ledger.update_ledger(docs, ledger)
    found = blob_ledger.findings(docs, ledger)
    base = F.filter("findings", lambda s: s["rank"] < len(blob_ledger.BASE_RULES))
    return found.select(
        "doc_id", *(_of_kind(F.col("findings"), rule.kind).alias(f"n_{rule.kind}") for rule in blob_ledger.BASE_RULES),
        F.sha2(spans.joined(base), 256).alias("base_sha256"), spans.joined(F.col("findings")).alias("spans"),
    )


@query
def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.withColumn("fingerprint", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")))


@query
def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    groups = exact_dedup.with_digest(docs, exact_dedup.exact_groups(docs))
    every = groups.withColumn("copy", F.explode(F.expr("sequence(1L, copies)")))
    return every.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def damaged_replica(pages: DataFrame) -> DataFrame:
    """A second copy of the pages in which every 50th is changed, cut or lost in turn."""
    turn = F.when(F.col("page_id") % 50 == 0, F.floor(F.col("page_id") / 50) % 3)
    html = F.when(turn == 0, F.concat(F.lit("~"), F.substring("html", 2, 1 << 30))).when(
        turn == 1, F.substring(F.col("html"), F.lit(1), F.length("html") - 1)).otherwise(F.col("html"))
    return pages.where(turn.isNull() | (turn != 2)).withColumn("html", html)


@query
def op8_merkle_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return merkle.audit(pages, damaged_replica(pages))


def repository_paths(docs: DataFrame) -> DataFrame:
    """Documents laid out as files: a repository per source, directories by ids; every 100th is a directory's licence file."""
    number = F.col("doc_id")
    upper, lower = F.floor(number / 10_000).cast("string"), F.floor(number / 100).cast("string")
    path = F.when(number % 10_000 == 0, F.concat_ws("/", "source", upper, F.lit("LICENSE"))).when(
        number % 100 == 0, F.concat_ws("/", "source", upper, lower, F.lit("LICENSE"))).otherwise(
        F.concat_ws("/", "source", upper, lower, F.concat(number.cast("string"), F.lit(".txt"))))
    return docs.select("doc_id", path.alias("path"), "text")


@query
def op9_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license.scan(repository_paths(table(spark, sf_dir, "documents")))
    return found.select("doc_id", "licence", "score", "origin", "inherited_from")


@query
def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


URL_RULES = [
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block"),
]


@query
def op11_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_rules.judge(table(spark, sf_dir, "pages"), rules)


@query
def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents")).drop("seen")
