"""Secret scan over a ledger of blobs.

Every version of every file is addressed by the SHA-256 of its content. A ledger table holds which blob was scanned under
which version of the rules and what was found. A run reads the addresses, drops those whose (blob, rules) pair the ledger
has, scans one copy of each of the rest, appends to the ledger, and joins findings back to every path that holds the blob.

The scan is built-in functions only. Null content counts as empty, which is a blob like any other, without findings.
Paths may repeat and may be null: each input row gets the findings of its content. Copies meet in the map-side part of the
aggregation, so a blob that a third of all paths share is still scanned once and moved once per task. Columns beside the
path and the content are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.llm import spans
from reviewmill.llm.common import key_filter, maybe_in, written

LEDGER = "blob string, rules string, findings array<struct<rank:int,kind:string,start:int,end:int>>"


@dataclass(frozen=True)
class SecretRule:
    """A pattern, and what a match must also be: ``group`` of it at least ``least`` characters long."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# The first three are the fixed base kinds; the rest are additions and come after them in every order.
BASE_RULES = (
    SecretRule("assign", r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]++)", 1, 12),
    SecretRule("access", r"AKIA[A-Z0-9]{14,}+"),
    SecretRule("hex", r"[0-9a-f]{16,}+"),
)
RULES = (*BASE_RULES, SecretRule("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"))
RULES_VERSION = "1"


def _long_enough(rule: SecretRule):
    return lambda s: F.length(F.regexp_extract(s["value"], rule.pattern, rule.group)) >= rule.least


def scan(content: Column, rules: tuple[SecretRule, ...] = RULES) -> Column:
    """Findings in one content, ordered by start, then kind as listed."""
    parts = []
    for rank, rule in enumerate(rules):
        found = spans.find(content, rule.pattern)
        if rule.group:
            found = F.filter(found, _long_enough(rule))
        parts.append(spans.named(found, rule.kind, rank))
    by_start = F.transform(F.flatten(F.array(*parts)), lambda s: F.struct(s["start"], s["rank"], s["kind"], s["end"]))
    return F.transform(F.sort_array(by_start), lambda s: F.struct(
        s["rank"].alias("rank"), s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))


def empty_ledger(spark: SparkSession, path: str) -> None:
    spark.createDataFrame([], LEDGER).write.mode("ignore").parquet(path)


def update_ledger(
    versions: DataFrame, path: str, content: str = "text", rules: tuple[SecretRule, ...] = RULES, version: str = RULES_VERSION,
) -> None:
    """Scan the blobs of ``versions`` that the ledger has not seen under this version of the rules, and append them."""
    spark = versions.sparkSession
    empty_ledger(spark, path)
    seen = spark.read.schema(LEDGER).parquet(path).where(F.col("rules") == version).select("blob")
    held = versions.select(F.coalesce(F.col(content), F.lit("")).alias("content")).withColumn("blob", F.sha2("content", 256))
    if not seen.isEmpty():
        # addresses alone are compared with the ledger; content moves only where its address may be new
        unseen = written(held.select("blob").distinct().join(seen, "blob", "left_anti"), "unseen-blobs")
        if unseen.isEmpty():
            return
        held = maybe_in(held, key_filter(unseen, "blob"), "blob").where("__maybe").drop("__maybe").join(unseen, "blob", "left_semi")
    blobs = held.groupBy("blob").agg(F.first("content").alias("content"))
    blobs.select("blob", F.lit(version).alias("rules"), scan(F.col("content"), rules).alias("findings")).write.mode("append").parquet(path)


def findings(
    versions: DataFrame, path: str, key: str = "doc_id", content: str = "text", version: str = RULES_VERSION,
) -> DataFrame:
    """key, blob and findings for every row of ``versions``; null findings where the ledger lacks the blob. A pair that two runs
    appended counts once."""
    ledger = versions.sparkSession.read.schema(LEDGER).parquet(path).where(F.col("rules") == version).dropDuplicates(["blob"]).select("blob", "findings")
    paths = versions.select(key, F.sha2(F.coalesce(F.col(content), F.lit("")), 256).alias("blob"))
    return paths.join(ledger, "blob", "left").select(key, "blob", "findings")


def redact(docs: DataFrame, path: str, version: str = RULES_VERSION) -> DataFrame:
    """``docs`` with every found secret replaced by its kind in brackets; n_chars, where there is one, follows the text."""
    ledger = docs.sparkSession.read.schema(LEDGER).parquet(path).where((F.col("rules") == version) & (F.size("findings") > 0)).dropDuplicates(["blob"])
    hits = ledger.select(F.col("blob").alias("__blob"), F.col("findings").alias("__findings"))
    marked = docs.withColumn("__blob", F.sha2(F.coalesce("text", F.lit("")), 256)).join(hits, "__blob", "left")

    out = marked.withColumn("text", F.when(F.col("__findings").isNull(), marked["text"]).otherwise(spans.replaced(marked["text"], F.col("__findings"))))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("__findings").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    return out.select(*docs.columns)
