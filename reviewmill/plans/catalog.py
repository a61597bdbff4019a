"""Every operator as a named query over the given tables."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.contracts import FACT_SCHEMA, MAX_CHARS
from reviewmill.functions.dates import is_iso_date, with_date
from reviewmill.functions.ids import base_id, is_base64url, is_near_dup
from reviewmill.functions.numbers import derived_total, needs_total
from reviewmill.functions.ratings import rating_outcome, symbol_set, with_rating
from reviewmill.functions.text import has_text, one_line, split_list
from reviewmill.operators import dedup, profile, quality
from reviewmill.operators.clusters import build_clusters, cluster_hits
from reviewmill.operators.context import answer_payload, context_blocks, with_documents
from reviewmill.operators.dimension import conform_dimension, name_dictionary, standardize_dimension
from reviewmill.operators.embed import QUERY, hashing_vectors
from reviewmill.operators.evaluate import latency_report, score_answers, summarize
from reviewmill.operators.headers import SourceConfig, header_maps, rating_divisors, united_headers
from reviewmill.operators.index import (
    append_documents, as_documents, chunks, clustered, ensure_index, failures, increment_counts, new_documents, refresh_index,
)
from reviewmill.operators.matching import match_substrings
from reviewmill.operators.reports import counted_with_sample
from reviewmill.operators.routing import route_keys
from reviewmill.operators.running import record_increment, running_counts, running_documents, running_summary, update_sums
from reviewmill.operators.search import (
    apply_cutoff, best_hits, hit_bound, plan_searches, retrieve,
)
from reviewmill.operators.targets import add_text_targets, payload_ids, resolve_targets, split_questions, unknown_targets
from reviewmill.operators.versions import read_version, upsert
from reviewmill.plans import views
from reviewmill.plans.answers import answer_questions
from reviewmill.plans.facts import standardize_facts
from reviewmill.plans.views import table, view
from reviewmill.session import fresh_path
from reviewmill.sources.files import export_csv, load_config, read_cases, read_facts, read_mapping_config, save_results, write_silver
from reviewmill.streaming.ingest import index_stream, ingest_dimension, ingest_lake, ledger, quarantine_unknown

Query = Callable[[SparkSession, str], DataFrame]
DIVISOR = 2


def raw_reviews(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, views.REVIEWS_RAW)


def facts(spark: SparkSession, sf: str, compat: bool = False) -> DataFrame:
    return standardize_facts(raw_reviews(spark, sf), F.lit(DIVISOR), compat=compat)


def dimension(spark: SparkSession, sf: str) -> DataFrame:
    return conform_dimension(standardize_dimension(view(spark, sf, views.DIMENSION_RAW)))


def _joined(df: DataFrame, *columns: str) -> DataFrame:
    """Arrays as joined text, dates as ISO text: forms both engines compare alike."""
    types = dict(df.dtypes)
    for c in columns:
        value = F.date_format(c, "yyyy-MM-dd") if types[c] == "date" else F.array_join(c, "|")
        df = df.withColumn(c, value)
    return df


# ---- standardisation ----

def near_dup_drop(spark, sf):
    return dedup.drop_near_duplicates(raw_reviews(spark, sf)).select(
        "source", "review_id", "pos", F.col("_near_dup_count").alias("near_dup_count")
    )


def near_dup_orphans(spark, sf):
    return dedup.orphan_near_dups(raw_reviews(spark, sf))


def collapse_duplicates(spark, sf):
    return dedup.collapse_duplicates(raw_reviews(spark, sf))


def keep_first(spark, sf):
    return dedup.keep_first(
        raw_reviews(spark, sf).select("source", "review_id", "pos", "customer_id", "rating"), ("source", "review_id")
    )


def date_normalize(spark, sf):
    raw = raw_reviews(spark, sf).select("pos", F.col("review_date").alias("raw_date"), "review_date")
    return _joined(with_date(raw), "review_date")


def date_audit(spark, sf):
    raw = F.col("review_date")
    parsed = with_date(raw_reviews(spark, sf).withColumn("parsed", raw), "parsed")
    return parsed.groupBy("source").agg(
        F.count_if(raw.isNotNull() & F.col("parsed").isNull()).alias("unparseable"),
        F.count_if(raw.isNull()).alias("missing"),
        F.count_if(is_iso_date(raw)).alias("iso"),
    )


def rating_normalize(spark, sf):
    raw = raw_reviews(spark, sf).select("pos", F.col("rating").alias("raw_rating"), "rating")
    return with_rating(raw, F.lit(DIVISOR))


def rating_outcomes(spark, sf):
    return raw_reviews(spark, sf).groupBy("source", rating_outcome(F.col("rating")).alias("outcome")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )


def rating_symbols(spark, sf):
    """The symbols in which ratings are written, by source."""
    rated = raw_reviews(spark, sf).filter(rating_outcome(F.col("rating")) == "symbol")
    return symbol_set(rated, F.col("rating"), "source")


def derive_total(spark, sf):
    args = (F.col("total_spent"), F.col("tip_amount"), F.col("tip_percentage"))
    return raw_reviews(spark, sf).filter(needs_total(*args)).select(
        "pos", "tip_amount", "tip_percentage", derived_total(*args).alias("total_spent")
    )


def fact_standardize(spark, sf):
    return _joined(facts(spark, sf), "review_date")


def fact_standardize_compat(spark, sf):
    return _joined(facts(spark, sf, compat=True), "review_date")


def header_union(spark, sf):
    """Four sources under differing headers, renamed by their maps and united."""
    raw = raw_reviews(spark, sf)
    maps = {
        "north": {"review_number": "review_id", "guest_name": "customer_id", "visit_date": "review_date"},
        "south": {"id": "review_id", "name": "customer_id", "comments": "review_text"},
        "east": {"review_id": "review_id", "customer_name": "customer_id", "date": "review_date"},
        "west": {"review_id": "review_id", "customer_name": "customer_id", "feedback_comments": "review_text"},
    }
    # As the files would stand side by side: each source's cells under its own headers, absent cells null.
    spelled = {}
    for source, mapping in maps.items():
        back = {target: header for header, target in mapping.items()}
        for column in raw.columns:
            if column not in ("source", "pos") and (source, column) != ("south", "tip_percentage"):
                spelled.setdefault(back.get(column, column), {})[source] = column
    wide = raw.select("source", "pos", *[
        F.coalesce(*[F.when(F.col("source") == s, F.col(c)) for s, c in cells.items()]).alias(header) for header, cells in spelled.items()
    ])
    return united_headers(wide, maps).select("source", "pos", "review_id", "customer_id", "review_date", "review_text", "tip_percentage")


def source_routing(spark, sf):
    keys = view(spark, sf, views.KEYS)
    sources = table(spark, sf, "documents").select("source").distinct()
    return route_keys(keys, sources).select("doc_id", "file_key", "source", "kind", "target_key")


def source_routing_many(spark, sf):
    """As many sources as keys: past the literal dictionary, the piece join routes."""
    keys = view(spark, sf, views.MANY_KEYS)
    return route_keys(keys.select("doc_id", "key"), keys.select("source")).select("doc_id", "source", "kind")


def document_names(spark, sf):
    """In how many documents each of some hundred names stands as a word."""
    words = table(spark, sf, "benchmark").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{6,}"), F.lit(0))).alias("name"))
    docs = table(spark, sf, "documents").select("doc_id", F.lower("text").alias("text"))
    found = match_substrings(docs, words, "doc_id", "text", "name", word=True)
    return found.groupBy("name").agg(F.count(F.lit(1)).alias("documents"))


def config_headers(spark, sf):
    maps = header_maps(view(spark, sf, views.MAPPING_CONFIG))
    return maps.select("source", F.explode("headers").alias("input_column", "target_column"))


def config_divisors(spark, sf):
    return rating_divisors(view(spark, sf, views.MAPPING_CONFIG))


def dimension_standardize(spark, sf):
    return _joined(dimension(spark, sf), "categories")


def category_counts(spark, sf):
    """Restaurants per category of the nation dimension."""
    raw = view(spark, sf, views.NATION_DIMENSION)
    return raw.select(F.explode(split_list(F.col("categories"))).alias("category")).groupBy("category").agg(
        F.count(F.lit(1)).alias("restaurants")
    )


def dictionary(spark, sf):
    raw = standardize_dimension(view(spark, sf, views.NATION_DIMENSION))
    return name_dictionary(raw, "pos")


def id_encoding_audit(spark, sf):
    """Words of the documents as candidate ids, by lenient and strict rule; equal words are judged once."""
    words = table(spark, sf, "documents").select(F.explode(F.split("text", r"\s")).alias("id"))
    counted = words.groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    judged = counted.select("n", "id", is_base64url(F.col("id")).alias("lenient"), is_base64url(F.col("id"), "strict").alias("strict"))
    return judged.groupBy("lenient", "strict", (F.col("lenient") & (F.col("id") != "")).alias("lenient_non_empty")).agg(
        F.sum("n").alias("words")
    )


def id_encoding_samples(spark, sf):
    bad = raw_reviews(spark, sf).filter(~is_base64url(F.col("review_id"), "strict"))
    return _joined(counted_with_sample(bad, ("source",), "review_id", 10), "sample_ids")


# ---- data quality ----

def _rough_facts(spark, sf) -> DataFrame:
    """Raw rows under the processed contract without cleaning, so that checks find things."""
    raw = raw_reviews(spark, sf)
    numbered = raw.withColumns({
        "rating": F.col("rating").try_cast("double"), "transaction_count": (F.col("pos") % 3 + 1).cast("bigint"),
        "restaurant_id": F.when(F.col("pos") % 17 == 0, F.lit("elsewhere")).when(F.col("pos") % 19 != 0, F.col("source")),
    })
    return numbered.drop("tip_percentage")


def dq_row_checks(spark, sf):
    failures = quality.row_failures(_rough_facts(spark, sf))
    return _joined(counted_with_sample(failures, quality.KEYS, "review_id"), "sample_ids")


def _silver(spark, sf) -> DataFrame:
    """Processed facts as the written table that checks read, computed once per query."""
    path = fresh_path(spark, "facts")
    facts(spark, sf).write.parquet(path)
    return spark.read.schema(FACT_SCHEMA).parquet(path)


def _damaged(spark, sf) -> DataFrame:
    """Processed facts that lost the texts, totals and ratings of some restaurants."""
    return _silver(spark, sf).withColumns({
        "review_text": F.when(F.col("restaurant_id") != "north", F.col("review_text")),
        "total_spent": F.when(F.col("restaurant_id") != "south", F.col("total_spent")),
        "rating": F.when(F.col("restaurant_id") != "east", F.col("rating")),
    })


def dq_incremental(spark, sf):
    """The raw-to-processed checks from state kept over three increments, one of which arrives twice."""
    path = fresh_path(spark, "dq-state")
    raw, damaged = raw_reviews(spark, sf), _damaged(spark, sf)
    for part in (0, 1, 2, 1):
        mine = raw.filter(F.col("pos") % 3 == part)
        quality.add_to_state(mine, damaged.filter(F.crc32("review_id") % 3 == part), path, f"part{part}")
    failures = quality.flag_failures(quality.state_flags(spark, path))
    return _joined(counted_with_sample(failures, quality.KEYS, "review_id"), "sample_ids")


def _summed_files(spark, sf) -> str:
    """Partial sums of four files, the second of which arrives again without its collapsed rows."""
    path = fresh_path(spark, "sums")
    keyed = facts(spark, sf).withColumn("file_key", F.concat(F.lit("raw/f"), F.length("review_id") % 4))
    update_sums(keyed, path)
    update_sums(keyed.filter("file_key = 'raw/f1' AND transaction_count = 1"), path)
    return path


def summary_running(spark, sf):
    """The restaurant summary from partial sums per file."""
    return running_summary(spark, _summed_files(spark, sf), dimension(spark, sf))


def docs_running(spark, sf):
    return running_documents(spark, _summed_files(spark, sf))


def counts_running(spark, sf):
    """Index counters over two increments, the second of which meets what the first has indexed."""
    path = fresh_path(spark, "counts")
    docs, known = view(spark, sf, views.DOCS), view(spark, sf, views.INDEXED_IDS)
    early = docs.filter("pos < 100")
    record_increment(increment_counts(early, known), path, "early")
    grown = known.unionByName(new_documents(early, known).select("review_id"))
    record_increment(increment_counts(docs.filter("pos >= 100"), grown), path, "late")
    return running_counts(spark, path)


def dq_passthrough(spark, sf):
    """Raw-to-processed checks where processed lost the texts and totals of some restaurants."""
    failures = quality.id_failures(raw_reviews(spark, sf), _damaged(spark, sf))
    return _joined(counted_with_sample(failures, quality.KEYS, "review_id"), "sample_ids")


def dq_summary(spark, sf):
    result = quality.dq_results(raw_reviews(spark, sf), _silver(spark, sf), dimension(spark, sf))
    return _joined(result, "sample_ids")


def dq_cross_ids(spark, sf):
    return quality.restaurant_ids(facts(spark, sf), dimension(spark, sf))


def dq_reconcile(spark, sf):
    raw = raw_reviews(spark, sf)
    return quality.reconciliation(raw, facts(spark, sf), dedup.orphan_near_dups(raw), dedup.without_id(raw))


# ---- profiles ----

def profile_fanout(spark, sf):
    return profile.duplicate_fanout(raw_reviews(spark, sf), ("customer_id", "party_size", "total_spent", "review_text"))


def profile_tips(spark, sf):
    return profile.tips(raw_reviews(spark, sf))


def profile_domain_gaps(spark, sf):
    return profile.domain_gaps(raw_reviews(spark, sf), "party_size", 1, 12)


def profile_spend(spark, sf):
    return profile.spend_per_person(raw_reviews(spark, sf), 1.5)


def profile_overlap(spark, sf):
    return profile.customer_overlap(raw_reviews(spark, sf))


def profile_cents(spark, sf):
    return profile.cent_uniformity(raw_reviews(spark, sf))


def profile_text_length(spark, sf):
    return profile.text_lengths(view(spark, sf, views.DOCS), "review_text", MAX_CHARS)


def restaurant_summary(spark, sf):
    summary = profile.restaurant_summary(facts(spark, sf), dimension(spark, sf))
    return summary.select("restaurant_id", "restaurant_name", "avg_rating", "reviews", "rated", "submissions")


def docs_per_restaurant(spark, sf):
    return profile.docs_per_restaurant(view(spark, sf, views.INDEX))


# ---- retrieval ----

def _index(spark, sf) -> DataFrame:
    return view(spark, sf, views.INDEX)


def _centroids(spark, sf) -> DataFrame:
    """One question per label: the mean vector of the label's rows."""
    parts = table(spark, sf, "embeddings").select("label", F.posexplode("embedding").alias("i", "x"))
    means = parts.groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("m"))
    vectors = means.groupBy("label").agg(F.sort_array(F.collect_list(F.struct("i", "m"))).alias("p"))
    return vectors.select(F.col("label").cast("bigint").alias("q_id"), F.transform("p", lambda e: e["m"]).alias("embedding"))


def _open_questions(spark, sf) -> DataFrame:
    return _centroids(spark, sf).withColumn("targets", F.array().cast("array<string>"))


def _targeted_questions(spark, sf) -> DataFrame:
    """By q_id: none, one (another label's restaurant), two, three with a repeat, or an unknown one."""
    def near(step: int):
        return F.concat(F.lit("R"), ((F.col("q_id") + step) % 10).cast("string"))
    targets = (
        F.when(F.col("q_id") % 5 == 0, F.array().cast("array<string>"))
        .when(F.col("q_id") % 5 == 1, F.array(near(1)))
        .when(F.col("q_id") % 5 == 2, F.array(near(0), near(3)))
        .when(F.col("q_id") % 5 == 3, F.array(near(2), near(5), near(2)))
        .otherwise(F.array(F.lit("nowhere")))
    )
    return _centroids(spark, sf).withColumn("targets", targets)


def _scored(hits: DataFrame) -> DataFrame:
    return hits.withColumn("score", F.round("score", 6))


def knn_topk(spark, sf):
    hits = best_hits(_index(spark, sf), plan_searches(_open_questions(spark, sf)))
    return _scored(hits).select("q_id", "rank", "review_id", "restaurant_id", "score")


def knn_cutoff(spark, sf):
    hits = best_hits(_index(spark, sf), plan_searches(_open_questions(spark, sf), 20))
    return _scored(apply_cutoff(hits)).select("q_id", "rank", "review_id", "score")


def knn_filtered(spark, sf):
    one = _centroids(spark, sf).withColumn("targets", F.array(F.concat(F.lit("r"), ((F.col("q_id") + 1) % 10).cast("string"))))
    hits = best_hits(_index(spark, sf), plan_searches(one))
    return _scored(hits).select("q_id", "asked", "rank", "review_id", "score")


def knn_balanced(spark, sf):
    hits = retrieve(_index(spark, sf), _targeted_questions(spark, sf))
    return _scored(hits).select("q_id", "target_no", "rank", "review_id", "restaurant_id", "score", "fallback")


def knn_sliced(spark, sf):
    """The same under a bound of a few searches a pass, so that they are cut by target and by hash."""
    hits = retrieve(_index(spark, sf), _targeted_questions(spark, sf), max_bytes=4000)
    return _scored(hits).select("q_id", "target_no", "rank", "review_id", "restaurant_id", "score", "fallback")


def knn_clusters(spark, sf):
    """The open searches over a clustered index, reading only clusters that can hold a hit."""
    path = fresh_path(spark, "clusters")
    build_clusters(_index(spark, sf), path, 32)
    hits, _ = cluster_hits(spark, path, plan_searches(_open_questions(spark, sf)))
    return _scored(hits).select("q_id", "rank", "review_id", "restaurant_id", "score")


def knn_fallback(spark, sf):
    hits = retrieve(_index(spark, sf), _targeted_questions(spark, sf), filter_mode="post")
    return _scored(hits).select("q_id", "target_no", "rank", "review_id", "restaurant_id", "score", "fallback")


def _text_questions(spark, sf):
    raw = view(spark, sf, views.QUESTIONS_TEXT)
    several = F.when(F.col("payload_list") == "", F.array().cast("array<string>")).otherwise(F.split("payload_list", ","))
    return raw.select("q_id", "question", payload_ids(F.col("payload_id"), several).alias("payload_ids"))


def _found(spark, sf, match="substring") -> tuple[DataFrame, DataFrame]:
    """Valid questions with their text targets, and the known restaurants."""
    known = standardize_dimension(view(spark, sf, views.NATION_DIMENSION))
    tags = known.select(F.col("restaurant_id").alias("tag"))
    valid, _ = split_questions(_text_questions(spark, sf))
    return add_text_targets(valid, name_dictionary(known, "pos"), tags, match), known


def _targets_text(found: DataFrame) -> DataFrame:
    return _joined(found.filter(F.size("text_targets") > 0).select("q_id", "text_targets"), "text_targets")


def question_targets(spark, sf):
    return _targets_text(_found(spark, sf)[0])


def question_targets_word(spark, sf):
    return _targets_text(_found(spark, sf, "word")[0])


def question_resolution(spark, sf):
    found, _ = _found(spark, sf)
    return _joined(resolve_targets(found), "targets").select("q_id", "question", "origin", "targets")


def question_rejected(spark, sf):
    return split_questions(_text_questions(spark, sf))[1].select("q_id", "question", "error")


def question_unknown_targets(spark, sf):
    found, known = _found(spark, sf)
    return unknown_targets(resolve_targets(found), known)


def _document_index(spark, sf) -> DataFrame:
    """The vector index with the documents' texts."""
    texts = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("review_id"), F.col("text").alias("review_text"))
    return _index(spark, sf).join(texts, "review_id", "left")


def context_blocks_query(spark, sf):
    questions = _targeted_questions(spark, sf)
    hits = retrieve(_index(spark, sf), questions)
    evidence = with_documents(hits, _document_index(spark, sf), hit_bound(questions))
    return context_blocks(evidence).select("q_id", "n_sources", "context")


def evidence_files(spark, sf):
    """Evidence out of a stored index: texts are read from the files and restaurants of the hits."""
    path = fresh_path(spark, "index")
    clustered(_document_index(spark, sf)).write.parquet(path)
    index, questions = spark.read.parquet(path), _targeted_questions(spark, sf)
    evidence = with_documents(retrieve(index, questions, located=True), index, hit_bound(questions))
    return evidence.select("q_id", "target_no", "rank", "review_id", F.md5("review_text").alias("text_md5"))


def answer_payloads(spark, sf):
    questions = _targeted_questions(spark, sf).withColumn("question", F.concat(F.lit("Question "), F.col("q_id")))
    hits = retrieve(_index(spark, sf), questions)
    evidence = with_documents(hits, _document_index(spark, sf), hit_bound(questions))
    payload = answer_payload(questions, context_blocks(evidence))
    sources = F.array_join(F.transform("sources", lambda s: s["review_id"]), "|")
    return payload.select("q_id", "prompt", "answer", sources.alias("sources"))


def question_answers(spark, sf):
    """A question per nation, naming a document source, answered from the embedded documents."""
    docs = table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("review_id"), F.col("source").alias("restaurant_id"),
        F.lit(None).cast("float").alias("rating"), F.col("text").alias("review_text"),
    )
    sources = table(spark, sf, "documents").select("source").distinct()
    restaurants = sources.select(F.concat(F.lit("House of "), "source").alias("restaurant_name"), F.col("source").alias("restaurant_id"))
    key = F.col("n_nationkey")
    questions = table(spark, sf, "nation").select(
        key.cast("bigint").alias("q_id"), F.format_string("What about src%d and the waiting?", key).alias("question"),
        F.when(key % 5 == 0, F.lit("src0")).alias("restaurant_id"), F.lit(None).cast("array<string>").alias("restaurant_ids"),
    )
    index = hashing_vectors(docs, "review_text")
    tags = sources.select(F.col("source").alias("tag"))
    payload = answer_questions(questions, index, restaurants, tags)
    sources = F.array_join(F.transform("sources", lambda s: s["review_id"]), "|")
    return payload.select("q_id", F.md5("prompt").alias("prompt_md5"), "answer", sources.alias("sources"), "error")


# ---- index ----

def text_chunks(spark, sf):
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("review_id"), F.col("text").alias("review_text"))
    return chunks(docs)


def index_documents(spark, sf):
    docs = as_documents(view(spark, sf, views.DOCS))
    return _joined(docs.select("pos", "review_id", "restaurant_id", "rating", "review_date"), "review_date")


def index_increment(spark, sf):
    fresh = new_documents(view(spark, sf, views.DOCS), view(spark, sf, views.INDEXED_IDS))
    return _joined(fresh, "review_date")


def index_counts(spark, sf):
    return increment_counts(view(spark, sf, views.DOCS), view(spark, sf, views.INDEXED_IDS))


def _half_blind_model():
    """A model that fails on texts ending in a question mark."""
    def model(texts, mode):
        if any(text.endswith("?") for text in texts):
            raise ValueError("unreadable")
        return [[float(len(text)), 1.0] for text in texts]
    return model


def _edited(docs: DataFrame) -> DataFrame:
    ending = F.when(F.right("review_id", F.lit(1)) == "4", F.lit(" edited?")).otherwise(F.lit(" edited!"))
    changes = has_text(F.col("review_text")) & F.right("review_id", F.lit(1)).isin("1", "4", "7")
    return docs.withColumn("review_text", F.when(changes, F.concat("review_text", ending)).otherwise(F.col("review_text")))


def _refreshed(spark, sf) -> str:
    """An index refreshed with edited texts, some of which the model fails on."""
    docs, path = view(spark, sf, views.DOCS), fresh_path(spark, "index")
    append_documents(docs, f"{path}/old")
    refresh_index(_edited(docs), f"{path}/old", f"{path}/new", load=_half_blind_model)
    return f"{path}/new"


def index_refresh(spark, sf):
    """Changed texts are re-embedded; where the model fails, the old row stays."""
    return ensure_index(spark, _refreshed(spark, sf)).select("review_id", F.md5("review_text").alias("text_md5"))


def index_versions(spark, sf):
    """Two versions of an index with keyed updates, side by side: the first as it was, the second with the edited texts."""
    docs, path = view(spark, sf, views.DOCS), fresh_path(spark, "versions")
    first = upsert(docs, path, load=_half_blind_model)
    second = upsert(_edited(docs), path, load=_half_blind_model)
    both = [read_version(spark, path, v).select(F.lit(v).alias("version"), "review_id", F.md5("review_text").alias("text_md5")) for v in (first, second)]
    return both[0].unionByName(both[1])


def index_failures(spark, sf):
    """The documents a refresh could not embed."""
    lost = failures(spark, _refreshed(spark, sf))
    return lost.select("review_id", F.md5("review_text").alias("text_md5"))


def hash_embed(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    # a position that holds a weight, rather than every position of the vector
    held = F.filter(F.transform("embedding", lambda w, i: F.struct(i.alias("slot"), w.cast("double").alias("weight"))), lambda e: e["weight"] != 0)
    return hashing_vectors(docs, "text").select("doc_id", F.explode(held).alias("e")).select("doc_id", "e.slot", "e.weight")


def hash_retrieve(spark, sf):
    """A fixed set of questions in words against the embedded documents, end to end."""
    docs = table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("review_id"), F.col("source").alias("restaurant_id"), "text"
    )
    asked = table(spark, sf, "benchmark").select(F.col("item_id").alias("q_id"), F.col("text").alias("question"))
    questions = hashing_vectors(asked, "question", QUERY).withColumn("targets", F.array().cast("array<string>"))
    return _scored(retrieve(hashing_vectors(docs, "text"), questions)).select("q_id", "rank", "review_id", "restaurant_id", "score")


# ---- evaluation ----

def _cases(spark, sf) -> tuple[DataFrame, DataFrame]:
    rows = view(spark, sf, views.ANSWERS)
    words = F.array_distinct(F.split("query", " "))
    cases = rows.select("id", "category", "query", words.alias("expected_keywords"))
    return cases, rows.select("id", "answer")


def eval_keywords(spark, sf):
    scored = score_answers(*_cases(spark, sf))
    return _joined(scored, "matched_keywords").select(
        "id", "category", one_line(F.col("answer")).alias("answer"), "matched_keywords", "refused", "passed"
    )


def eval_summary(spark, sf):
    return summarize(score_answers(*_cases(spark, sf)), ("category",))


def eval_latency(spark, sf):
    return latency_report(view(spark, sf, views.ANSWERS))


# ---- streams ----

STREAM_SOURCES = ("north", "south", "east", "west")


ROWS_PER_FILE = 500_000


def _staged_lake(spark, sf, sources=STREAM_SOURCES, root=None) -> tuple[str, list[str]]:
    """The raw reviews as CSV files per source, all rows of an id in one file, in row order."""
    root = root or fresh_path(spark, "lake")
    raw = raw_reviews(spark, sf).filter(F.col("source").isin(*sources))
    columns = [c for c in raw.columns if c not in ("source", "pos")]
    slices = max(4, table(spark, sf, "events").count() // ROWS_PER_FILE)
    (
        raw.repartition(slices, "source", base_id(F.col("review_id"))).sortWithinPartitions("source", "pos")
        .select("source", *columns).write.mode("append").partitionBy("source")
        .csv(f"{root}/raw", header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    )
    return root, columns


def _ingested_lake(spark, sf) -> str:
    root, _ = _staged_lake(spark, sf)
    config = SourceConfig({s: {"rating": "rating"} for s in STREAM_SOURCES}, {s: DIVISOR for s in STREAM_SOURCES})
    ingest_lake(spark, root, config, f"{root}/checkpoints/raw").awaitTermination()
    return root


def stream_ingest(spark, sf):
    """Raw files through the ingest streams into silver; a file is a unit of deduplication."""
    silver = spark.read.parquet(f"{_ingested_lake(spark, sf)}/processed/facts").drop("file_key")
    return _joined(silver, "review_date")


def stream_index(spark, sf):
    """Silver on through the index stream."""
    root = _ingested_lake(spark, sf)
    index_stream(spark, root, f"{root}/index", f"{root}/checkpoints/index").awaitTermination()
    return _joined(ensure_index(spark, f"{root}/index").drop("embedding"), "review_date")


def _write_config(spark, root: str, divisor: int) -> None:
    rows = [(s, "rating", "rating", float(divisor)) for s in STREAM_SOURCES]
    spark.createDataFrame(rows, "source_dataset string, input_column string, target_column string, rating_divisor double").coalesce(1).write.mode(
        "overwrite").csv(f"{root}/config", header=True, sep=";")


def _reconfigured_lake(spark, sf) -> str:
    """Two sources arrive, the divisor changes, two more arrive: all in one running query."""
    root, _ = _staged_lake(spark, sf, STREAM_SOURCES[:2])
    _write_config(spark, root, DIVISOR)
    query = ingest_lake(spark, root, f"{root}/config", f"{root}/checkpoints/raw", every="1 second")
    try:
        query.processAllAvailable()
        _write_config(spark, root, 1)
        _staged_lake(spark, sf, STREAM_SOURCES[2:], root)
        query.processAllAvailable()
    finally:
        query.stop()
    return root


def stream_config(spark, sf):
    """Facts of a stream whose config changed between batches, each with the divisor of its batch's config version."""
    root = _reconfigured_lake(spark, sf)
    used = ledger(spark, root).join(
        spark.read.parquet(f"{root}/config_versions").groupBy("config_version").agg(F.first("rating_divisor").alias("divisor")), "config_version")
    silver = spark.read.parquet(f"{root}/processed/facts").join(used.select("file_key", "divisor"), "file_key")
    return silver.select("restaurant_id", "review_id", "rating", "divisor")


def stream_ledger(spark, sf):
    """What became of the files of that stream, by source."""
    files = ledger(spark, _reconfigured_lake(spark, sf))
    return files.groupBy("kind", "source", "status").agg(F.count_distinct("config_version").alias("versions"), (F.count("file_key") > 0).alias("held"))


def stream_quarantine(spark, sf):
    """Files that no configured source claims, by folder."""
    root, _ = _staged_lake(spark, sf)
    config = SourceConfig({s: {"rating": "rating"} for s in STREAM_SOURCES[:3]}, {})
    quarantine_unknown(spark, root, config, f"{root}/checkpoints/unknown").awaitTermination()
    files = spark.read.parquet(f"{root}/quarantine/files")
    return files.groupBy(F.regexp_extract("file_key", "source=([a-z]+)", 1).alias("folder")).agg((F.sum("n_bytes") > 0).alias("held"))


# ---- batch files ----

def _lake_with_config(spark, sf) -> str:
    """Facts, dimension and mapping config as files."""
    root, columns = _staged_lake(spark, sf)
    view(spark, sf, views.DIMENSION_RAW).coalesce(1).write.csv(f"{root}/raw/restaurant_info", header=True, escape='"')
    sources = raw_reviews(spark, sf).select("source").distinct()
    mapped = sources.select(F.col("source").alias("source_dataset"), F.explode(F.array(*[F.lit(c) for c in columns])).alias("input_column"))
    config = mapped.select(
        "source_dataset", "input_column", F.col("input_column").alias("target_column"),
        F.when(F.col("input_column") == "rating", F.lit(DIVISOR)).alias("rating_divisor"))
    config.coalesce(1).write.csv(f"{root}/config", header=True, sep=";")
    return root


def lake_ingest(spark, sf):
    """The batch file path: config, raw facts by key, silver, read back."""
    root = _lake_with_config(spark, sf)
    config = load_config(spark, f"{root}/config")
    raw, _, _, _ = read_facts(spark, root, config)
    write_silver(standardize_facts(raw, config.divisor_of(F.col("source"))), f"{root}/processed/facts")
    return _joined(spark.read.parquet(f"{root}/processed/facts").select(*FACT_SCHEMA.names), "review_date")


def lake_config(spark, sf):
    """The mapping config file, header by header."""
    root = _lake_with_config(spark, sf)
    return read_mapping_config(spark, f"{root}/config").select("source_dataset", "input_column", "target_column", "rating_divisor")


def csv_export(spark, sf):
    """The dimension as exported CSV, read back as text."""
    path = fresh_path(spark, "export")
    export_csv(dimension(spark, sf), path)
    return spark.read.csv(path, header=True, quote='"', escape='"').select("restaurant_id", "restaurant_name", "categories")


def _json_arrays(frames):
    """The lines of each task as one JSON array."""
    begun = False
    for frame in frames:
        if len(frame):
            frame["value"] = ["," + line for line in frame["value"]]
            if not begun:
                frame.loc[frame.index[0], "value"] = "[" + frame["value"].iloc[0][1:]
                begun = True
            yield frame
    if begun:
        yield pd.DataFrame({"value": ["]"]})


def cases_file(spark, sf):
    """Evaluation cases through a JSON array file."""
    path = fresh_path(spark, "cases")
    cases = _cases(spark, sf)[0].select(F.col("id").cast("string").alias("id"), "category", "query", "expected_keywords")
    cases.select(F.to_json(F.struct("*")).alias("value")).mapInPandas(_json_arrays, "value string").write.text(path)
    read = read_cases(spark, path)
    return read.select("id", "category", F.md5("query").alias("query_md5"), F.size("expected_keywords").cast("bigint").alias("keywords"))


def result_tables(spark, sf):
    """Two runs of the evaluation summary side by side; a run written again replaces itself alone."""
    path = fresh_path(spark, "results")
    summary = summarize(score_answers(*_cases(spark, sf)), ("category",))
    save_results(summary, path, "first")
    save_results(summary.filter("category <> 'ratings'"), path, "second")
    save_results(summary.filter("category = 'ratings'"), path, "second")
    return spark.read.parquet(path).select("run", "category", "tests", "passed", "pass_rate")


def dimension_stream(spark, sf):
    """A dimension file through its stream."""
    root = _lake_with_config(spark, sf)
    ingest_dimension(spark, root, f"{root}/checkpoints/dimension").awaitTermination()
    return _joined(spark.read.parquet(f"{root}/processed/reference"), "categories")


def near_dup_check(spark, sf):
    """Near-duplicates per source, in raw."""
    return raw_reviews(spark, sf).groupBy("source").agg(F.count_if(is_near_dup(F.col("review_id"))).alias("near_dups"))


QUERIES: dict[str, Query] = {
    f.__name__.removesuffix("_query"): f
    for f in (
        near_dup_drop, near_dup_orphans, near_dup_check, collapse_duplicates, keep_first, date_normalize, date_audit,
        rating_normalize, rating_outcomes, rating_symbols, derive_total, fact_standardize, fact_standardize_compat, header_union,
        source_routing, source_routing_many, document_names, config_headers, config_divisors, dimension_standardize, category_counts, dictionary,
        id_encoding_audit, id_encoding_samples, dq_row_checks, dq_passthrough, dq_incremental, dq_summary, dq_cross_ids, dq_reconcile,
        profile_fanout, profile_tips, profile_domain_gaps, profile_spend, profile_overlap, profile_cents,
        profile_text_length, restaurant_summary, summary_running, docs_running, counts_running, docs_per_restaurant, knn_topk, knn_clusters, knn_cutoff, knn_filtered, knn_balanced,
        knn_sliced, knn_fallback, question_targets, question_targets_word, question_resolution, question_rejected,
        question_unknown_targets, context_blocks_query, evidence_files, answer_payloads,
        question_answers, text_chunks, index_documents, index_increment,
        index_counts, hash_embed, hash_retrieve, eval_keywords, eval_summary, eval_latency, stream_ingest, stream_config, stream_ledger, stream_index,
        index_refresh, index_failures, index_versions, stream_quarantine, lake_ingest, lake_config, csv_export, cases_file, result_tables, dimension_stream,
    )
}
