"""Personal data: fixed patterns, and terms that reveal the entities these patterns find.

Entities are the values of the base spans. The corpus tells how much a term t gives away about an entity e: their pointwise
mutual information over documents, against the information content of e. Where PMI(e; t) reaches ``HINT`` of IC(e) the term
is generalised, where it reaches ``REVEAL`` it is removed. An entity is looked at when at least ``SUPPORT`` different texts
hold it and it carries a bit or more; a term when it meets the entity in as many documents. Counts cover the whole corpus, and all
of them are over different documents.

A term is a run of letters, marks and digits of any script and length, joined inside by apostrophes, hyphens or underscores, and
outside the base spans; the same pattern counts and places it. Text written without spaces has its runs between marks as terms.

Built-in functions only. Pairs of entity and term are counted with map-side sums, so an entity or term that a third of the
rows hold is a row per task; a broadcast happens only below ``MAX_BROADCAST_ROWS`` counted rows, with a join beyond it. Null
texts count as empty and have no spans. A document is a (doc_id, text) pair: repeats count once and each repeated row gets
the spans; null ids are matched like any other. Columns beside ``doc_id`` and ``text`` are only carried by ``sanitise``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.llm import spans
from reviewmill.llm.common import key_filter, let, maybe_in, whole_text, written

SUPPORT = 3
HINT = 0.9
REVEAL = 0.99
MAX_BROADCAST_ROWS = 100_000

# Fixed base kinds in their fixed order. A match starts where the last one ended or a run of its characters begins, which is
# where the plain pattern starts too; loops never give characters back, which the plain pattern has no use for.
_LOCAL = r"[A-Za-z0-9._%+-]"
EMAIL = rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone")
REVEALS, HINTS = "reveal", "hint"

_BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"
_TERM = r"[\p{L}\p{M}\p{N}]++(?:['’_-][\p{L}\p{M}\p{N}]++)*+"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def add(total: Column, i: Column) -> Column:
        digit = F.substring(digits, -i, F.lit(1)).cast("int")
        twice = digit * 2
        return total + F.when(i % 2 == 1, digit).when(twice > 9, twice - 9).otherwise(twice)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _card(s: Column) -> Column:
    digits = _digits(s["value"])
    return F.when(F.length(digits).between(16, 19), _luhn(digits)).otherwise(False)


def base_spans(text: Column) -> Column:
    """Array of (rank, kind, start, end, value), by kind as listed and then start."""
    found = (
        spans.find(text, EMAIL),
        F.filter(spans.find(text, IP), lambda s: s["value"].rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$")),
        F.filter(spans.find(text, CARD), _card),
        F.filter(spans.find(text, PHONE), lambda s: F.length(_digits(s["value"])).between(8, 15)),
    )
    return F.flatten(F.array(*(_named(one, kind, rank) for rank, (kind, one) in enumerate(zip(KINDS, found, strict=True)))))


def _named(found: Column, kind: str, rank: int) -> Column:
    return F.transform(found, lambda s: F.struct(
        F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value")))


def _open_text(text: Column) -> Column:
    """The text with blanks in the places of its base spans."""

    def blanked(found: Column) -> Column:
        return F.when(F.size(found) == 0, text).otherwise(spans.blanked(text, found))

    def by_start(found: Column) -> Column:
        return F.sort_array(F.transform(found, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))))

    return let(by_start(base_spans(text)), blanked)


def _terms(text: Column) -> Column:
    """Distinct terms of a text outside its base spans, lower-cased."""
    found = F.regexp_extract_all(_open_text(text), F.lit(_TERM), F.lit(0))
    return F.array_distinct(F.transform(found, lambda t: F.lower(t)))


def _entity(s: Column) -> Column:
    plain = F.when(s["kind"].isin("card", "phone"), _digits(s["value"])).otherwise(F.lower(s["value"]))
    return F.concat_ws(":", s["kind"], plain)


def _key(left: DataFrame, right: DataFrame) -> Column:
    return left["doc_id"].eqNullSafe(right["doc_id"]) & (left["digest"] == right["digest"])


def _with_copies(docs: DataFrame, repeated: DataFrame) -> DataFrame:
    """text and copies of every row: how often its document stands in the table. Only rows that may be repeated are shuffled."""
    texts = docs.select("doc_id", whole_text().alias("text"))
    if repeated.isEmpty():
        return texts.select("text", F.lit(1).cast("long").alias("copies"))
    marked = maybe_in(texts.withColumn("digest", F.xxhash64("text")), key_filter(repeated, "doc_id", "digest"), "doc_id", "digest")
    single = marked.where("not __maybe").select("text", F.lit(1).cast("long").alias("copies"))
    rest = marked.where("__maybe")
    met = rest.join(repeated, _key(rest, repeated), "left").select("text", F.coalesce("copies", F.lit(1).cast("long")).alias("copies"))
    return single.unionByName(met)


def disclosing_terms(docs: DataFrame, marked: DataFrame, support: int = SUPPORT) -> tuple[DataFrame, DataFrame] | None:
    """(entity, term, strength) with strength PMI / IC of at least ``HINT``, and the documents that hold such entities.

    ``marked`` has doc_id, digest and spans of every document. None where no entity has the support.
    """
    held = marked.select("doc_id", "digest", F.explode(F.array_distinct(F.transform("spans", _entity))).alias("entity")).distinct()
    entities = held.groupBy("entity").agg(F.count("*").alias("df_entity"), F.count_distinct("digest").alias("texts")).where(F.col("texts") >= support)
    copies = written(marked.groupBy("doc_id", "digest").agg(F.count("*").alias("copies")), "pii-documents")
    n = copies.count()
    entities = written(entities.where(F.log2(n / F.col("df_entity")) >= 1).drop("texts"), "pii-entities")
    if entities.isEmpty():
        return None
    holders = held.join(entities, "entity").groupBy("doc_id", "digest").agg(F.collect_list("entity").alias("entities"))
    # a document without a digit or an @ holds no base span, and stays out of the shuffle
    texts = docs.select("doc_id", whole_text().alias("text")).where(F.col("text").rlike("[@0-9]")).withColumn("digest", F.xxhash64("text"))
    holding = written(texts.join(holders, _key(texts, holders)).select(
        texts["doc_id"], texts["digest"], "text", "entities").dropDuplicates(["doc_id", "digest"]), "pii-holders")

    met = holding.select(F.explode(_terms(F.col("text"))).alias("term"), "entities").select(F.explode("entities").alias("entity"), "term")
    pairs = written(met.groupBy("entity", "term").agg(F.count("*").alias("both")).where(F.col("both") >= support), "pii-pairs")
    wanted = pairs.select("term").distinct()
    few = pairs.count() <= MAX_BROADCAST_ROWS
    everywhere = _with_copies(docs, copies.where("copies > 1")).select("copies", F.explode(_terms(F.col("text"))).alias("term"))
    if few:
        everywhere = everywhere.join(F.broadcast(wanted), "term", "left_semi")
    # of the documents that stand in the table c times, a term has c rows for each one
    frequency = everywhere.groupBy("term", "copies").agg(F.count("*").alias("rows")).groupBy("term").agg(
        F.sum(F.expr("rows div copies")).alias("df_term"))
    if few:
        frequency = F.broadcast(frequency)
    strength = F.log2(F.lit(float(n)) * F.col("both") / (F.col("df_entity") * F.col("df_term"))) / F.log2(n / F.col("df_entity"))
    scored = pairs.join(entities, "entity").join(frequency, "term").withColumn("strength", strength)
    return written(scored.where(F.col("strength") >= HINT).select("entity", "term", "strength"), "pii-terms"), holding


def term_spans(terms: DataFrame, holding: DataFrame) -> DataFrame:
    """doc_id, digest and the spans of disclosing terms, ordered by kind and start, for documents that have any."""
    met = holding.select("doc_id", "digest", F.explode(_terms(F.col("text"))).alias("term"), "entities").select(
        "doc_id", "digest", F.explode("entities").alias("entity"), "term")
    strongest = met.join(terms, ["entity", "term"]).groupBy("doc_id", "digest", "term").agg(F.max("strength").alias("strength"))
    strongest = written(strongest, "pii-met")
    some = strongest.select("doc_id", "digest").distinct()
    texts = holding.join(some, _key(holding, some), "left_semi").select("doc_id", "digest", _open_text(F.col("text")).alias("open"))
    placed = texts.select("doc_id", "digest", F.explode(spans.find(F.col("open"), _TERM)).alias("s")).select(
        "doc_id", "digest", F.col("s.start").alias("start"), F.col("s.end").alias("end"), F.lower("s.value").alias("term"))
    found = placed.join(strongest, _key(placed, strongest) & (placed["term"] == strongest["term"])).select(
        placed["doc_id"], placed["digest"], F.struct(
            F.when(F.col("strength") >= REVEAL, len(KINDS)).otherwise(len(KINDS) + 1).alias("rank"),
            F.when(F.col("strength") >= REVEAL, REVEALS).otherwise(HINTS).alias("kind"), "start", "end").alias("s"))
    return found.groupBy("doc_id", "digest").agg(F.collect_list("s").alias("terms"))


def personal_data(docs: DataFrame, support: int = SUPPORT) -> DataFrame:
    """doc_id, digest (hash of the text), base spans and all spans of every row."""
    text = docs.select("doc_id", whole_text().alias("text"))
    marked = written(text.select("doc_id", F.xxhash64("text").alias("digest"), base_spans(F.col("text")).alias("spans")), "pii-base")
    base = F.transform("spans", lambda s: s.dropFields("value"))
    known = marked.select("doc_id", "digest", base.alias("base"))
    found = disclosing_terms(docs, marked, support)
    if found is None:
        return known.withColumn("spans", F.col("base"))
    terms = term_spans(*found)
    joined = known.join(terms, _key(known, terms), "left").select(known["doc_id"], known["digest"], "base", "terms")
    return joined.select("doc_id", "digest", "base", F.when(F.col("terms").isNull(), F.col("base")).otherwise(
        F.concat("base", F.sort_array("terms"))).alias("spans"))


def sanitise(docs: DataFrame, support: int = SUPPORT) -> DataFrame:
    """``docs`` with base spans and generalised terms replaced by their kind in brackets; removed terms leave ``[]``."""
    found = personal_data(docs, support).select("doc_id", "digest", "spans").where(F.size("spans") > 0).distinct()
    by_start = F.sort_array(F.transform("spans", lambda s: F.struct(
        s["start"].alias("start"), F.when(s["kind"] == REVEALS, "").otherwise(s["kind"]).alias("kind"), s["end"].alias("end"))))
    found = found.select(F.col("doc_id").alias("__id"), F.col("digest").alias("__digest"), by_start.alias("__spans"))
    joined = docs.withColumn("__own", F.xxhash64(whole_text())).join(
        found, docs["doc_id"].eqNullSafe(found["__id"]) & (F.col("__own") == found["__digest"]), "left")
    out = joined.withColumn("text", F.when(F.col("__spans").isNull(), F.col("text")).otherwise(spans.replaced(whole_text(), F.col("__spans"))))
    return out.select(*docs.columns)
