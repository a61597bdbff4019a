"""Quality rules: a threshold table compiled into one projection of built-in functions.

``measure`` counts what the rules look at, ``judge`` adds one failed-rule list and a verdict.
Both are row-local: no shuffle, no Python. Null texts count as empty, empty and blank texts have
no words and fail the length rule; repeated rows are judged each on its own; columns that the
input has besides ``doc_id`` and ``text`` are ignored by ``measure``, so their names cannot clash.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.llm.common import let, whole_text, words

SYMBOLS = r"[#*$%&|<>]"
STOP_WORDS = (
    "the", "of", "and", "to", "in", "that", "is", "with", "for", "was", "as", "on", "at", "by", "from", "be", "are", "this",
    "der", "die", "das", "und", "den", "von", "zu", "mit", "ein", "eine", "ist", "im", "dem", "für", "auf",
    "le", "la", "les", "de", "des", "un", "une", "et", "du", "que", "qui", "dans", "en", "pour", "par", "sur",
    "el", "los", "las", "del", "y", "una", "por", "con", "se", "no",
)


@dataclass(frozen=True)
class Rule:
    """``lowest <= value <= highest``; an open end is None."""

    name: str
    value: str
    lowest: float | None = None
    highest: float | None = None


# Ratios per word or per line; texts without words or lines have ratio zero.
THRESHOLDS = (
    Rule("length", "n_words", 50, None),
    Rule("word_length", "word_chars / n_words", 2, 16),
    Rule("symbols", "n_symbols / n_words", None, 0.25),
    Rule("stop_words", "n_stop_words / n_words", 0.02, None),
    Rule("repeated_lines", "n_dup_lines / n_lines", None, 0.5),
    Rule("bullet_lines", "n_bullet_lines / n_lines", None, 0.9),
    Rule("cut_lines", "n_cut_lines / n_lines", None, 0.3),
)


_PLACE = (1 << 24) - 1  # low bits of a packed window: where it starts; the bits above are its hash


def _covered(starts: Column) -> Column:
    """Words under windows of three that begin at the given places."""
    return F.aggregate(
        F.sort_array(starts),
        F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda acc, i: F.struct(i.alias("last"), (acc["n"] + F.least(F.lit(3), i - acc["last"])).alias("n")),
        lambda acc: acc["n"],
    )


def _places(pairs: Column) -> Column:
    return F.array_distinct(F.flatten(F.transform(pairs, lambda x: F.array(x["a"], x["b"]))))


def _packed_windows(hashed: Column) -> Column:
    """One sorted long per window of three: hash bits of its words, then its place."""
    wide = F.size(hashed)
    pairs = F.zip_with(hashed, F.slice(hashed, 2, F.greatest(wide - 1, F.lit(0))), lambda a, b: F.xxhash64(a, b))
    windows = F.zip_with(pairs, F.slice(hashed, 3, F.greatest(wide - 2, F.lit(0))), lambda a, b: F.xxhash64(a, b))
    packed = F.transform(
        F.slice(windows, 1, F.greatest(wide - 2, F.lit(0))),
        lambda h, i: h.bitwiseAND(F.lit(~_PLACE)).bitwiseOR(i.cast("long")),
    )
    return F.sort_array(packed)


def _same_neighbours(packed: Column, items: Column) -> Column:
    """Neighbours with equal hash bits: both places, and whether the words agree."""

    def pair(a: Column, b: Column) -> Column:
        i, j = a.bitwiseAND(F.lit(_PLACE)).cast("int"), b.bitwiseAND(F.lit(_PLACE)).cast("int")
        agree = F.lit(True)
        for k in range(3):
            agree = agree & (items[i + k] == items[j + k])
        return F.when(a.bitwiseXOR(b).between(0, _PLACE), F.struct(i.alias("a"), j.alias("b"), agree.alias("agree")))

    followers = F.slice(packed, 2, F.greatest(F.size(packed) - 1, F.lit(0)))
    return F.array_compact(F.zip_with(packed, followers, pair))


def _by_words(items: Column) -> Column:
    """The same by sorting the windows' words: slower, and right whatever their hashes."""
    windows = F.sort_array(F.transform(
        F.sequence(F.lit(0), F.size(items) - 3), lambda i: F.struct(items[i], items[i + 1], items[i + 2], i.alias("i")),
    ))
    names = ("col1", "col2", "col3")

    def pair(a: Column, b: Column) -> Column:
        agree = F.lit(True)
        for name in names:
            agree = agree & (a[name] == b[name])
        return F.when(agree, F.struct(a["i"].alias("a"), b["i"].alias("b")))

    return _covered(_places(let(windows, lambda x: F.array_compact(F.zip_with(x, F.slice(x, 2, F.greatest(F.size(x) - 1, F.lit(0))), pair)))))


def _repeat_words(items: Column, packed: Column) -> Column:
    """Words covered by windows of three that occur at least twice.

    Packed windows put equal ones side by side. Where two different windows share their hash bits, or a text
    has more places than the low bits hold, the words themselves are sorted.
    """
    return F.when(F.size(items) > _PLACE, _by_words(items)).otherwise(let(
        _same_neighbours(packed, items),
        lambda pairs: F.when(F.exists(pairs, lambda x: ~x["agree"]), _by_words(items)).otherwise(_covered(_places(pairs))),
    ))


def measure(docs: DataFrame) -> DataFrame:
    """doc_id and the counts, one row per input row."""
    read = docs.select("doc_id", whole_text().alias("text"))
    cut = read.select(
        "doc_id", "text", words(F.col("text")).alias("words"),
        F.filter(F.split("text", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
    )
    items, lines = F.col("words"), F.col("lines")
    hashed = cut.withColumn("hashed", F.transform(items, lambda w: F.xxhash64(w)))
    packed = hashed.withColumn("packed", _packed_windows(F.col("hashed")))
    return packed.select(
        "doc_id",
        F.size(items).cast("long").alias("n_words"),
        F.length(F.array_join(items, "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        _repeat_words(items, F.col("packed")).alias("n_repeat_words"),
        F.size(F.filter(items, lambda w: F.lower(w).isin(*STOP_WORDS))).cast("long").alias("n_stop_words"),
        F.size(lines).cast("long").alias("n_lines"),
        F.size(F.filter(lines, lambda x: x.rlike(r"^[\x20\t]*[-*•]"))).cast("long").alias("n_bullet_lines"),
        F.size(F.filter(lines, lambda x: x.rlike(r"(\.\.\.|…)[\x20\t\r]*$"))).cast("long").alias("n_cut_lines"),
    )


def _ratio(formula: str) -> Column:
    top, _, under = formula.partition(" / ")
    if not under:
        return F.col(top).cast("double")
    return F.when(F.col(under) > 0, F.col(top) / F.col(under)).otherwise(0.0)


def judge(measured: DataFrame, rules: tuple[Rule, ...] = THRESHOLDS) -> DataFrame:
    """Adds base_failed, kept and the names of failed rules, in the table's order."""
    failed = []
    for rule in rules:
        value = _ratio(rule.value)
        beyond = F.lit(False)
        if rule.lowest is not None:
            beyond = beyond | (value < rule.lowest)
        if rule.highest is not None:
            beyond = beyond | (value > rule.highest)
        failed.append(F.when(beyond, F.lit(rule.name)))
    base = (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    return measured.withColumns({
        "base_failed": base, "failed_rules": F.array_compact(F.array(*failed)),
    }).withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))


def quality_rules(docs: DataFrame, rules: tuple[Rule, ...] = THRESHOLDS) -> DataFrame:
    return judge(measure(docs), rules)
