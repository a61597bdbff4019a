"""The statistics of the quality classifier against plain Python."""

from __future__ import annotations

import math
import random
import unicodedata

import pytest

from reviewmill.llm import rule_ensemble

STOP = {"the", "of", "und", "la", "no"}  # some of the stop words; the other words below are none


def expected(text):
    text = text or ""
    words = [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in text).split(" ") if w]
    lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    n, chars = len(words), sum(map(len, words))

    def share(a, b):
        return a / b if b else 0.0

    pairs = {(a, words[i + 1] if i + 1 < n else None) for i, a in enumerate(words)}
    kind = [unicodedata.category(c) for c in text]
    return {
        "log_words": math.log1p(n), "word_length": share(chars, n), "symbols": share(sum(c in "#*$%&|<>" for c in text), chars),
        "marks": share(sum(k[0] == "P" for k in kind), chars), "capitals": share(kind.count("Lu"), chars),
        "digits": share(sum("0" <= c <= "9" for c in text), chars), "distinct_words": share(len(set(words)), n), "distinct_pairs": share(len(pairs), n),
        "stop_words": share(sum(w.lower() in STOP for w in words), n), "one_letter": share(sum(len(w) == 1 for w in words), n),
        "repeated_lines": share(len(lines) - len(set(lines)), len(lines)), "line_words": share(n, len(lines)),
    }


def test_statistics_against_plain_python(spark):
    rng = random.Random(6)
    parts = ["the", "Of", "und", "x", "É", "zebra", "zebra", "12", "#$", "a-b.", "¿qué?", " ", "  ", "\n", "\n", "\t", "\x0b", "…", "😀", "_"]
    rows = [(k, rng.choice([" ", "\n"]).join(rng.choice(parts) for _ in range(rng.choice([0, 1, 5, 60])))) for k in range(120)]
    rows += [(900, None), (901, ""), (902, " \n\t"), (903, "same\nsame\n\nsame\r\n"), (904, "zebra " * 20_000)]
    got = {r.doc_id: r for r in rule_ensemble.statistics(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for doc_id, text in rows:
        assert {name: got[doc_id][name] for name in rule_ensemble.STATISTICS} == pytest.approx(expected(text)), repr(text)


def test_fitted_scores_follow_the_compiled_rules(spark, sf_dir):
    """Scores of the query equal the arithmetic over its own statistics and rules, and part good from bad where labels do."""
    docs, labels = (spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("documents", "labels"))
    rows = rule_ensemble.classify(docs, labels).collect()
    quality = {r.doc_id: r.quality for r in labels.collect()}
    held = [(r.score, quality[r.doc_id]) for r in rows if r.held_out and quality.get(r.doc_id) is not None]
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows) and held
    good, bad = ([s for s, q in held if q == k] for k in (1, 0))
    assert not good or not bad or sum(good) / len(good) > sum(bad) / len(bad)
