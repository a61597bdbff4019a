"""Ranked search against plain Python."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from reviewmill.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def cut(text):
    return ["".join(c.lower() if "A" <= c <= "Z" else c for c in term) for term in TERM.findall(text or "")]


def expected(docs, items, k=10):
    counted = [(i, Counter(cut(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    big_n, length = len(counted), sum(c.total() for _, c in counted)
    df = Counter(term for _, c in counted for term in c)
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(cut(text))
    rows = []
    for item, own in asked.items():
        scored = []
        for i, c in counted:
            m = 10 + 90 * c.total() * big_n // length
            score = sum(math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in own if t in c)
            if score > 0:
                scored.append((-score, i is None, i if i is not None else 0))
        rows += [(item, rank, None if empty else i, -score) for rank, (score, empty, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(rows, key=repr)


def found(spark, docs, items, **options):
    left = spark.createDataFrame([(i, t, "x", 1, "x") for i, t in docs], "doc_id long, text string, term string, item long, n string").repartition(4)
    right = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id long")
    got = lexical.search(left, right, **options)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, got.collect()), key=repr)


def corpus(seed, n=300):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(120)] + ["É", "été", "日本", "A1"]
    weights = [1 / (k + 1) for k in range(len(vocabulary))]
    docs = [(k, " ".join(rng.choices(vocabulary, weights, k=rng.randint(1, 60))) + rng.choice(["", ".", "-x"])) for k in range(n)]
    docs += [(1000 + k, docs[3][1]) for k in range(40)] + [(None, docs[3][1])] * 2 + [(7, docs[3][1]), (9, None), (10, ""), (11, " .,")]
    items = [(k, " ".join(rng.choices(vocabulary, k=rng.randint(1, 12)))) for k in range(30)]
    return docs, items + [(3, "w1 W1 w2"), (None, "w5 w6"), (50, None), (51, "unseen"), (52, docs[3][1])]


@pytest.mark.parametrize("postings", [1 << 20, 200])
def test_equals_brute_force(spark, monkeypatch, postings):
    docs, items = corpus(1)
    monkeypatch.setattr(lexical, "BLOCK_POSTINGS", postings)
    assert found(spark, docs, items) == expected(docs, items)


def test_blocks_of_items(spark):
    docs, items = corpus(2, 120)
    assert found(spark, docs, items, k=3, block_terms=60) == expected(docs, items, 3)


def test_empty_tables_and_texts(spark):
    assert found(spark, [], [(1, "a")]) == []
    assert found(spark, [(1, "a")], []) == []
    assert found(spark, [(1, None), (2, " ")], [(1, "a"), (2, None)]) == []


def test_long_text_is_counted_whole(spark, monkeypatch):
    monkeypatch.setattr(lexical, "_PIECE", 50)
    docs = [(1, "alpha beta " * 4_000 + "x" * 5_000 + " gamma"), (2, "alpha"), (3, "beta"), (4, "delta")]
    items = [(1, "alpha gamma"), (2, "x" * 5_000)]
    assert sum(map(len, lexical.terms(docs[0][1].encode()))) == 8_002
    assert found(spark, docs, items) == expected(docs, items)


def test_accumulators_stop_and_scores_stay_exact():
    """The limit must bite (few documents survive) and leave the exact best."""
    import pyarrow as pa

    rng = np.random.default_rng(3)
    n, weights = 5_000, np.array([9_000, 8_000, 40, 30, 20, 10])
    held = [sorted(({int(rng.integers(0, 2))} if k % 200 == 0 else set()) | set(rng.choice(range(2, 6), 3, replace=False).tolist())) for k in range(n)]
    offsets = np.cumsum([0, *map(len, held)])
    flat = [t for own in held for t in own]
    batch = pa.RecordBatch.from_arrays([
        pa.array(range(n)), pa.array([50] * n), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32())),
        pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array([1] * len(flat), pa.int64()))], ["doc_id", "n", "terms", "counts"])
    block = lexical.Block([batch], weights, n, 50 * n)
    docs, scores = block.search(np.arange(6), 10, 0)
    gain = 10**9 // (1000 + 8 * 100)
    exact = np.array([sum(int(weights[t]) * gain for t in own) for own in held])
    kth = np.sort(exact)[-10]
    assert dict(zip(docs.tolist(), scores.tolist(), strict=True)) == {int(k): int(exact[k]) for k in np.flatnonzero(exact >= kth)}
    assert (block.scores > 0).sum() <= 25
