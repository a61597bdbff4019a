"""Collocations against plain Python, and fingerprints that collide."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from reviewmill.llm import collocations


def fold(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def counted(docs):
    f, totals = Counter(), Counter()
    for _, lang, text in docs:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", fold(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang or "und"] += len(words)
            for n in range(1, 5):
                for i in range(len(words) - n + 1):
                    f[lang or "und", tuple(words[i:i + n])] += 1
    return f, totals


def expected(docs, least, most=2000):
    f, totals = counted(docs)
    frequent = {key: a for key, a in f.items() if a >= least and len(key[1]) > 1}
    rows = {}
    for (lang, words), a in frequent.items():
        cuts = [(2_000_000 * a // (f[lang, words[:k]] + f[lang, words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        covered = any(
            lang == other and len(long) > len(words) and 100 * b >= 80 * a and any(long[i:i + len(words)] == words for i in range(len(long)))
            for (other, long), b in frequent.items())
        if not covered:
            phrase = " ".join(words)
            rows.setdefault(lang, []).append((-score, -a, phrase.encode(), phrase, f[lang, words[:k]], f[lang, words[k:]]))
    return sorted(
        (lang, rank, phrase, -a, left, right, totals[lang], -score)
        for lang, own in rows.items() for rank, (score, a, _, phrase, left, right) in enumerate(sorted(own)[:most], 1))


def corpus(seed, n=150):
    rng = random.Random(seed)
    words = ["New", "york", "CITY", "of", "the", "été", "straße", "日本", "a", "b", "x\x1fy", "q\xa0r"]
    fixed = ["new york city hall", "of the", "in spite of", "日本 日本 日本"]
    docs = []
    for k in range(n):
        parts = [rng.choice(words) if rng.random() < 0.6 else rng.choice(fixed) for _ in range(rng.randint(0, 30))]
        docs.append((k, rng.choice(["en", "de", None]), rng.choice([" ", "  ", "\t"]).join(parts).replace(" a ", rng.choice([" a, ", "\n", "\r", " a "]))))
    return docs + [(5, "en", docs[5][2]), (None, "en", docs[6][2]), (200, None, None), (201, "en", ""), (202, "en", " .;\t"), (203, "en", docs[7][2])]


def frame(spark, docs):
    rows = [(i, lang, text, 1, "x", 2) for i, lang, text in docs]
    return spark.createDataFrame(rows, "doc_id long, lang string, text string, n long, phrase string, rank int").repartition(3)


@pytest.mark.parametrize("most", [2000, 5])
def test_equals_brute_force(spark, most):
    docs = corpus(1)
    got = collocations.collocations(frame(spark, docs), 6, most)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score", "seen"]
    assert sorted(tuple(r)[:8] for r in got.collect()) == expected(docs, 6, most)


def test_pointers_lead_to_the_phrase(spark):
    docs = [(i, lang, text) for i, lang, text in corpus(2) if i is not None]
    held = {}
    for i, lang, text in docs:
        held.setdefault(i, set()).update(counted([(i, lang, text)])[0])
    rows = collocations.phrases(frame(spark, docs), 6).where("n > 0").collect()
    assert rows and all((r.lang, tuple(r.phrase.split(" "))) in held[r.seen] for r in rows)


def test_empty_tables(spark):
    assert collocations.collocations(frame(spark, []), 2).collect() == []
    assert collocations.collocations(frame(spark, [(1, "en", None), (2, None, "a")]), 2).collect() == []


def batch_of(docs):
    return pa.RecordBatch.from_arrays([
        pa.array([i for i, _, _ in docs], pa.int64()), pa.array([lang or "und" for _, lang, _ in docs]),
        pa.array([(text or "").encode() for _, _, text in docs], pa.binary())], ["doc_id", "lang", "text"])


class Every:
    value = np.full(1 << 13, 255, np.uint8)


def read_all(docs):
    found = Counter()
    for part in collocations._reading(Every)(iter([batch_of(docs)])):
        for r in part.to_pylist():
            found[r["lang"], r["n"], r["phrase"].decode()] += r["occurrences"]
    return +found


def wanted(docs):
    f, totals = counted(docs)
    return Counter({(lang, len(words), " ".join(words)): a for (lang, words), a in f.items()} | {(lang, 0, ""): n for lang, n in totals.items() if n})


@pytest.mark.parametrize("values", [1, 7])
def test_colliding_fingerprints_are_told_apart(monkeypatch, values):
    docs = corpus(3, 40)
    monkeypatch.setattr(collocations, "_mix", lambda x: x % np.uint64(values))
    assert read_all(docs) == wanted(docs)


@pytest.mark.parametrize("size", [1, 20, 100])
def test_long_texts_in_pieces(monkeypatch, size):
    monkeypatch.setattr(collocations, "BUFFER", size)
    monkeypatch.setattr(collocations, "WIDE", 9)
    docs = corpus(4, 30) + [(300, "en", "alpha  beta" + " " * 300 + "gamma\n" + "longlonglonglong " * 3 + "delta " + "." * 90 + "alpha beta")]
    assert read_all(docs) == wanted(docs)
    sums = Counter()
    for part in collocations._counting((1, 2, 3, 4), None)(iter([batch_of(docs)])):
        for key, count in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
            sums[key] += count
    assert sorted(sums.values()) == sorted(v for (_, n, _), v in wanted(docs).items() if n)


def test_sums_are_handed_on_when_many(monkeypatch):
    monkeypatch.setattr(collocations, "HELD", 50)
    docs = corpus(5, 200)
    parts = list(collocations._counting((1, 2), None)(iter([batch_of(docs[:100]), batch_of(docs[100:])])))
    f, _ = counted(docs)
    assert sum(sum(p.column(1).to_pylist()) for p in parts) == sum(v for (_, words), v in f.items() if len(words) <= 2)


def test_a_long_text_takes_linear_time():
    import time

    def seconds(text):
        start = time.perf_counter()
        for _ in collocations._counting((1, 2), None)(iter([batch_of([(1, "en", text)])])):
            pass
        return time.perf_counter() - start

    seconds("ab cd " * 300_000)
    once, four = seconds("ab cd " * 500_000), seconds("ab cd " * 2_000_000)
    assert four < 12 * once + 1
    assert seconds(" " * 5_000_000 + "x" * 5_000_000) < 20


def test_fingerprints_are_not_held_once_more_ahead_of_the_shuffle(spark, monkeypatch):
    plans = []

    def noted(df, name):
        if name == "phrase-fingerprints":
            plans.append(df._jdf.queryExecution().sparkPlan().toString() + df._jdf.queryExecution().executedPlan().toString())
        return df.localCheckpoint()

    monkeypatch.setattr(collocations, "written", noted)
    collocations.phrases(frame(spark, corpus(6)), 6)
    assert len(plans) == 2
    for plan in plans:
        # plans are listed from the result down to the scan
        lines = [line for line in plan.splitlines() if "Exchange" in line or "HashAggregate" in line or "MapInArrow" in line]
        below = [k for k, line in enumerate(lines) if "MapInArrow" in line]
        assert below and all("Exchange" in lines[k - 1] for k in below), plan


def test_sums_of_many_parts():
    rng = np.random.default_rng(1)
    sums, wanted = collocations._Sums(), Counter()
    for _ in range(5):
        some = rng.integers(0, 300, 1000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        wanted.update(some.tolist())
        sums.add(some)
    keys, counts = sums.summed()
    assert dict(zip(keys.tolist(), counts.tolist(), strict=True)) == wanted and sums.size == len(wanted)
