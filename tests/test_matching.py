from __future__ import annotations

import random
import time

import pytest

from reviewmill.operators import automaton, matching, pieces
from reviewmill.operators.matching import match_substrings


def data(spark):
    rng = random.Random(8)
    texts = ["".join(rng.choice("ab c_1") for _ in range(rng.randrange(0, 30))) for _ in range(400)] + ["luke", "fluke", "a.b*c", "x(a.b)y", "\\Eq"]
    entries = sorted({"".join(rng.choice("ab c_1") for _ in range(rng.randrange(1, 6))) for _ in range(60)} | {"luke", "a.b", "\\E", ""})
    frame = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    return texts, entries, frame, spark.createDataFrame([(e,) for e in entries + entries[:5]], "entry string")


@pytest.mark.parametrize("path", ["literal", "automaton", "groups"])
def test_paths_agree_with_a_double_loop(spark, monkeypatch, path):
    texts, entries, frame, table = data(spark)
    if path == "groups":
        monkeypatch.setattr(matching, "GROUP_BYTES", 60)
    got = match_substrings(frame, table, "id", "text", "entry", literal_limit=10**4 if path == "literal" else 0)
    assert sorted(map(tuple, got.collect())) == sorted((i, e) for i, t in enumerate(texts) for e in entries if e and e in t)


@pytest.mark.parametrize("limit", [0, 1000])
def test_word_match(spark, limit):
    texts = spark.createDataFrame([(0, "ask luke now"), (1, "a fluke"), (2, "luke"), (3, "luke_2"), (4, "(luke)")], "id int, text string")
    names = spark.createDataFrame([("luke",)], "entry string")
    got = match_substrings(texts, names, "id", "text", "entry", word=True, literal_limit=limit)
    assert sorted(r["id"] for r in got.collect()) == [0, 2, 4]


def test_only_matches_leave_the_join(spark):
    """Names that share every short piece: rows joined are the true matches, in proportion to the texts."""
    made = []
    for n in (100, 400):
        names = spark.createDataFrame([(f"source_{i:05d}",) for i in range(n)], "entry string")
        texts = spark.createDataFrame([(i, f"raw/source_{i:05d}.csv") for i in range(n)], "id int, text string")
        found = match_substrings(texts, names, "id", "text", "entry", literal_limit=0)
        assert sorted(map(tuple, found.collect())) == [(i, f"source_{i:05d}") for i in range(n)]
        made.append(found.count())
    assert made == [100, 400]


def whole_word(text, entry):
    edge = lambda c: c == "_" or c.isalnum()
    at = text.find(entry)
    while at >= 0:
        if not (at and edge(text[at - 1])) and not (at + len(entry) < len(text) and edge(text[at + len(entry)])):
            return True
        at = text.find(entry, at + 1)
    return False


@pytest.mark.parametrize("piece", [1, 7, 1 << 22])
def test_automaton_equals_a_double_loop(monkeypatch, piece):
    monkeypatch.setattr(automaton, "SLICE_BYTES", piece)
    rng = random.Random(piece)
    for _ in range(60):
        letters = rng.choice(["ab", "ab_é 1", "日本é⭐ a"])
        entries = sorted({"".join(rng.choice(letters) for _ in range(rng.randint(1, 6))) for _ in range(rng.randint(1, 25))})
        texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 50))) for _ in range(rng.randint(0, 9))]
        built = automaton.Automaton([e.encode() for e in entries])
        for word in (False, True):
            number, entry = built.find([t.encode() for t in texts], word)
            held = whole_word if word else lambda t, e: e in t
            assert list(zip(number.tolist(), entry.tolist())) == [(i, j) for i, t in enumerate(texts) for j, e in enumerate(entries) if held(t, e)]


def test_time_follows_the_text():
    names = [f"name_{i:05d}" for i in range(5000)]
    built = automaton.Automaton([n.encode() for n in names])

    def seconds(n):
        text = ("some words and name_01234 " * n).encode()
        start = time.perf_counter()
        number, entry = built.find([text])
        assert entry.tolist() == [1234]
        return time.perf_counter() - start

    seconds(10_000)
    assert seconds(320_000) < 16 * seconds(40_000) + 0.5


def test_null_texts_and_odd_ids(spark):
    texts = spark.createDataFrame([("x", None), (None, "luke"), ("y", ""), ("y", "luke")], "id string, text string")
    names = spark.createDataFrame([("luke",)], "entry string")
    got = match_substrings(texts, names, "id", "text", "entry", literal_limit=0)
    assert {tuple(r) for r in got.collect()} == {("y", "luke"), (None, "luke")}


def test_a_large_dictionary_takes_one_pass_over_the_texts(spark, monkeypatch):
    monkeypatch.setattr(matching, "GROUP_BYTES", 60)
    monkeypatch.setattr(pieces, "SLICE", 40)
    names = ["Zürich", "ürich", "é", "日本", "本", "src_1", "src_10", "src_100", "a" * 33, "a" * 70] + [f"name{i}" for i in range(200)]
    texts = {1: "in Zürich é", 2: "日本 src_100 src_1", 3: "a" * 90, 4: "name17" + "x" * 100 + " name170 日本", 5: None, 6: "ürichname5é"}
    frame = spark.createDataFrame(list(texts.items()), "id int, text string")
    table = spark.createDataFrame([(n,) for n in names], "entry string")
    for word in (False, True):
        got = match_substrings(frame, table, "id", "text", "entry", word, literal_limit=0)
        assert got._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
        held = whole_word if word else lambda t, e: e in t
        assert sorted(map(tuple, got.collect())) == sorted((i, n) for i, t in texts.items() for n in names if t and held(t, n))
