"""Rule ensemble, packing, byte BPE, fixity audit, licences and the pipeline."""

from __future__ import annotations

import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from reviewmill.llm import bpe, license, merkle, packing, rule_ensemble

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
DOCS = "doc_id long, text string, ids string, decoded string, label string, bucket string, slot string"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "x", "x", "x", "x", "x") for i, t in rows], DOCS).repartition(3)


# --- quality classifier


def test_paths_of_a_printed_tree():
    text = "\n".join([
        "Model: numTrees=2", "  Tree 0 (weight 1.0):", "    If (feature 0 <= 0.5)", "     If (feature 1 <= 2.0)", "      Predict: 0.0",
        "     Else (feature 1 > 2.0)", "      Predict: 1.0", "    Else (feature 0 > 0.5)", "     If (feature 0 <= 0.7)", "      Predict: 1.0",
        "     Else (feature 0 > 0.7)", "      Predict: 0.0", "  Tree 1 (weight 1.0):", "    If (feature 0 <= 0.5)", "     Predict: 0.0",
        "    Else (feature 0 > 0.5)", "     Predict: 1.0"])
    inf = float("inf")
    assert {r.bounds for r in rule_ensemble.paths(text, ("a", "b"))} == {
        (("a", -inf, 0.5),), (("a", -inf, 0.5), ("b", -inf, 2.0)), (("a", -inf, 0.5), ("b", 2.0, inf)),
        (("a", 0.5, inf),), (("a", 0.5, 0.7),), (("a", 0.7, inf),)}


def test_compiled_rules_score_like_arithmetic(spark):
    rules = (rule_ensemble.Rule((("digits", 0.1, 0.5),)), rule_ensemble.Rule((("digits", -float("inf"), 0.2), ("marks", 0.3, float("inf")))))
    model = rule_ensemble.RuleModel(-0.5, ((rules[0], 1.25), (rules[1], -2.0)))
    rows = [(0.1, 0.3), (0.15, 0.4), (0.5, 0.9), (0.6, 0.0), (0.0, 0.31)]
    got = [r.s for r in spark.createDataFrame(rows, "digits double, marks double").coalesce(1).select(model.score().alias("s")).collect()]
    for (digits, marks), score in zip(rows, got, strict=True):
        margin = -0.5 + 1.25 * (0.1 < digits <= 0.5) - 2.0 * (digits <= 0.2 and marks > 0.3)
        assert score == pytest.approx(1 / (1 + np.exp(-margin)))


def test_held_out_accuracy_and_odd_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    odd = docs.limit(1).select(F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("text"), "lang", "source", "n_chars")
    scored = rule_ensemble.classify(docs.unionByName(odd).unionByName(odd), labels)
    rows = scored.collect()
    assert len(rows) == docs.count() + 2
    for row in rows:
        assert 0 <= row.score <= 1 and row.predicted == (row.score >= 0.5)
        assert row.held_out == (row.doc_id is not None and zlib.crc32(str(row.doc_id).encode()) % 3 == 1)
    met = scored.where("held_out").join(labels, "doc_id").agg(F.avg((F.col("predicted") == F.col("quality")).cast("int")), F.count("*")).first()
    assert met[1] > 50 and met[0] >= 0.9


def test_labels_beyond_the_bound_missing_or_single(spark):
    docs = docs_of(spark, [(i, f"word {i}") for i in range(60)])
    one = spark.createDataFrame([(i, 1) for i in range(30)] + [(3, None)], "doc_id long, quality int")
    assert {r.predicted for r in rule_ensemble.classify(docs, one).collect()} == {1}
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in rule_ensemble.classify(docs, none).collect()} == {0.5}
    assert rule_ensemble.classify(docs_of(spark, []), one).count() == 0
    measured = rule_ensemble.statistics(docs)
    n = rule_ensemble.training_rows(measured, spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int"), most=20).count()
    assert 0 < n < 40


# --- packing


def test_bounds_have_the_least_padding():
    rng = random.Random(2)
    for _ in range(30):
        n, k = rng.randint(1, 9), rng.randint(1, 5)
        longest = np.array(sorted(rng.sample(range(1, 60), n)))
        rows = np.array([rng.randint(1, 9) for _ in range(n)])
        ends = packing.best_bounds(rows, longest, k)

        def padding(cuts):
            start, total = 0, 0
            for end in cuts:
                total += sum(rows[i] * (longest[end] - longest[i]) for i in range(start, end + 1))
                start = end + 1
            return total

        assert ends[-1] == n - 1 and len(ends) <= k and ends == sorted(set(ends))
        assert padding(ends) == min(padding([*cut, n - 1]) for m in range(min(k, n)) for cut in combinations(range(n - 1), m))


def test_many_lengths_take_one_walk():
    rng = np.random.default_rng(1)
    longest = np.unique(rng.integers(0, 1 << 20, 60_000))
    begun = time.perf_counter()
    ends = packing.best_bounds(rng.integers(1, 1000, len(longest)), longest, 16)
    assert len(ends) == 16 and ends[-1] == len(longest) - 1 and time.perf_counter() - begun < 30


def test_equal_rows_spread_over_slots(spark, monkeypatch):
    monkeypatch.setattr(packing, "SLOT", 50)
    monkeypatch.setattr(packing, "COPIES", 64)
    rows = [(None, None)] * 3000 + [(1, "a b")] * 5 + [(2, "a")]
    counted = spark.createDataFrame([(None, 0, 77, 3000), (1, 2, 5, 5)], "doc_id long, n_tokens long, row long, copies long")
    numbered = packing._numbered(counted).withColumn("slot", F.pmod("order", F.lit(60)))
    assert numbered.count() == 3005 and numbered.groupBy("slot").count().agg({"count": "max"}).first()[0] < 120
    got = packing.pack(docs_of(spark, rows), budget=10).collect()
    assert len(got) == len(rows) and len({(r.batch_id, r.batch_position) for r in got}) == len(rows)
    again = packing.pack(docs_of(spark, rows).repartition(7), budget=10).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, again), key=repr)


def test_batches(spark, monkeypatch):
    monkeypatch.setattr(packing, "SLOT", 7)
    rng = random.Random(4)
    rows = [(i, "w " * rng.choice([0, 1, 3, 10, 50, 51, 52, 400])) for i in range(300)] + [(None, None), (None, None), (7, "a"), (7, "a")]
    got = packing.pack(docs_of(spark, rows), buckets=4, budget=100).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in got) == sorted((i is None, i or 0) for i, _ in rows)
    batches = {}
    for r in got:
        assert r.n_tokens <= r.bucket_length
        batches.setdefault(r.batch_id, []).append(r)
    assert sorted(batches) == list(range(len(batches)))
    part = {}
    for own in batches.values():
        assert len({r.bucket for r in own}) == 1 and sorted(r.batch_position for r in own) == list(range(len(own)))
        capacity = max(1, 100 // max(1, own[0].bucket_length))
        assert len(own) <= capacity
        part.setdefault(own[0].bucket, []).append(len(own) < capacity)
    assert all(sum(short) <= 1 for short in part.values())
    assert packing.pack(docs_of(spark, [])).count() == 0


# --- byte BPE


@pytest.fixture(scope="module")
def reference_encoding():
    tokens = bpe.load_ranks(RANKS)
    return tokens, tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})


def odd_texts():
    rng = random.Random(5)
    alphabet = [" ", " ", "\n", "\t", "a", "b", "'s", "'", "1", "é", "日", " ", "\x1c", "\x85", "!!", "foo", "Foo ba", "\r\n", "  ", "😀", "​", "٣", "<|endoftext|>"]
    return [None, "", " ", "\n", "a" * 3000, "ab " * 500, *("".join(rng.choice(alphabet) for _ in range(rng.randint(0, 25))) for _ in range(3000))]


@pytest.mark.parametrize("block", [1 << 18, 40])
def test_encoder_matches_the_library(reference_encoding, monkeypatch, block):
    monkeypatch.setattr(bpe, "BLOCK_CHARS", block)
    monkeypatch.setattr(bpe, "BLOCK_PIECES", 7)
    monkeypatch.setattr(bpe, "MEMO_BYTES", 9_000)
    tokens, encoding = reference_encoding
    texts = odd_texts()
    for text, packed in zip(texts, bpe.Encoder(tokens, public_tokenizers.PATTERN).encode(texts), strict=True):
        assert np.frombuffer(packed, "<u4").tolist() == encoding.encode_ordinary(text or ""), repr(text)


def test_perfect_hash_is_minimal(reference_encoding):
    tokens, _ = reference_encoding
    assert sorted(bpe.PerfectHash(tokens).find(tokens).tolist()) == list(range(len(tokens)))
    assert bpe.PerfectHash([]).find([b"x"]).tolist() == [-1]


def test_round_trip_in_spark(spark, reference_encoding):
    _, encoding = reference_encoding
    rows = [*enumerate(odd_texts()[:400]), (None, "x y"), (1, "again"), (1, "again")]
    ids = bpe.encode(docs_of(spark, rows), RANKS, public_tokenizers.PATTERN)
    decoded = bpe.decode(ids, RANKS).collect()
    assert sorted(bytes(r.decoded) for r in decoded) == sorted((t or "").encode() for _, t in rows)
    assert all(r.ids == encoding.encode_ordinary(bytes(r.decoded).decode()) for r in decoded)
    assert bpe.decode(spark.createDataFrame([(1, None)], "doc_id long, ids array<int>"), RANKS).first().decoded == b""
    assert bpe.encode(docs_of(spark, []), RANKS, public_tokenizers.PATTERN).count() == 0


def test_bpe_query_digests(spark, sf_dir, reference_encoding):
    from reviewmill.llm.queries import op10_byte_bpe

    _, encoding = reference_encoding
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for row in op10_byte_bpe(spark, sf_dir).collect():
        ids = np.array(encoding.encode_ordinary(texts[row.doc_id]), "<u4")
        assert row.n_tokens == len(ids) and row.ids_sha256 == hashlib.sha256(ids.tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(texts[row.doc_id].encode()).hexdigest()


# --- fixity


PAGES = "page_id long, url string, html string, hash string, file string"


def pages_of(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], PAGES).repartition(3)


def test_audit_finds_what_differs(spark):
    rows = [(i * 37, f"http://h/{i}", f"<p>{i}</p>" * (i % 5)) for i in range(400)] + [(None, "http://n", "a"), (None, "http://n2", None), (74, "http://again", "x"), (74, "http://again", "x"), (5, None, None)]
    same = pages_of(spark, rows)
    assert merkle.audit(same, same.repartition(5)).count() == 0
    other = [r for r in rows if r[0] != 37 * 9]
    other[100] = (other[100][0], other[100][1], "changed")
    other.remove((74, "http://again", "x"))
    other[other.index((None, "http://n", "a"))] = (None, "http://n", "b")
    other.append((999_999, "http://new", "z"))
    got = {(r.page_id, r.status) for r in merkle.audit(same, pages_of(spark, other)).collect()}
    assert {(333, "missing"), (other[100][0], "damaged"), (74, "damaged"), (999_999, "extra")} <= got
    assert {g for g in got if g[0] is not None} == {(333, "missing"), (other[100][0], "damaged"), (74, "damaged"), (999_999, "extra")}
    assert any(page is None for page, _ in got)
    assert merkle.audit(pages_of(spark, []), pages_of(spark, [])).count() == 0
    assert {r.status for r in merkle.audit(pages_of(spark, []), pages_of(spark, rows[:3])).collect()} == {"extra"}


def test_changes_among_records_of_one_place_are_found(spark):
    """Copies that come and go in pairs, at a hot page_id, at negative ids, and without an id."""
    def rows_with(*texts):
        return [(7, "u", t) for t in texts] + [(-1, "u", "n"), (-1, "u", "n"), (None, "u", "k"), (None, "u", "k")] + [(i, "u", f"t{i}") for i in range(8, 40)]

    one = rows_with("a", "b", "b", "c", *(f"r{i}" for i in range(300)))
    for texts, lost, gained in [("addc", {"b"}, {"d"}), ("aaac", {"b"}, {"a"}), ("abbcc", set(), {"c"}), ("abc", {"b"}, set())]:
        other = rows_with(*texts, *(f"r{i}" for i in range(300)))
        got = merkle.audit(pages_of(spark, one), pages_of(spark, other)).collect()
        name = {r.hash: h for h in "abcd" for r in merkle.records(pages_of(spark, [(7, "u", h)])).collect()}
        assert {(r.page_id, r.status) for r in got} == {(7, "damaged")}
        assert {name[r.hash] for r in got if r.hash} == lost and {name[r.hash_other] for r in got if r.hash_other} == gained
    lone = [(7, "u", "a")] + one[304:]
    assert len(merkle.audit(pages_of(spark, one), pages_of(spark, lone)).collect()) == 302
    less = [r for r in one if r[0] != -1] + [(-1, "u", "n")]
    assert [(r.page_id, r.file, r.status) for r in merkle.audit(pages_of(spark, one), pages_of(spark, less)).collect()] == [(-1, -1, "damaged")]
    bare = [r for r in one if r[0] is not None] + [(None, "u", "k")]
    assert [(r.page_id, r.file) for r in merkle.audit(pages_of(spark, one), pages_of(spark, bare)).collect()] == [(None, merkle.UNNUMBERED)]
    assert merkle.audit(pages_of(spark, one), pages_of(spark, one[::-1])).count() == 0


def test_audit_leaf_hashes_and_offsets(spark):
    rows = [(i, "http://u", "é" * i) for i in range(20)]
    records = [f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: {u}\r\nWARC-Record-ID: <urn:page:{i}>\r\nContent-Length: {len(h.encode())}\r\n\r\n{h}\r\n\r\n".encode() for i, u, h in rows]
    got = {r.page_id: r for r in merkle.leaves(pages_of(spark, rows)).collect()}
    for i, record in enumerate(records):
        assert got[i].hash == hashlib.sha256(record).hexdigest() and got[i].n_bytes == len(record)
        assert got[i].offset == sum(map(len, records[:i]))


# --- licences


def test_own_and_inherited_licences(spark):
    mit, gpl = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."
    rows = [
        (1, "repo/LICENSE", mit), (2, "repo/a/b/x.txt", "no word of it"), (3, "repo/a/COPYING", f"text\n{gpl}\nmore"), (4, "repo/a/b/c/y.txt", None),
        (5, "repo/z.txt", ""), (6, "other/z.txt", "the driver's license was lost"), (7, None, mit), (8, None, "plain"), (9, "repo/a/own.py", "x\nLicensed under the Apache License, Version 2.0.\ny"),
        (9, "repo/a/own.py", "x\nLicensed under the Apache License, Version 2.0.\ny"), (None, "repo/q.txt", "plain"), (10, "LICENSE", "Licensed under CC BY-NC 4.0."), (11, "third/deep/f", "plain"),
    ]
    docs = spark.createDataFrame([(*r, "l", 1.0) for r in rows], "doc_id long, path string, text string, licence string, score double").repartition(3)
    got = license.scan(docs).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: (r.licence, r.origin, r.inherited_from) for r in got}
    assert by_id == {
        1: ("MIT", "own", None), 2: ("GPL-3.0", "inherited", "repo/a"), 3: ("GPL-3.0", "own", None), 4: ("GPL-3.0", "inherited", "repo/a"),
        5: ("MIT", "inherited", "repo"), 6: ("CC-BY-NC-4.0", "inherited", ""), 7: ("MIT", "own", None), 8: (None, "none", None),
        9: ("Apache-2.0", "own", None), None: ("MIT", "inherited", "repo"), 10: ("CC-BY-NC-4.0", "own", None), 11: ("CC-BY-NC-4.0", "inherited", "")}
    assert license.scan(docs.limit(0)).count() == 0


def test_packing_query_is_optimal_over_all_lengths(spark, sf_dir):
    from reviewmill.llm.queries import op3_packing

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = op3_packing(spark, sf_dir).collect()
    words = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t)) for i, t in texts.items()}
    assert {r.doc_id: r.n_tokens for r in got} == words and len(got) == len(words)

    cells = {}
    for n in words.values():
        cells.setdefault(n, []).append(n)
    order = sorted(cells)
    least = {0: [0] + [math.inf] * len(order)}
    for k in range(1, packing.BUCKETS + 1):
        least[k] = [0] + [math.inf] * len(order)
        for j in range(1, len(order) + 1):
            members, tokens = 0, 0
            for i in range(j - 1, -1, -1):
                members, tokens = members + len(cells[order[i]]), tokens + sum(cells[order[i]])
                cost = least[k - 1][i] + order[j - 1] * members - tokens
                least[k][j] = min(least[k][j], cost)
    assert sum(r.bucket_length - r.n_tokens for r in got) == min(least[k][len(order)] for k in range(1, packing.BUCKETS + 1))


# --- pipeline


def test_pipeline_stages(spark, sf_dir):
    """Every stage against plain Python on the rows that the stage before kept."""
    import corpus_pipeline as pipeline
    from reviewmill.llm import rule_ensemble as quality
    from reviewmill.session import fresh_path
    from tests.llm.test_dedup import brute_fingerprint, reachable, spaced
    from tests.llm.test_text_rules import secret_spans

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, held = docs.columns, {}

    def rows_after(k):
        path = fresh_path(spark, "stage")
        pipeline.STAGES[k][1](spark, docs, sf_dir).write.parquet(path)
        return spark.read.parquet(path)

    judged = {r.doc_id: r.predicted for r in quality.classify(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    docs = rows_after(0)
    held = {r.doc_id: r for r in docs.collect()}
    assert docs.columns == columns and set(held) == {i for i, p in judged.items() if p == 1} and len(held) < len(judged)
    assert sum(labels[i] for i in held if i in labels) >= 0.95 * sum(labels.values())

    first = {}
    for i in sorted(held):
        first.setdefault(spaced(held[i].text), i)
    docs = rows_after(1)
    assert docs.columns == columns and {r.doc_id for r in docs.collect()} == set(first.values())

    held = {r.doc_id: r for r in docs.collect()}
    marks = {i: brute_fingerprint(r.text) for i, r in held.items()}
    groups = reachable(sorted(marks), lambda a, b: (marks[a] ^ marks[b]).bit_count() <= 2)
    docs = rows_after(2)
    assert docs.columns == columns and {r.doc_id for r in docs.collect()} == set(groups.values())

    held = {r.doc_id: r for r in docs.collect()}
    docs = rows_after(3)
    clean = {r.doc_id: r for r in docs.collect()}
    assert docs.columns == columns and set(clean) == set(held)
    for i, row in held.items():
        text, at = "", 0
        for kind, start, end in secret_spans(row.text):
            if start >= at:
                text += row.text[at:start] + f"[{kind}]"
            at = max(at, end)
        text += row.text[at:]
        assert clean[i].text == text and clean[i].n_chars == (len(text) if text != row.text else row.n_chars)

    packed = rows_after(4).collect()
    assert {r.doc_id: r.n_tokens for r in packed} == {i: len(r.text.split()) for i, r in clean.items()} and len(packed) == len(clean)
    assert {r.doc_id for r in pipeline.run(spark, sf_dir).collect()} == set(clean)
