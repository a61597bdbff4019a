from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import functions as F

from reviewmill.contracts import EMBEDDING_DIM, INDEX_SCHEMA
from reviewmill.operators.embed import QUERY, embed, hashing_vectors
from reviewmill.operators.index import (
    append_documents, changed_documents, chunks, ensure_index, failed_documents, failures, increment_counts, new_documents, refresh_index, retry_failures,
)

SCHEMA = "pos bigint, review_id string, restaurant_id string, rating string, review_date string, review_text string"


def rows(n, seed=0):
    rng = random.Random(seed)
    return [
        (i, rng.choice([None, "", f"r{rng.randrange(n // 3)}", f"r{rng.randrange(n // 3)}", f"r{rng.randrange(n // 3)}", "hot"]), rng.choice("ab"),
         rng.choice(["4", "nan", "", "4d", None]), rng.choice(["2024-01-02", "", "2024-02-31", None]), rng.choice([None, " ", f"text number {i}", f"words {i}"]))
        for i in range(n)
    ]


def simulate(data, known):
    """One row after another, as an indexer without sets would go."""
    index, counts = {}, {"indexed": 0, "skipped": 0, "blank": 0, "missing_id": 0}
    for pos, rid, rest, rating, date, text in data:
        if not rid:
            counts["missing_id"] += 1
        elif rid in known or rid in index:
            counts["skipped"] += 1
        elif not text or not text.strip():
            counts["blank"] += 1
        else:
            index[rid] = (rest, 4.0 if rating == "4" else None, "2024-01-02" if date == "2024-01-02" else None, text)
            counts["indexed"] += 1
    return index, counts


def test_increment_against_a_loop(spark):
    data = rows(1500)
    known = {f"r{i}" for i in range(0, 500, 4)}
    frame = spark.createDataFrame(data, SCHEMA).repartition(6)
    indexed = spark.createDataFrame([(k,) for k in known], "review_id string")
    index, counts = simulate(data, known)
    got = {r["review_id"]: (r["restaurant_id"], r["rating"], str(r["review_date"]) if r["review_date"] else None, r["review_text"]) for r in new_documents(frame, indexed).collect()}
    assert got == index
    row = increment_counts(frame, indexed).first().asDict()
    assert {k: row[k] for k in counts} == counts
    assert row["bad_rating"] == sum(1 for r in data if r[3] == "4d")


def test_counts_of_nothing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert set(increment_counts(empty, empty.select("review_id")).first()) == {0}


def test_append_twice_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "index")
    frame = spark.createDataFrame(rows(120), SCHEMA)
    append_documents(frame, path)
    first = {r["review_id"]: r["review_text"] for r in ensure_index(spark, path).collect()}
    append_documents(frame, path)
    append_documents(spark.createDataFrame(rows(150, seed=3), SCHEMA), path)
    after = ensure_index(spark, path)
    table = {r["review_id"]: r["review_text"] for r in after.collect()}
    assert after.count() == len(table) and first.items() <= table.items() and len(table) > len(first)
    assert after.schema.fieldNames() == INDEX_SCHEMA.fieldNames() and len(after.first()["embedding"]) == EMBEDDING_DIM


def test_refresh_re_embeds_changed_texts(spark, tmp_path):
    old, new = str(tmp_path / "v1"), str(tmp_path / "v2")
    append_documents(spark.createDataFrame([(0, "a", "x", "1", None, "one"), (1, "b", "x", "1", None, "two")], SCHEMA), old)
    edited = spark.createDataFrame([(0, "a", "x", "1", None, "one"), (1, "b", "x", "1", None, "new"), (2, "c", "x", "1", None, "three")], SCHEMA)
    assert sorted(r["review_id"] for r in changed_documents(edited, ensure_index(spark, old)).collect()) == ["b", "c"]
    refresh_index(edited, old, new)
    assert {r["review_id"]: r["review_text"] for r in ensure_index(spark, new).collect()} == {"a": "one", "b": "new", "c": "three"}


def test_hashing_vectors(spark):
    long = "alpha " * 500
    frame = spark.createDataFrame([(0, "Alpha beta, alpha"), (1, "alpha BETA alpha"), (2, ""), (3, long), (4, long + "beta")], "id int, t string")
    v = {r["id"]: np.array(r["embedding"]) for r in hashing_vectors(frame, "t", dim=64).collect()}
    q = {r["id"]: np.array(r["embedding"]) for r in hashing_vectors(frame, "t", QUERY, dim=64).collect()}
    assert np.array_equal(v[0], v[1]) and abs(np.linalg.norm(v[0]) - 1) < 1e-6 and not v[2].any()
    assert not np.array_equal(v[3], v[4]) and np.array_equal(v[4], q[4])  # the tail of a long text counts


def murmur3(data: bytes, seed: int = 42) -> int:
    """The published 32-bit hash, by the book."""
    def mix(k):
        k = k * 0xCC9E2D51 & 0xFFFFFFFF
        k = (k << 15 | k >> 17) & 0xFFFFFFFF
        return k * 0x1B873593 & 0xFFFFFFFF

    h, whole = seed, len(data) // 4 * 4
    for i in range(0, whole, 4):
        h ^= mix(int.from_bytes(data[i:i + 4], "little"))
        h = ((h << 13 | h >> 19) * 5 + 0xE6546B64) & 0xFFFFFFFF
    if data[whole:]:
        h ^= mix(int.from_bytes(data[whole:], "little"))
    h ^= len(data)
    h = (h ^ h >> 16) * 0x85EBCA6B & 0xFFFFFFFF
    h = (h ^ h >> 13) * 0xC2B2AE35 & 0xFFFFFFFF
    h ^= h >> 16
    return h - (1 << 32) if h >> 31 else h


def brute_vector(text, dim, limit):
    v = np.zeros(dim)
    for word in regex.findall(r"[\p{L}\p{N}]+", (text[:limit] if limit else text).lower()):
        v[murmur3(word.encode()) % dim] += 1
    norm = np.linalg.norm(v)
    return v / norm if norm else v


def test_catalogue_vectors_against_brute_force(spark, sf_dir):
    from reviewmill.plans.catalog import hash_embed, hash_retrieve, table
    texts = {r["doc_id"]: r["text"] for r in table(spark, sf_dir, "documents").collect()}
    got = {i: np.zeros(EMBEDDING_DIM) for i in texts}
    for r in hash_embed(spark, sf_dir).collect():
        got[r["doc_id"]][r["slot"]] = r["weight"]
    assert all(np.allclose(got[i], brute_vector(t, EMBEDDING_DIM, None), atol=1e-6) for i, t in texts.items())

    docs = {str(i): brute_vector(t, EMBEDDING_DIM, None).astype(np.float32).astype(np.float64) for i, t in texts.items()}
    hits = hash_retrieve(spark, sf_dir).collect()
    for r in table(spark, sf_dir, "benchmark").collect():
        q = brute_vector(r["text"], EMBEDDING_DIM, None).astype(np.float32).astype(np.float64)
        scores = {i: float(np.round(v @ q, 6)) for i, v in docs.items()}
        best = sorted(scores.values(), reverse=True)[:5]
        mine = sorted((h for h in hits if h["q_id"] == r["item_id"]), key=lambda h: h["rank"])
        assert np.allclose([h["score"] for h in mine], [s for s in best if s >= 0.7 * best[0] - 1e-6], atol=2e-6)
        assert np.allclose([scores[h["review_id"]] for h in mine], [h["score"] for h in mine], atol=2e-6)


def test_model_failures_stay_local(spark):
    def load():
        def model(texts, mode):
            if any("bad" in t for t in texts):
                raise RuntimeError("model failed")
            return [[float(len(t)), 1.0 if mode == QUERY else 0.0] for t in texts]
        return model

    frame = spark.createDataFrame([(0, "ok"), (1, "bad"), (2, "fine!" * 1000), (3, "x" * 2000 + "bad"), (4, "y" * 2010), (5, None)], "id int, t string").coalesce(1)
    got = {r["id"]: r["embedding"] for r in embed(frame, "t", load=load).collect()}
    # pieces of 2,000, 2,000 and 1,000 characters, weighted by length; a failing tail fails its text
    assert got == {0: [2.0, 0.0], 1: None, 2: [1800.0, 0.0], 3: None, 4: [np.float32((2000 * 2000 + 10 * 10) / 2010), 0.0], 5: [0.0, 0.0]}
    assert {r["id"]: r["embedding"] for r in embed(frame, "t", QUERY, load=load).collect()}[2] == [5000.0, 1.0]


def test_chunk_table_rebuilds_texts(spark):
    texts = {"a": "x" * 4999, "b": "", "c": None, "d": "é" * 2000}
    frame = spark.createDataFrame(list(texts.items()), "review_id string, review_text string")
    built = {}
    for r in chunks(frame).orderBy("review_id", "chunk_no").collect():
        assert len(r["chunk"]) <= 2000
        built[r["review_id"]] = built.get(r["review_id"], "") + r["chunk"]
    assert built == {k: v for k, v in texts.items() if v}


def picky():
    def model(texts, mode):
        if any("bad" in t for t in texts):
            raise RuntimeError("model failed")
        return [[float(len(t)), 1.0] for t in texts]
    return model


def test_refresh_keeps_the_old_row_on_failure(spark, tmp_path):
    old, new = str(tmp_path / "v1"), str(tmp_path / "v2")
    append_documents(spark.createDataFrame([(0, "a", "x", "1", None, "one"), (1, "b", "x", "1", None, "two")], SCHEMA), old)
    edited = spark.createDataFrame([(0, "a", "x", "1", None, "bad one"), (1, "b", "x", "1", None, "new"), (2, "c", "x", "1", None, "bad c")], SCHEMA)
    refresh_index(edited, old, new, load=picky)
    assert {r["review_id"]: r["review_text"] for r in ensure_index(spark, new).collect()} == {"a": "one", "b": "new"}
    assert {r["review_id"]: r["review_text"] for r in failures(spark, new).collect()} == {"a": "bad one", "c": "bad c"}


def test_failed_documents_wait_in_their_table(spark, tmp_path):
    path = str(tmp_path / "index")
    append_documents(spark.createDataFrame([(0, "a", "x", "1", None, "fine"), (1, "b", "x", "1", None, "bad")], SCHEMA), path, load=picky)
    assert [r["review_id"] for r in ensure_index(spark, path).collect()] == ["a"]
    assert [r["review_id"] for r in failed_documents(spark, path).collect()] == ["b"]
    retry_failures(spark, path, load=picky)
    assert [r["review_id"] for r in failed_documents(spark, path).collect()] == ["b"]
    retry_failures(spark, path)
    assert sorted(r["review_id"] for r in ensure_index(spark, path).collect()) == ["a", "b"]
    assert failed_documents(spark, path).count() == 0


def test_model_sees_a_text_once_per_write(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def counting():
        def model(texts, mode):
            seen.add(len(texts))
            return [[1.0, 0.0] for _ in texts]
        return model

    append_documents(spark.createDataFrame([(i, f"r{i}", "x", "1", None, f"text {i}") for i in range(40)], SCHEMA), str(tmp_path / "index"), load=counting)
    assert seen.value == 40


def test_vectors_are_handed_on_before_a_batch_ends():
    from reviewmill.operators import embed

    seen = []

    def model(texts, mode):
        seen.extend(texts)
        if any(text == "t9" for text in texts):
            raise ValueError("unreadable")
        return [[float(len(text))] for text in texts]

    texts = [f"t{i}" for i in range(4 * embed.HANDED_ON)]
    parts = embed._embedded(iter([pa.array(texts), pa.array([], pa.string()), pa.array(["last"])]), model, embed.DOCUMENT, 2000, 64)
    first = next(parts)
    assert len(first) < embed.HANDED_ON + 64 and len(seen) < 2 * len(first)
    got = [vector for part in (first, *parts) for vector in part.to_pylist()]
    assert got == [None if text == "t9" else [float(len(text))] for text in [*texts, "last"]]


def test_a_task_embeds_a_bounded_number_of_rows(spark, tmp_path, monkeypatch):
    from reviewmill.operators import index

    monkeypatch.setattr(index, "ROWS_PER_TASK", 50)
    staged = []
    monkeypatch.setattr(index, "fresh_path", lambda spark, name: staged.append(name) or f"{tmp_path}/{name}{len(staged)}")
    rows = [(i, f"u{i}", "hot", 4.0, None, f"text {i}") for i in range(400)]
    frame = spark.createDataFrame(rows, "pos long, review_id string, restaurant_id string, rating double, review_date date, review_text string")
    index.append_documents(frame, f"{tmp_path}/index")
    held = spark.read.parquet(f"{tmp_path}/index")
    sizes = [r["n"] for r in held.groupBy(F.input_file_name()).agg(F.count("*").alias("n")).collect()]
    assert held.count() == 400 and held.select("review_id").distinct().count() == 400
    assert len(sizes) >= 6 and max(sizes) < 130
    assert staged == ["narrow"]  # the vectors are written once, to the index itself
