"""Exact and near duplicates against brute force."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash

from reviewmill.llm import bktree, components, exact_dedup, simhash

DOCS = "doc_id long, text string, component_id string, fingerprint string, kept string, node string"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y", "z", "n") for i, t in rows], DOCS).repartition(4)


def spaced(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def reachable(items, linked):
    label = {x: x for x in items}
    changed = True
    while changed:
        changed = False
        for a in items:
            for b in items:
                if linked(a, b) and label[a] != label[b]:
                    low = min(label[a], label[b])
                    label[a] = label[b] = low
                    changed = True
    return label


def test_exact_groups(spark):
    long = "w " * 70_000
    rows = [(5, "a  b"), (2, "a\nb"), (9, "a b"), (1, None), (4, ""), (3, " "), (7, long), (8, long + "x"), (6, long), (12, "p" * 300 + "1"), (11, "p" * 300 + "2"), (None, "a\tb"), (None, "alone")]
    rows += [(20, "twice"), (20, "twice")]
    docs = docs_of(spark, rows)
    got = exact_dedup.with_digest(docs, exact_dedup.exact_groups(docs)).collect()
    groups = {}
    for i, t in rows:
        groups.setdefault(spaced(t), []).append(i)
    assert len(got) == len(set(rows))
    text_of = {hashlib.sha256(t.encode()).hexdigest(): t for t in groups}
    for row in got:
        members = groups[text_of[row.text_sha256]]
        known = [i for i in members if i is not None]
        assert row.doc_id in members and row.group_size == len(members)
        assert row.keep_id == (min(known) if known else None) and row.kept == (row.doc_id == row.keep_id)
    kept = exact_dedup.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(spaced(r.text) for r in kept.collect()) == sorted(groups)
    assert {r.doc_id for r in kept.collect()} == {2, 1, 3, 7, 8, 6, 12, 11, None, 20} - {7}
    assert exact_dedup.exact_groups(docs_of(spark, [])).count() == 0 and exact_dedup.keep_first(docs_of(spark, [])).count() == 0


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
def test_tree_search_is_exact(radius):
    rng = np.random.default_rng(radius)
    centers = rng.integers(0, 2**63, 12, dtype=np.uint64)
    flips = np.array([np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, rng.integers(0, 5), dtype=np.uint64), initial=np.uint64(0)) for _ in range(400)], np.uint64)
    trees = [np.unique(centers[rng.integers(0, 12, 200)] ^ flips[rng.integers(0, 400, 200)]) for _ in range(3)] + [centers[:1]]
    values, tree = np.concatenate(trees), np.repeat(np.arange(4), [len(t) for t in trees])
    forest = bktree.build(values, tree)
    got = {(int(q), int(n)) for query, node in bktree.search(forest, values, tree, radius) for q, n in zip(query, node, strict=True)}
    apart = np.bitwise_count(values[:, None] ^ values[None, :])
    want = {(int(a), int(b)) for a, b in np.argwhere((apart <= radius) & (tree[:, None] == tree[None, :]))}
    assert got == want


def brute_fingerprint(text, length=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i:i + length]) for i in range(len(words) - length + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints(monkeypatch):
    texts = [None, "", " \t", "One", "one two", "One  TWO three", "Ä b c d e", "q " * 50, " ".join(str(i % 97) for i in range(4000)), " lead and trail "]
    assert [simhash.fingerprint((t or "").encode()) for t in texts] == [brute_fingerprint(t) for t in texts]
    monkeypatch.setattr(simhash, "_TEXT_BLOCK", 16)
    monkeypatch.setattr(simhash, "_HASH_BLOCK", 5)
    assert [simhash.fingerprint((t or "").encode()) for t in texts] == [brute_fingerprint(t) for t in texts]


def test_near_duplicates(spark):
    rng = random.Random(1)
    base = [[rng.choice("abcdefghij") * rng.randint(1, 6) for _ in range(rng.choice([0, 2, 40, 120]))] for _ in range(40)]
    rows = []
    for words in base:
        for _ in range(rng.randint(1, 5)):
            copy = list(words)
            if copy and rng.random() < 0.7:
                copy[rng.randrange(len(copy))] = "new"
            rows.append((len(rows), " ".join(copy)))
    rows += [(len(rows), None), (len(rows) + 1, ""), (3, rows[3][1])]
    docs = docs_of(spark, rows)
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    marks = {i: brute_fingerprint(t) for i, t in rows}
    assert all(r.fingerprint & (2**64 - 1) == marks[r.doc_id] for r in got)
    want = reachable(sorted(marks), lambda a, b: (marks[a] ^ marks[b]).bit_count() <= 2)
    assert {r.doc_id: r.component_id for r in got} == want
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == set(want.values())
    assert simhash.near_duplicates(docs_of(spark, [])).count() == 0
    assert simhash.near_duplicates(docs_of(spark, [(None, "x"), (None, "x")])).count() == 2


@pytest.mark.parametrize(("shard", "room"), [(5, 1 << 20), (5, 0), (1 << 14, 0)])
@pytest.mark.parametrize("blocks", [3, 4, 5])
def test_links_connect_whatever_the_shards(spark, monkeypatch, shard, room, blocks):
    monkeypatch.setattr(simhash, "_block_count", lambda n, radius: blocks)
    rng = np.random.default_rng(7)
    centers = rng.integers(0, 2**20, 6, dtype=np.uint64)
    values = {int(c) ^ sum(1 << int(b) for b in set(rng.integers(0, 64, rng.integers(0, 5)))) for c in centers for _ in range(40)}
    signed = sorted(v - 2**64 if v >= 2**63 else v for v in values)
    links = simhash.links(spark.createDataFrame([(v,) for v in signed], "fingerprint long"), 2, shard, room)
    pairs = [(r.a, r.b) for r in links.collect()]
    near = lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count() <= 2
    label = {r.node: r.center for r in components.star_labels(links).collect()}
    assert {v: label.get(v, v) for v in signed} == reachable(signed, near)
    assert len(pairs) < 12 * len(signed) * (len(signed) // shard + 2)


def test_components_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + k) for k in range(1, 50)] + [(2000, 1049), (5, 5)]
    links = spark.createDataFrame(edges, "a long, b long")
    label = {r.node: r.center for r in components.star_labels(links).collect()}
    assert all(label[i] == 0 for i in range(1, 201)) and all(label[1000 + k] == 1000 for k in range(1, 50)) and label[2000] == 1000
    assert components.star_labels(spark.createDataFrame([], "a long, b long")).count() == 0
