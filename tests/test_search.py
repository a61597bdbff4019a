from __future__ import annotations

import numpy as np
import pytest

from reviewmill.functions import positive_score
from reviewmill.operators.context import answer_payload, context_blocks, with_documents
from reviewmill.operators import search
from reviewmill.operators.search import apply_cutoff, best_hits, hit_bound, plan_searches, retrieve

DIM = 12


def world(spark, n=900, n_q=40, seed=0, copies=300):
    """Vectors of which a third are copies of one another and share one restaurant."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, DIM)).astype(np.float32)
    x[:copies] = x[0]
    rest = ["hot" if i < copies else f"r{i % 5}" for i in range(n)]
    ids = [f"{i:05d}" for i in rng.permutation(n)]
    index = spark.createDataFrame(
        [(i, r, float(k % 5), f"text {k}", v.tolist()) for k, (i, r, v) in enumerate(zip(ids, rest, x))],
        "review_id string, restaurant_id string, rating float, review_text string, embedding array<float>",
    ).repartition(7)
    targets = [[], ["R1"], ["hot"], ["r1", "hot"], ["r2", "r3", "r2"], ["nowhere"], None]
    q = rng.normal(size=(n_q, DIM))
    q[0] = x[0]
    questions = spark.createDataFrame(
        [(k, v.tolist(), targets[k % len(targets)]) for k, v in enumerate(q)], "q_id bigint, embedding array<double>, targets array<string>"
    )
    return index, questions, x.astype(np.float64), ids, rest, q, targets


def expected(x, ids, rest, q, targets, mode="pre"):
    out = []
    for k, v in enumerate(q):
        wanted = targets[k % len(targets)] or []
        scores = np.round(x @ v, 9)
        ranked = sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i]))
        depth = max(2, 5 // len(wanted)) if len(wanted) > 1 else 5
        for no, target in enumerate(wanted or [None]):
            inside = [i for i in ranked if target is None or rest[i] == target.lower()]
            if mode == "pre":
                picked = inside[:depth]
            else:
                picked = [i for i in ranked[:depth] if target is None or rest[i] == target.lower()]
            fallback = False
            if not picked and target is not None:
                picked, fallback = sorted(inside, key=lambda i: ids[i])[:depth], True
            if len(wanted) <= 1 and not fallback and picked and scores[picked[0]] > 0:
                picked = [i for i in picked if scores[i] >= 0.7 * scores[picked[0]]]
            out += [(k, no, ids[i], None if fallback else scores[i], fallback) for i in picked]
    return sorted(out, key=str)


def got(hits):
    rows = hits.select("q_id", "target_no", "review_id", "score", "fallback").collect()
    return sorted((tuple(r) for r in rows), key=str)


@pytest.mark.parametrize("mode", ["pre", "post"])
def test_retrieval_against_brute_force(spark, mode):
    index, questions, *rest = world(spark)
    assert got(retrieve(index, questions, filter_mode=mode)) == expected(*rest, mode)


def test_slices_give_the_same_hits(spark):
    index, questions, *_ = world(spark)
    searches = plan_searches(questions)
    whole = sorted(map(tuple, best_hits(index, searches).collect()), key=str)
    cut = sorted(map(tuple, best_hits(index, searches, max_bytes=2000).collect()), key=str)
    assert whole == cut


def test_share_per_target(spark):
    df = spark.createDataFrame([(i, ["t"] * i, [0.0]) for i in range(8)], "q_id bigint, targets array<string>, embedding array<double>")
    ks = {r["q_id"]: r["k"] for r in plan_searches(df).collect()}
    assert ks == {0: 5, 1: 5, 2: 2, 3: 2, 4: 2, 5: 2, 6: 2, 7: 2}
    assert hit_bound(df) == 5 + 5 + 2 * (2 + 3 + 4 + 5 + 6 + 7)
    wide = {r["q_id"]: r["k"] for r in plan_searches(df, top_k=20).collect()}
    assert wide[3] == 6 and wide[7] == 2


def test_cutoff(spark):
    hits = spark.createDataFrame([(1, 1.0), (1, 0.7), (1, 0.69), (2, -1.0), (2, -5.0), (3, 0.0)], "q_id int, score double")
    assert sorted(map(tuple, apply_cutoff(hits).collect())) == [(1, 0.7), (1, 1.0), (2, -5.0), (2, -1.0), (3, 0.0)]


def test_transform_widens_the_cutoff(spark):
    index, questions, *_ = world(spark)
    assert retrieve(index, questions, transform=positive_score).count() >= retrieve(index, questions).count()


def test_ragged_vectors_are_refused(spark):
    index = spark.createDataFrame([("a", "r", [1.0]), ("b", "r", [1.0, 2.0])], "review_id string, restaurant_id string, embedding array<float>").coalesce(1)
    questions = spark.createDataFrame([(1, [1.0], [])], "q_id bigint, embedding array<double>, targets array<string>")
    with pytest.raises(Exception, match="differing lengths"):
        retrieve(index, questions).collect()


def test_no_questions(spark):
    index, questions, *_ = world(spark, n=20, copies=0)
    assert retrieve(index, questions.filter("false")).count() == 0


def test_context_and_fixed_answer(spark):
    index = spark.createDataFrame(
        [("a", "x", None, "one"), ("b", "y", 2.0, None)], "review_id string, restaurant_id string, rating float, review_text string"
    )
    hits = spark.createDataFrame([(1, 1, 1, "a", "x"), (1, 0, 1, "b", "y")], "q_id bigint, target_no int, rank int, review_id string, restaurant_id string")
    blocks = context_blocks(with_documents(hits, index, 2))
    assert blocks.first()["context"] == "- Restaurant: y | Rating: 2.0 | Review: \n- Restaurant: x | Rating: n/a | Review: one"
    questions = spark.createDataFrame([(1, "q one"), (2, "q two")], "q_id bigint, question string")
    payload = {r["q_id"]: r for r in answer_payload(questions, blocks, spark.createDataFrame([(1, "fine")], "q_id bigint, answer string")).collect()}
    assert payload[1]["answer"] == "fine" and payload[1]["prompt"].startswith("Use only these reviews.\n- Restaurant: y") and payload[1]["prompt"].endswith("Asked: q one\nReply:")
    assert payload[2]["answer"].startswith("I couldn't find") and payload[2]["sources"] == []
    assert set(payload[1]["sources"][0].asDict()) == {"review_id", "restaurant_id", "rating", "review_text"}


def test_many_blocks_are_one_job(spark, monkeypatch):
    """Parts and blocks of any number give the same hits, and the number of jobs does not follow them."""
    index, questions, *_ = world(spark)
    searches = plan_searches(questions)
    context, made = spark.sparkContext, []
    whole = sorted(map(tuple, best_hits(index, searches).collect()), key=str)
    for number, (rows, max_bytes) in enumerate([(16_384, 3000), (7, 3000), (7, 1)]):
        monkeypatch.setattr(search, "PART_ROWS", rows)
        context.setJobGroup(f"grid-{number}", "")
        assert sorted(map(tuple, best_hits(index, searches, max_bytes=max_bytes).collect()), key=str) == whole
        made.append(len(context.statusTracker().getJobIdsForGroup(f"grid-{number}")))
    context.setJobGroup("rest", "")
    assert max(made) <= min(made) + 2 and max(made) < 25


@pytest.mark.parametrize("max_bytes", [1, 5000, 64 << 20])
def test_questions_are_embedded_once(spark, max_bytes):
    from reviewmill.operators.embed import QUERY, embed

    calls = spark.sparkContext.accumulator(0)

    def load():
        def model(texts, mode):
            calls.add(len(texts))
            return [[float(len(t)), 1.0] for t in texts]
        return model

    index = spark.createDataFrame([(f"r{i}", f"p{i % 3}", [float(i), 1.0]) for i in range(20)], "review_id string, restaurant_id string, embedding array<float>")
    asked = spark.createDataFrame([(i, f"question {i}", ["p0"] if i % 2 else []) for i in range(30)], "q_id bigint, question string, targets array<string>")
    hits = retrieve(index, embed(asked, "question", QUERY, load), max_bytes=max_bytes).collect()
    assert {h["q_id"] for h in hits} == set(range(30)) and calls.value == 30
