from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from reviewmill.operators.evaluate import latency_report, score_answers, summarize
from reviewmill.operators.targets import add_text_targets, payload_ids, resolve_targets, split_questions, unknown_targets

NAMES = [("village inn", "downtown"), ("luke", "midtown")]
TAGS = ["downtown", "midtown", "uptown"]


def questions(spark):
    rows = [
        (1, "How is Village Inn?", None, None), (2, "downtown or UPTOWN?", "midtown", None), (3, "fluke fish", None, None),
        (4, "any", None, ["Uptown", "nowhere"]), (5, "uptown", "", []), (6, "uptown", "midtown", ["downtown"]), (7, " \n", None, None),
        (8, None, None, None), (9, "uptown", None, ["a", "a"]),
    ]
    frame = spark.createDataFrame(rows, "q_id bigint, question string, one string, many array<string>")
    return frame.select("q_id", "question", payload_ids(F.col("one"), F.col("many")).alias("payload_ids"), "many")


@pytest.mark.parametrize("limit", [0, 128])
def test_targets(spark, limit):
    valid, rejected = split_questions(questions(spark))
    assert sorted(r["q_id"] for r in rejected.collect()) == [7, 8]
    names = spark.createDataFrame(NAMES, "name string, restaurant_id string")
    tags = spark.createDataFrame([(t,) for t in TAGS], "tag string")
    found = add_text_targets(valid, names, tags, literal_limit=limit)
    assert {r["q_id"]: r["text_targets"] for r in found.collect()} == {
        1: ["downtown"], 2: ["downtown", "uptown"], 3: ["midtown"], 4: [], 5: ["uptown"], 6: ["uptown"], 9: ["uptown"]
    }
    words = add_text_targets(valid, names, tags, "word", literal_limit=limit)
    assert words.filter("q_id = 3").first()["text_targets"] == []
    resolved = resolve_targets(found)
    assert {r["q_id"]: (r["origin"], r["targets"]) for r in resolved.collect()} == {
        1: ("text", ["downtown"]), 2: ("text", ["downtown", "uptown"]), 3: ("text", ["midtown"]), 4: ("payload", ["Uptown", "nowhere"]),
        5: ("text", ["uptown"]), 6: ("payload", ["midtown"]), 9: ("payload", ["a", "a"]),
    }
    known = tags.withColumnRenamed("tag", "restaurant_id")
    assert sorted(map(tuple, unknown_targets(resolved, known).collect())) == [(4, "nowhere"), (9, "a")]


def test_empty_list_may_clear_targets(spark):
    frame = spark.createDataFrame([(1, ["uptown"], [])], "q_id bigint, text_targets array<string>, payload_ids array<string>")
    assert resolve_targets(frame).first()["targets"] == ["uptown"]
    assert resolve_targets(frame, empty_is_absent=False).first()["targets"] == []


def test_scores(spark):
    cases = spark.createDataFrame([
        ("1", "ratings", ["Star"]), ("2", "Ratings", ["zzz"]), ("3", "trends", ["zzz"]), ("4", "trends", ["a"]), ("5", "ratings", []), ("6", None, ["x"]),
    ], "id string, category string, expected_keywords array<string>")
    answers = spark.createDataFrame([
        ("1", "five STARs"), ("2", "I am NOT authorized"), ("3", "not authorized"), ("4", ""), ("6", "xx"),
    ], "id string, answer string")
    scored = score_answers(cases, answers)
    got = {r["id"]: (r["matched_keywords"], r["refused"], r["passed"]) for r in scored.collect()}
    assert got == {
        "1": (["Star"], False, True), "2": (["GUARDRAIL_INTERCEPTED"], True, True), "3": ([], False, False), "4": ([], False, False),
        "5": ([], False, False), "6": (["x"], False, True),
    }
    assert summarize(scored).first().asDict() == {"tests": 6, "passed": 3, "pass_rate": 50.0}


def test_latency(spark):
    frame = spark.createDataFrame([(i / 100,) for i in range(1, 401)] + [(None,)], "latency double")
    row = latency_report(frame).first()
    assert row["answers"] == 400 and abs(row["p95"] - 3.8005) < 1e-9 and row["within_target"] == 0.75 and row["mean"] == 2.005
    assert latency_report(frame.filter("false")).count() == 0
