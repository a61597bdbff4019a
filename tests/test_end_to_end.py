"""Files to scored answers, over the four usual sources."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from reviewmill.operators import dedup, quality
from reviewmill.operators.dimension import conform_dimension, standardize_dimension
from reviewmill.operators.evaluate import score_answers, summarize
from reviewmill.operators.index import append_documents, ensure_index
from reviewmill.plans.answers import answer_questions
from reviewmill.plans.facts import standardize_facts
from reviewmill.sources.files import load_config, read_cases, read_facts, save_results, write_silver

# Headers of the four sources and the rating scale of the last.
HEADERS = {
    "downtown": ("review_id", "customer_name", "date", "rating", "review_text", "location", "business_name"),
    "eastside": ("review_number", "guest_name", "visit_date", "satisfaction_score", "feedback_comments", "venue_location", "restaurant_name"),
    "uptown": ("id", "name", "review_date", "star_rating", "comments", "venue", "establishment"),
    "midtown": ("review_id", "customer_name", "date", "rating_out_of_10", "review_text", "location", "restaurant_name"),
}
TARGETS = ("review_id", "customer_id", "review_date", "rating", "review_text", "location", "restaurant_name")
COMMON = "total_spent,tip_amount,tip_percentage,party_size,age_range,gender,ethnicity"
RATING = {"downtown": "4", "eastside": "2", "uptown": "⭐️⭐️⭐️", "midtown": "8"}
EXPECTED = {"downtown": 4.0, "eastside": 2.0, "uptown": 3.0, "midtown": 4.0}
TOPICS = ["the burger bun and fries", "happy hour drinks and service", "long wait times and slow staff", "low star ratings for the food"]


@pytest.fixture(scope="module")
def lake(tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    (root / "raw").mkdir()
    lines = ["source_dataset;input_column;target_column;rating_divisor"]
    for source, headers in HEADERS.items():
        for column, target in zip(headers, TARGETS):
            lines.append(f"{source};{column};{target};{(2 if source == 'midtown' else 1) if target == 'rating' else ''}")
        rows = [",".join(headers) + "," + COMMON]
        for i in range(24):
            rid = f"{source[:2]}{i // 2 * 2 if i % 6 == 1 else i:02d}" + ("_copy" if source == "uptown" and i == 5 else "")
            text = f'"Guests at {source} mention {TOPICS[i % 4]}.\nVisit number {i}"' if i != 7 else ""
            rows.append(f"{rid},C_{i},2024-03-{i + 1:02d} 18:00:00,{RATING[source]},{text},{source},Some Name,{'' if i % 3 else 40},4,10,2,30,f,e")
        name = f"{source}_reviews.{'txt' if source == 'midtown' else 'csv'}"
        (root / "raw" / name).write_text("\n".join(rows) + "\n", encoding="utf-8")
    (root / "raw/restaurant_info.csv").write_text(
        "location,restaurant_name,original_city,address,categories,avg_stars,total_reviews\n" + "".join(
            f'{s.title()},House {s[0].upper()},City,1 Road,"Bars, Food",4.0,9\n' for s in HEADERS), encoding="utf-8")
    (root / "mapping.csv").write_text("\n".join(lines) + "\n")
    return root


def test_files_to_scored_answers(spark, lake, tmp_path):
    config = load_config(spark, str(lake / "mapping.csv"))
    raw, dimension, unknown, missing = read_facts(spark, str(lake), config)
    assert unknown.isEmpty() and not missing
    write_silver(standardize_facts(raw, config.divisor_of(F.col("source"))), str(tmp_path / "facts"))
    facts = spark.read.parquet(str(tmp_path / "facts"))
    facts = standardize_contract(facts)
    reference = conform_dimension(standardize_dimension(dimension))

    results = quality.dq_results(raw, facts, reference)
    assert [r["check_id"] for r in results.collect() if r["n_bad"]] == []
    balance = quality.reconciliation(raw, facts, dedup.orphan_near_dups(raw), dedup.without_id(raw)).collect()
    # The only near-duplicate has no base row; everything else reconciles.
    assert {r["dataset"]: r["difference"] for r in balance} == {"uptown": 1, "downtown": 0, "eastside": 0, "midtown": 0}
    assert {r["unexplained"] for r in balance} == {0}
    assert {r["restaurant_id"]: r["rating"] for r in facts.groupBy("restaurant_id").agg(F.avg("rating").alias("rating")).collect()} == EXPECTED

    append_documents(facts.withColumn("pos", F.monotonically_increasing_id()), str(tmp_path / "index"))
    index = ensure_index(spark, str(tmp_path / "index"))
    assert index.count() == facts.filter("review_text is not null").count()

    requests = [
        ("1", "ratings", "why do guests leave low star ratings at eastside?", None, None, ["eastside", "star"]),
        ("2", "comparisons", "how do wait times compare between UPTOWN and House D?", None, None, ["uptown", "downtown", "wait"]),
        ("3", "trends", "which topics keep coming up?", None, None, ["guests"]),
        ("4", "specific", "is the burger bun good?", "Downtown", None, ["burger"]),
        ("5", "ratings", "average?", None, ["midtown"], ["nothing like this"]),
        ("6", "other", "and at the harbour?", "harbour", None, ["x"]),
        ("7", "other", "  ", None, None, ["x"]),
    ]
    (tmp_path / "cases.json").write_text(json.dumps([{"id": r[0], "category": r[1], "query": r[2], "expected_keywords": r[5]} for r in requests]))
    cases = read_cases(spark, str(tmp_path / "cases.json"))
    questions = spark.createDataFrame(
        [(int(r[0]), r[2], r[3], r[4]) for r in requests], "q_id bigint, question string, restaurant_id string, restaurant_ids array<string>"
    )

    def parrot(prompts):
        refusal = F.contains("prompt", F.lit("Asked: average?"))
        return prompts.select("q_id", F.when(refusal, "Quantitative questions are not authorized.").otherwise(F.col("prompt")).alias("answer"))

    payload = answer_questions(questions, index, reference, spark.createDataFrame([(s,) for s in HEADERS], "tag string"), answers=parrot)
    got = {r["q_id"]: r for r in payload.collect()}
    assert len(got) == 7 and got[7]["error"] and all(got[i]["error"] is None for i in range(1, 7))

    def places(i):
        return [s["restaurant_id"] for s in got[i]["sources"]]

    assert set(places(1)) == {"eastside"} and 1 <= len(places(1)) <= 5
    assert "low star ratings" in got[1]["sources"][0]["review_text"]
    assert places(2) == ["downtown", "downtown", "uptown", "uptown"]
    assert all("wait times" in s["review_text"] for s in got[2]["sources"])
    assert 1 <= len(places(3)) <= 5 and set(places(4)) == {"downtown"} and set(places(5)) == {"midtown"}
    assert "burger bun" in got[4]["sources"][0]["review_text"]
    assert got[6]["sources"] == [] and got[6]["answer"].startswith("I couldn't find")

    answers = payload.filter("error is null").select(F.col("q_id").cast("string").alias("id"), "answer")
    scored = score_answers(cases, answers)
    assert {r["id"]: (r["passed"], r["refused"]) for r in scored.collect()} == {
        "1": (True, False), "2": (True, False), "3": (True, False), "4": (True, False), "5": (True, True), "6": (False, False), "7": (False, False)
    }
    assert summarize(scored).first()["pass_rate"] == 71.4
    save_results(summarize(scored), str(tmp_path / "eval_results"), "run-1")
    assert spark.read.parquet(str(tmp_path / "eval_results")).first()["run"] == "run-1"


def standardize_contract(facts):
    from reviewmill.contracts import FACT_COLUMNS
    return facts.select(*FACT_COLUMNS)
