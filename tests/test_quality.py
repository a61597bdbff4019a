from __future__ import annotations

from pyspark.sql import functions as F

from reviewmill.operators import quality
from reviewmill.operators.dimension import conform_dimension, standardize_dimension
from reviewmill.plans.facts import standardize_facts
from tests.test_facts import make

ROWS = [
    {"source": "a", "review_id": "abcd", "customer_id": "c1", "review_date": "2024-01-02", "rating": "4", "review_text": "t", "tip_amount": "2", "tip_percentage": "10", "party_size": "2", "gender": "f", "age_range": "20", "ethnicity": "e", "pos": 1},
    {"source": "a", "review_id": "efgh", "customer_id": "c2", "review_date": "2024-01-02", "rating": "5", "review_text": "t", "total_spent": "9", "tip_amount": "1", "tip_percentage": "9", "party_size": "2", "gender": "f", "age_range": "20", "ethnicity": "e", "pos": 2},
    {"source": "b", "review_id": "ijkl", "customer_id": "c3", "review_date": "2024-01-02", "rating": "3", "review_text": "t", "pos": 3},
    {"source": "b", "review_id": "ijkl", "customer_id": "c4", "review_date": "2024-01-02", "rating": "3", "review_text": "t", "total_spent": "8", "pos": 4},
    {"source": "b", "review_id": "ijkl_copy", "customer_id": "c5", "review_date": "2024-01-02", "rating": "3", "review_text": "t", "pos": 5},
]


def setup(spark):
    raw = make(spark, ROWS)
    reference = spark.createDataFrame([("A", "n", "c", "d", "x"), ("B", "n", "c", "d", "x")], "location string, restaurant_name string, original_city string, address string, categories string")
    return raw, standardize_facts(raw, F.lit(1)), conform_dimension(standardize_dimension(reference))


def found(df):
    return {(r["check_id"], r["dataset"]): (r["n_bad"], r["sample_ids"]) for r in df.collect() if r["n_bad"]}


def test_clean_data_passes(spark):
    raw, facts, reference = setup(spark)
    assert found(quality.dq_results(raw, facts, reference)) == {}
    assert len(quality.dq_results(raw, facts, reference).collect()) == 5


def broken(facts, review_id, **changes):
    here = F.col("review_id") == review_id
    for column, value in changes.items():
        facts = facts.withColumn(column, F.when(here, F.lit(value)).otherwise(F.col(column)))
    return facts


def test_each_row_check_fires(spark):
    raw, facts, reference = setup(spark)
    result = found(quality.dq_results(raw, broken(facts, "abcd", rating=2.5, review_date=None), reference))
    assert result == {("rating_domain", "a"): (1, ["abcd"]), ("date_format", "a"): (1, ["abcd"])}
    text_dates = facts.withColumn("review_date", F.lit("2024-1-2"))
    assert found(quality.row_failures(text_dates).groupBy("check_id", "dataset").agg(F.count("*").alias("n_bad"), F.collect_list("review_id").alias("sample_ids")))["date_format", "a"][0] == 2
    odd = facts.withColumn("review_id", F.when(F.col("review_id") == "abcd", "abc_copy").when(F.col("review_id") == "efgh", "é").otherwise(F.col("review_id")))
    result = {(r["check_id"], r["review_id"]) for r in quality.row_failures(odd).collect()}
    assert ("near_dup_left", "abc_copy") in result and ("id_encoding", "é") in result
    moved = facts.withColumn("dataset", F.lit("a"))
    assert {r["review_id"] for r in quality.row_failures(moved, "dataset").collect() if r["check_id"] == "restaurant_mismatch"} == {"ijkl"}
    kept = {"customer_id": "k", "gender": "k", "age_range": "k", "ethnicity": "k", "total_spent": 5.0, "tip_amount": 5.0, "party_size": 2}
    result = found(quality.dq_results(raw, broken(facts, "ijkl", **kept), reference))
    assert result == {(f"not_nulled_{field}", "b"): (1, ["ijkl"]) for field in kept}


def test_each_raw_check_fires(spark):
    raw, facts, reference = setup(spark)

    def check(changed):
        return found(quality.dq_results(raw, changed, reference))

    assert check(broken(facts, "ijkl", rating=None))["rating_lost", "b"] == (1, ["ijkl"])
    assert check(broken(facts, "abcd", total_spent=0.0))["total_not_derived", "a"] == (1, ["abcd"])
    assert check(facts.filter("review_id <> 'abcd'"))["total_not_derived", "a"] == (1, ["abcd"])
    assert check(facts.unionByName(facts.filter("review_id = 'efgh'")))["id_not_unique", "a"] == (1, ["efgh"])
    fields = ("review_text", "customer_id", "party_size", "age_range", "gender", "ethnicity", "total_spent", "tip_amount")
    result = check(broken(facts, "efgh", **dict.fromkeys(fields)))
    assert result == {(f"lost_{field}", "a"): (1, ["efgh"]) for field in fields}


def test_table_checks_fire(spark):
    raw, facts, reference = setup(spark)
    result = found(quality.dq_results(raw, facts.filter("restaurant_id = 'a'"), reference))
    assert result["restaurant_without_facts", "all"] == (1, ["b"])
    result = found(quality.dq_results(raw, facts, reference.filter("restaurant_id = 'a'")))
    assert result["restaurant_not_in_reference", "all"] == (1, ["b"])
    nulled = reference.withColumn("restaurant_id", F.when(F.col("restaurant_id") == "a", F.col("restaurant_id")))
    assert found(quality.dq_results(raw, facts, nulled))["reference_null_id", "reference"][0] == 1
    assert found(quality.contract_failures(facts.drop("gender").withColumn("x", F.lit(1)), reference))["facts_schema", "facts"] == (2, ["gender", "x"])
    reordered = facts.select(*reversed(facts.columns))
    assert found(quality.contract_failures(reordered, reference))["facts_column_order", "facts"][0] == 1
    assert found(quality.contract_failures(facts, reference.drop("address")))["reference_schema", "reference"] == (1, ["address"])
    assert found(quality.contract_failures(facts, reference.select(*reversed(reference.columns))))["reference_column_order", "reference"][0] == 1


def test_sample_is_bounded_and_count_is_whole(spark):
    from reviewmill.operators.reports import counted_with_sample
    rows = spark.range(1000).selectExpr("'k' AS key", "lpad(cast(id AS string), 4, '0') AS v").repartition(9)
    row = counted_with_sample(rows, ("key",), "v").first()
    assert row["n_bad"] == 1000 and row["sample_ids"] == [f"{i:04d}" for i in range(25)]
