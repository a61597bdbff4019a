from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from reviewmill.contracts import FACT_COLUMNS, REFERENCE_COLUMNS
from reviewmill.operators.dimension import conform_dimension, name_dictionary, standardize_dimension
from reviewmill.operators.headers import SourceConfig, schema_issues
from reviewmill.operators.routing import route_keys
from reviewmill.plans.facts import standardize_facts
from reviewmill.sources.files import (
    export_csv, load_config, read_cases, read_facts, read_mapping_config, read_raw_csv, spans_lines, write_silver,
)

CONFIG = """source_dataset;input_column;target_column;rating_divisor
Harbor;review_number;review_id;
Harbor;guest;customer_id;
Harbor;seen;review_date;
Harbor;score;rating;2
Harbor;words;review_text;
harborside;id;review_id;
harborside;stars;rating;
harborside;stars;rating;
harborside;comments;review_text;
"""
HARBOR = '''review_number,guest,seen,score,words,total_spent,tip_amount,tip_percentage,party_size,extra
a1,Guest_1,2024-01-02,8,"good, ""very""
good",,2.5,10,2,zz
a1_copy,Guest_2,2024-01-02,6,x,1,1,1,1,zz
a2,NA,01/03/2024,null,None,20,NaN,,4,zz
a3,Guest_4,junk,4 stars,,30,1,5,,zz
a3,Guest_5,03.01.2024,10,late,31,1,5,2,zz
,Guest_6,2024-01-05,4,no id,1,1,1,1,zz
'''
SIDE = "id,stars,comments\nb1,⭐⭐⭐,fine\nb2,4,\n"
DIMENSION = '''location,restaurant_name,original_city,address,categories,avg_stars,total_reviews
Harbor,Blue Café,Town,"1 Pier, East","Bars, Seafood",4.0,10
Harborside,Red Barn,City,2 Quay,,4.0,20
'''


@pytest.fixture()
def lake(tmp_path):
    raw = tmp_path / "raw" / "2024 spring"
    raw.mkdir(parents=True)
    (raw / "all_harbor_reviews.csv").write_text(HARBOR, encoding="utf-8")
    (raw / "all_harborside_reviews.txt").write_text(SIDE, encoding="utf-8")
    (raw / "all_restaurant_info.csv").write_text(DIMENSION, encoding="utf-8")
    (raw / "all_unknown_reviews.csv").write_text("id\n1\n", encoding="utf-8")
    (tmp_path / "mapping.csv").write_text(CONFIG, encoding="utf-8")
    return tmp_path


def test_config(spark, lake):
    config = load_config(spark, str(lake / "mapping.csv"))
    assert config.sources == ["harborside", "harbor"]
    assert config.divisors == {"harbor": 2, "harborside": 1}
    assert config.headers["harborside"] == {"id": "review_id", "stars": "rating", "comments": "review_text"}
    assert config.conflicting == ()


def test_config_rules(spark):
    rows = [("S", "a", "x", None, 0), ("S", "a", "y", 2.9, 1), ("S", "b", "z", 4.0, 2), ("s", "a", "w", None, 3)]
    frame = spark.createDataFrame(rows, "source_dataset string, input_column string, target_column string, rating_divisor double, pos bigint")
    upper = SourceConfig.from_frame(frame.filter("source_dataset = 'S'"))
    assert upper.headers == {"s": {"a": "y", "b": "z"}} and upper.divisors == {"s": 2} and upper.conflicting == ("s",)
    both = SourceConfig.from_frame(frame)
    assert both.headers == {"s": {"a": "w"}} and both.divisors == {"s": 1}


def test_malformed_config_fails(spark, tmp_path):
    (tmp_path / "bad.csv").write_text("source_dataset;input_column;target_column;rating_divisor\na;b;c;not a number\n")
    with pytest.raises(Exception):
        read_mapping_config(spark, str(tmp_path / "bad.csv")).collect()


def test_files_to_facts(spark, lake):
    config = load_config(spark, str(lake / "mapping.csv"))
    raw, dimension, unknown, missing = read_facts(spark, str(lake), config)
    assert [r["file_key"] for r in unknown.collect()] == ["raw/2024 spring/all_unknown_reviews.csv"] and missing == {}
    facts = standardize_facts(raw, config.divisor_of(F.col("source")))
    assert tuple(facts.columns) == FACT_COLUMNS
    rows = {r["review_id"]: r for r in facts.collect()}
    assert set(rows) == {"a1", "a2", "a3", "b1", "b2"}
    assert rows["a1"]["transaction_count"] == 2 and rows["a1"]["customer_id"] is None and rows["a1"]["total_spent"] is None
    assert rows["a1"]["review_text"] == 'good, "very"\ngood' and rows["a1"]["rating"] == 4.0
    assert rows["a2"]["customer_id"] is None and rows["a2"]["rating"] is None and rows["a2"]["review_text"] is None
    assert str(rows["a2"]["review_date"]) == "2024-01-03" and rows["a2"]["total_spent"] == 20.0 and rows["a2"]["party_size"] == 4
    assert rows["a3"]["rating"] == 5.0 and str(rows["a3"]["review_date"]) == "2024-01-03" and rows["a3"]["review_text"] == "late"
    assert rows["b1"]["rating"] == 3.0 and rows["b1"]["restaurant_id"] == "harborside" and rows["b2"]["rating"] == 4.0
    clean = conform_dimension(standardize_dimension(dimension))
    assert tuple(clean.columns) == REFERENCE_COLUMNS
    assert {r["restaurant_id"]: r["categories"] for r in clean.collect()} == {"harbor": ["Bars", "Seafood"], "harborside": []}


def test_differing_headers_fail_instead_of_shifting(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,stars\n1,2\n")
    (tmp_path / "b.csv").write_text("stars,id\n2,1\n")
    with pytest.raises(Exception):
        read_raw_csv(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")]).collect()


def test_row_order_without_multi_line(spark, tmp_path):
    lines = [f"r{i},{i}" for i in range(5000)]
    (tmp_path / "big.csv").write_text("id,n\n" + "\n".join(lines) + "\n")
    rows = read_raw_csv(spark, str(tmp_path / "big.csv"), multi_line=False).orderBy("pos").collect()
    assert [r["n"] for r in rows] == [str(i) for i in range(5000)]


def test_line_check(spark, lake, tmp_path):
    (tmp_path / "flat.csv").write_text('a,b\n"x, ""y""",2\n')
    assert not spans_lines(spark, [str(tmp_path / "flat.csv")])
    assert spans_lines(spark, [str(lake / "raw/2024 spring/all_harbor_reviews.csv")])
    config = load_config(spark, str(lake / "mapping.csv"))
    whole = standardize_facts(read_facts(spark, str(lake), config)[0], F.lit(1)).orderBy("review_id").collect()
    checked = standardize_facts(read_facts(spark, str(lake), config, large=0)[0], F.lit(1)).orderBy("review_id").collect()
    assert whole == checked


def test_silver_replaces_only_what_it_writes(spark, tmp_path):
    path = str(tmp_path / "silver")
    frame = spark.createDataFrame([("a", 1), ("b", 2)], "restaurant_id string, v int")
    write_silver(frame, path)
    write_silver(frame.filter("restaurant_id = 'a'").withColumn("v", F.lit(9)), path)
    assert sorted(tuple(r) for r in spark.read.parquet(path).select("restaurant_id", "v").collect()) == [("a", 9), ("b", 2)]
    assert sorted(p for p in os.listdir(path) if p.startswith("restaurant_id")) == ["restaurant_id=a", "restaurant_id=b"]


def test_csv_export(spark, lake, tmp_path):
    dimension = standardize_dimension(read_raw_csv(spark, str(lake / "raw/2024 spring/all_restaurant_info.csv")))
    export_csv(conform_dimension(dimension).coalesce(1), str(tmp_path / "out"))
    back = {r["restaurant_id"]: r for r in read_raw_csv(spark, str(tmp_path / "out")).collect()}
    assert back["harbor"]["categories"] == '["Bars", "Seafood"]' and back["harborside"]["categories"] == "[]"
    assert json.loads(back["harbor"]["categories"]) == ["Bars", "Seafood"]
    assert back["harbor"]["restaurant_name"] == "Blue Café" and back["harbor"]["address"] == "1 Pier, East"


def test_dimension_needs_location(spark):
    with pytest.raises(ValueError):
        standardize_dimension(spark.createDataFrame([("x",)], "restaurant_name string"))


def test_name_dictionary(spark):
    rows = [(0, " Blue ", "A"), (1, "blue", "B "), (2, "", "C"), (3, "Green", None), (4, "  ", "D")]
    frame = spark.createDataFrame(rows, "pos int, restaurant_name string, restaurant_id string")
    assert [tuple(r) for r in name_dictionary(frame, "pos").collect()] == [("blue", "b")]


def test_routing(spark):
    keys = [
        "raw/x/Harborside_reviews.txt", "raw/harbor+reviews%2Bnew.csv", "raw/restaurant_info_harbor.csv", "raw/preference_harbor.csv",
        "processed/harbor.csv", "raw/other.csv", "raw/raw/harbor", "raw/harbor.tar.gz", "raw/harbor%zz.csv",
    ]
    frame = spark.createDataFrame([(k,) for k in keys], "key string")
    sources = spark.createDataFrame([("Harbor",), ("harborside",)], "source string")
    got = {r["key"]: (r["file_key"], r["kind"], r["source"], r["target_key"]) for r in route_keys(frame, sources).collect()}
    assert got["raw/x/Harborside_reviews.txt"][1:] == ("fact", "harborside", "processed/x/Harborside_reviews.csv")
    assert got["raw/harbor+reviews%2Bnew.csv"] == ("raw/harbor reviews+new.csv", "fact", "harbor", "processed/harbor reviews+new.csv")
    assert got["raw/restaurant_info_harbor.csv"][1] == "dimension" and got["raw/preference_harbor.csv"][1] == "dimension"
    assert got["processed/harbor.csv"][1:] == ("skipped", None, None) and got["raw/other.csv"][1:] == ("quarantine", None, None)
    assert got["raw/raw/harbor"][3] == "processed/processed/harbor" and got["raw/harbor.tar.gz"][3] == "processed/harbor.tar.csv"
    assert got["raw/harbor%zz.csv"][1] == "fact"


def test_cases(spark, tmp_path):
    cases = [{"id": "1", "category": "ratings", "query": "q", "expected_keywords": ["a"]}, {"_note": "x", "id": "2", "category": "c", "query": "r", "expected_keywords": []}]
    (tmp_path / "cases.json").write_text(json.dumps(cases, indent=1))
    rows = read_cases(spark, str(tmp_path / "cases.json")).orderBy("id").collect()
    assert [(r["id"], r["expected_keywords"]) for r in rows] == [("1", ["a"]), ("2", [])]


def test_schema_issues(spark):
    def frame(columns):
        return spark.createDataFrame([], ", ".join(f"{c} string" for c in columns))
    assert schema_issues(frame(["a", "b"]), ("a", "b")) == {"missing": [], "extra": [], "disordered": []}
    assert schema_issues(frame(["b", "a"]), ("a", "b"))["disordered"] == ["b", "a"]
    assert schema_issues(frame(["a", "c"]), ("a", "b")) == {"missing": ["b"], "extra": ["c"], "disordered": []}
