from __future__ import annotations

import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from reviewmill.contracts import FACT_COLUMNS, FACT_SCHEMA
from reviewmill.operators import dedup, quality
from reviewmill.plans.facts import standardize_facts

RAW = (
    "source string, review_id string, customer_id string, review_date string, rating string, review_text string, location string, "
    "restaurant_name string, total_spent string, tip_amount string, tip_percentage string, party_size string, age_range string, "
    "gender string, ethnicity string, pos bigint"
)


def make(spark, rows):
    names = [c.split()[0] for c in RAW.split(", ")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], RAW)


def random_rows(n, seed=1, hot=None):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        rid = hot if hot and rng.random() < 0.35 else f"r{rng.randrange(n // 3)}"
        rid += rng.choice(["", "", "", "", "_copy", "_DUP", "_copy_dup"])
        rows.append({
            "source": rng.choice(["a", "b"]), "review_id": None if rng.random() < 0.02 else rid, "customer_id": f"C_{i}",
            "review_date": rng.choice([None, "2024-01-02", "x", "03/04/2024"]), "rating": rng.choice([None, "4 stars", "8", "⭐⭐", "6"]),
            "review_text": rng.choice([None, " ", f"text {i}"]), "total_spent": rng.choice([None, "12.5"]), "tip_amount": rng.choice(["0", "2.5"]),
            "tip_percentage": rng.choice([None, "0", "10"]), "party_size": "3", "gender": "f", "pos": i,
        })
    return rows


def brute(rows):
    """Row-by-row collapse in plain Python."""
    dates = {"2024-01-02": "2024-01-02", "03/04/2024": "2024-03-04"}
    ratings = {"8": 4.0, "6": 3.0, "⭐⭐": 2.0}
    groups, near = defaultdict(list), Counter()
    for r in sorted((r for r in rows if r["review_id"] is not None), key=lambda r: r["pos"]):
        rid = r["review_id"]
        suffix = next((s for s in ("_copy", "_dup") if rid.lower().endswith(s)), None)
        if suffix:
            near[r["source"], rid[: -len(suffix)]] += 1
        else:
            groups[r["source"], rid].append(r)
    out = {}
    for key, members in groups.items():
        count = len(members) + near[key]

        def first(field, table=None):
            values = [table.get(m[field]) if table else m[field] for m in members]
            return next((v for v in values if v is not None), None)

        total = members[0]["total_spent"] and float(members[0]["total_spent"])
        if total is None and members[0]["tip_amount"] == "2.5" and members[0]["tip_percentage"] == "10":
            total = 25.0
        out[key] = (
            first("review_date", dates), first("rating", ratings), first("review_text"),
            members[0]["customer_id"] if count == 1 else None, total if count == 1 else None, count,
        )
    return out


def collected(df):
    rows = df.select("restaurant_id", "review_id", F.date_format("review_date", "yyyy-MM-dd").alias("d"), "rating", "review_text", "customer_id", "total_spent", "transaction_count").collect()
    return {(r[0], r[1]): tuple(r)[2:] for r in rows}


def test_pipeline_against_brute_force(spark):
    rows = random_rows(3000)
    facts = standardize_facts(make(spark, rows), F.lit(2))
    assert tuple(facts.columns) == FACT_COLUMNS
    assert [f.dataType for f in facts.schema] == [f.dataType for f in FACT_SCHEMA]
    assert facts.schema["party_size"].metadata == {"confidence": "low"}
    assert collected(facts) == brute(rows)


def test_hot_id_and_any_partitioning(spark):
    rows = random_rows(3000, seed=2, hot="hot")
    shuffled = list(rows)
    random.Random(9).shuffle(shuffled)
    expected = brute(rows)
    for frame, parts in ((rows, 1), (shuffled, 13)):
        assert collected(standardize_facts(make(spark, frame).repartition(parts), F.lit(2))) == expected


def test_row_balance(spark):
    raw = make(spark, random_rows(2000, seed=4)).cache()
    facts = standardize_facts(raw, F.lit(2))
    rows = quality.reconciliation(raw, facts, dedup.orphan_near_dups(raw), dedup.without_id(raw)).collect()
    assert {r["unexplained"] for r in rows} == {0}
    assert all(r["difference"] > 0 for r in rows)


def test_double_suffix_loses_its_count(spark):
    raw = make(spark, [{"source": "a", "review_id": r, "pos": i} for i, r in enumerate(["x", "x_copy", "x_copy_dup"])])
    assert [tuple(r) for r in dedup.orphan_near_dups(raw).collect()] == [("a", "x_copy", 1)]
    assert standardize_facts(raw, F.lit(1)).first()["transaction_count"] == 2


def test_compat_keeps_the_first_raw_cell(spark):
    rows = [{"source": "a", "review_id": "x", "rating": r, "pos": i} for i, r in enumerate(["4 stars", "8"])]
    assert standardize_facts(make(spark, rows), F.lit(2)).first()["rating"] == 4.0
    assert standardize_facts(make(spark, rows), F.lit(2), compat=True).first()["rating"] is None


def test_rows_of_a_source_without_an_id_column_stay(spark):
    raw = make(spark, [{"source": "a", "rating": "4", "pos": 0}, {"source": "a", "rating": "6", "pos": 1}]).withColumn("has_id", F.lit(False))
    rows = standardize_facts(raw, F.lit(1)).orderBy("rating").collect()
    assert [(r["review_id"], r["rating"], r["transaction_count"]) for r in rows] == [(None, 4.0, 1), (None, 6.0, 1)]


def test_keep_first_and_near_dup_counts(spark):
    raw = make(spark, random_rows(500, seed=6)).filter("review_id is not null")
    first = {(r["source"], r["review_id"]): r["pos"] for r in dedup.keep_first(raw.select("source", "review_id", "pos"), ("source", "review_id")).collect()}
    expected = {}
    for r in sorted(raw.collect(), key=lambda r: r["pos"]):
        expected.setdefault((r["source"], r["review_id"]), r["pos"])
    assert first == expected


def test_row_order_follows_files_not_their_size(spark, tmp_path):
    """Spark reads the largest file first; the first value of an id still comes from the first file."""
    from reviewmill.operators.headers import SourceConfig
    from reviewmill.sources.files import read_facts

    (tmp_path / "raw").mkdir()
    (tmp_path / "raw/north_a.csv").write_text("review_id,rating\nx,1\n")
    (tmp_path / "raw/north_b.csv").write_text("review_id,rating\nx,2\n" + "".join(f"y{i},3\n" for i in range(3000)))
    raw, _, unknown, _ = read_facts(spark, str(tmp_path), SourceConfig({"north": {"review_id": "review_id", "rating": "rating"}}, {}))
    got = {r["review_id"]: r["rating"] for r in standardize_facts(raw, F.lit(1)).collect()}
    assert got["x"] == 1.0 and len(got) == 3001 and unknown.isEmpty()
