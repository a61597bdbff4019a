"""Exact discrete percentiles against sorting, over more values than a sketch of 100,000 would keep."""

from __future__ import annotations

import math
import random

from pyspark.sql import functions as F

from reviewmill.operators.profile import discrete_percentiles, domain_gaps, interpolated_percentile

SHARES = {"low": 0.0, "median": 0.5, "p99": 0.99, "top": 1.0}


def test_small_groups(spark):
    rng = random.Random(9)
    groups = {g: [rng.choice([-3.5, -0.1, 0.0, 0.25, 1.0, 1.0, 7.0, 1e9]) * rng.choice([1, 1, 2.5]) for _ in range(rng.randint(1, 40))] for g in "abcdefgh"}
    rows = spark.createDataFrame([(g, v) for g, values in groups.items() for v in values], "g string, v double")
    got = {r["g"]: r for r in discrete_percentiles(rows, "g", "v", SHARES).collect()}
    for g, values in groups.items():
        ordered = sorted(values)
        for name, share in SHARES.items():
            assert got[g][name] == ordered[max(1, math.ceil(share * len(ordered))) - 1]


def test_many_values(spark):
    n = 400_000
    rows = spark.range(n).select(F.lit("x").alias("g"), (F.pmod(F.col("id") * 7919, F.lit(n)) / 8).alias("v"))
    got = discrete_percentiles(rows, "g", "v", SHARES).first()
    assert (got["low"], got["median"], got["p99"], got["top"]) == (0.0, (n // 2 - 1) / 8, (round(n * 0.99) - 1) / 8, (n - 1) / 8)


def test_wide_ranges(spark):
    rows = spark.createDataFrame([("x", 5), ("x", 150_000)], "source string, n int")
    gaps = domain_gaps(rows, "n", 1, 150_001)
    assert gaps.count() == 149_999 and gaps.schema["n"].dataType.simpleString() == "int"


def test_interpolated_against_numpy(spark):
    import numpy as np

    rng = random.Random(3)
    groups = {g: [round(rng.expovariate(0.2), 3) * rng.choice([1, 1, -1]) for _ in range(rng.randint(1, 300))] for g in "abcde"}
    rows = spark.createDataFrame([(g, v) for g, own in groups.items() for v in own] + [("a", None), ("z", None)], "g string, v double")
    for share in (0.0, 0.37, 0.95, 1.0):
        got = {r["g"]: r["p"] for r in interpolated_percentile(rows, "g", "v", share, "p").collect()}
        assert set(got) == set(groups) and all(abs(got[g] - np.percentile(own, share * 100)) < 1e-9 for g, own in groups.items())
