from __future__ import annotations

import base64
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewmill.contracts import NA_TOKENS
from reviewmill.functions import (
    chunk_array, derived_total, inner_product, is_base64url, is_blank, is_iso_date, na_to_null, positive_score,
    rating_outcome, round_tenth, split_list, strip, to_number, with_date, with_rating,
)


def column(spark, values, dtype="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i bigint, v {dtype}")


def apply(spark, values, expression, dtype="string"):
    rows = column(spark, values, dtype).select("i", expression(F.col("v")).alias("r")).collect()
    return [r["r"] for r in sorted(rows, key=lambda r: r["i"])]


RATINGS = [
    (None, None, "missing"), ("4", 2.0, "numeric"), (" 10 ", 5.0, "numeric"), ("8.0", 4.0, "numeric"), ("5", 2.5, "numeric"),
    ("4d", None, "unparseable"), ("inf", None, "unparseable"), ("4 stars", None, "unparseable"), ("4 ⭐", None, "unparseable"),
    ("⭐⭐⭐", 3.0, "symbol"), ("⭐️⭐️", 2.0, "symbol"), (" ★ ", 1.0, "symbol"), ("é★", 1.0, "symbol"), ("½é★", 1.0, "symbol"),
    ("--", 2.0, "symbol"), ("⭐⭐⭐⭐⭐⭐⭐", 7.0, "symbol"), ("", None, "unparseable"), ("   ", None, "unparseable"), ("éé", None, "unparseable"),
    ("1e1", 5.0, "numeric"), (".5", 0.2, "numeric"), ("99", 49.5, "numeric"), (" 8 ", 4.0, "numeric"), ("👩‍🍳", 2.0, "symbol"),
]


def test_ratings(spark):
    df = column(spark, [r[0] for r in RATINGS]).withColumn("outcome", rating_outcome(F.col("v")))
    rows = sorted(with_rating(df, F.lit(2), "v").collect(), key=lambda r: r["i"])
    assert [(r["v"], r["outcome"]) for r in rows] == [(v, o) for _, v, o in RATINGS]


def test_divisor_of_one_leaves_numbers_alone(spark):
    rows = with_rating(column(spark, ["2.25", "⭐⭐"]), F.lit(1), "v").orderBy("i").collect()
    assert [r["v"] for r in rows] == [2.25, 2.0]


def test_round_tenth_is_half_even_on_the_binary_value(spark):
    rng = random.Random(3)
    values = [2.25, 2.45, 0.25, 0.35, 1.15, 2.675, 0.05, 4.85] + [rng.randrange(0, 10**6) / d for d in (2, 3, 20, 40, 7) for _ in range(2000)]
    assert apply(spark, values, round_tenth, "double") == [round(v, 1) for v in values]


def test_derived_total_rounds_like_an_array(spark):
    rng = random.Random(5)
    tips = [(rng.randrange(1, 50000) / 100, float(rng.randrange(1, 60))) for _ in range(5000)]
    df = spark.createDataFrame([(i, None, t, p) for i, (t, p) in enumerate(tips)], "i int, total double, tip double, pct double")
    got = [r["x"] for r in df.select("i", derived_total(F.col("total"), F.col("tip"), F.col("pct")).alias("x")).orderBy("i").collect()]
    arr = np.array(tips)
    assert got == list((arr[:, 0] / (arr[:, 1] / 100)).round(2))


@pytest.mark.parametrize("total, tip, pct, expected", [
    (10.0, 1.0, 10.0, 10.0), (None, 2.0, 10.0, 20.0), (None, 0.0, 10.0, None), (None, 2.0, 0.0, None), (None, None, 10.0, None), (None, 2.0, None, None),
])
def test_total_derivation_mask(spark, total, tip, pct, expected):
    df = spark.createDataFrame([(total, tip, pct)], "t double, a double, p double")
    assert df.select(derived_total(F.col("t"), F.col("a"), F.col("p"))).first()[0] == expected


def test_dates(spark):
    cases = [
        ("2024-03-05", "2024-03-05"), ("2024-03-05 23:59:00", "2024-03-05"), ("2024-03-05T01:02:03.5Z", "2024-03-05"), ("03/05/2024", "2024-03-05"),
        ("5.3.2024", "2024-03-05"), ("2024/03/05", "2024-03-05"), ("2024-02-30", None), ("13/13/2024", None), ("2024-03-05 25:00", None),
        ("not a date", None), (None, None), ("", None), (" 2024-12-31 ", "2024-12-31"), ("20240305", None),
    ]
    rows = with_date(column(spark, [c[0] for c in cases]), "v").orderBy("i").collect()
    assert [str(r["v"]) if r["v"] else None for r in rows] == [c[1] for c in cases]


def test_date_format_order_settles_ambiguity(spark):
    day_first = ((r"^\d{1,2}/\d{1,2}/\d{4}\z", "d/M/yyyy"),)
    row = with_date(column(spark, ["03/05/2024"]), "v", day_first).first()
    assert str(row["v"]) == "2024-05-03"


def test_iso_check(spark):
    assert apply(spark, ["2024-02-29", "2023-02-29", "2024-2-29", None, "2024-02-29 "], is_iso_date) == [True, False, False, False, False]


def _decodes(value: str) -> bool:
    try:
        base64.urlsafe_b64decode(value + "=" * (-len(value) % 4))
        return True
    except Exception:
        return False


def test_lenient_ids_agree_with_the_decoder(spark):
    rng = random.Random(11)
    alphabet = "AaZz09-_+/ .!\n=="
    values = ["", "=", "====", "QQ==", "QQ=", "Q=Q=", "ab=c", "é", "abc d", "a" * 5000, "ab" + "=" * 3000, "x" * 4001 + "="]
    values += ["".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 14))) for _ in range(20000)]
    assert apply(spark, values, is_base64url) == [_decodes(v) for v in values]


def test_strict_ids(spark):
    values = ["abcd", "ab", "ab==", "abc=", "a", "ab=", "ab+d", "", None, "abcd=="]
    assert apply(spark, values, lambda c: is_base64url(c, "strict", allow_empty=False)) == [
        True, True, True, True, False, False, False, False, False, False
    ]


def test_blank_strip_and_missing_tokens(spark):
    assert apply(spark, [None, "", " \t  ", " a "], is_blank) == [True, True, True, False]
    values = ["  a b \x1c", "", "x", " \n"]
    assert apply(spark, values, strip) == [v.strip() for v in values]
    assert apply(spark, [*NA_TOKENS, " ", "na"], lambda c: na_to_null(c, NA_TOKENS)) == [None] * len(NA_TOKENS) + [" ", "na"]
    assert apply(spark, ["4d", "inf", "1_0", "-2.", "+.5e-1", "0x10"], to_number) == [None, None, None, -2.0, 0.05, None]


def test_chunks_cover_whole_texts(spark):
    texts = ["", None, "ab", "abcd", "abcde", "ü" * 9]
    got = apply(spark, texts, lambda c: chunk_array(c, 4))
    assert got == [[], [], ["ab"], ["abcd"], ["abcd", "e"], ["üüüü", "üüüü", "ü"]]


def test_split_list(spark):
    assert apply(spark, ["a, b ,c", None, ""], split_list) == [["a", "b", "c"], [], [""]]


def test_scores(spark):
    df = spark.createDataFrame([([1.0, 2.0], [3.0, -4.0])], "a array<float>, b array<float>")
    assert df.select(inner_product(F.col("a"), F.col("b"))).first()[0] == -5.0
    assert apply(spark, [0.5, 0.0, -1.0], positive_score, "double") == [1.5, 1.0, 0.5]
