"""Rewriting of texts by spans, against plain Python and the clock."""

from __future__ import annotations

import random
import time

import pytest
from pyspark.sql import functions as F

from reviewmill.llm import spans

SPANS = "id int, text string, spans array<struct<kind:string,start:int,end:int>>"


def replaced(text, found):
    done, at = "", 0
    for kind, start, end in found:
        if start >= at:
            done += text[at:start] + f"[{kind}]"
        at = max(at, end)
    return done + text[at:]


def blanked(text, found):
    cells = list(text)
    for _, start, end in found:
        cells[start:end] = " " * (end - start)
    return "".join(cells)


@pytest.mark.parametrize("overlap", [False, True])
def test_equals_plain_python(spark, overlap):
    rng = random.Random(overlap)
    rows = []
    for k in range(60):
        text = "".join(rng.choice("ab é⭐\n😀") for _ in range(rng.choice([0, 5, 511, 512, 513, 1500, 3000])))
        found, at = [], 0
        for _ in range(rng.choice([0, 1, 3, 200, 400])):
            start = at + rng.choice([0, 1, 5, 600]) if not overlap else rng.randint(0, max(0, len(text) - 1))
            end = start + rng.choice([1, 2, 30])
            if end <= len(text):
                found.append((rng.choice(["x", "yy"]), start, end))
                at = end
        rows.append((k, text, sorted(found, key=lambda s: s[1])))
    got = spark.createDataFrame(rows, SPANS).select(
        "id", spans.replaced(F.col("text"), F.col("spans")).alias("r"), spans.blanked(F.col("text"), F.col("spans")).alias("b")).collect()
    for row in got:
        _, text, found = rows[row.id]
        assert row.b == blanked(text, found)
        assert row.r == replaced(text, found)


def test_a_megabyte_with_many_spans(spark):
    def seconds(n):
        text = ("word éa 12345678 " * (n // 17 + 1))[:n]
        found = [("k", start, start + 8) for start in range(8, n - 20, 60)]
        frame = spark.createDataFrame([(1, text, found)], SPANS).repartition(1).cache()
        frame.count()
        begun = time.perf_counter()
        assert frame.select(F.length(spans.replaced(F.col("text"), F.col("spans"))).alias("n")).first().n == n - 5 * len(found)
        return time.perf_counter() - begun

    seconds(20_000)
    assert seconds(1_000_000) < 30
