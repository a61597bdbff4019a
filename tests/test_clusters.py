"""Search over a clustered index: the same hits, and most clusters unread."""

from __future__ import annotations

import numpy as np
import pytest

from reviewmill.operators.clusters import build_clusters, cluster_hits
from reviewmill.operators.search import best_hits, plan_searches


def tables(spark, spread, n=2_000, n_q=30, dim=8):
    rng = np.random.default_rng(4)
    middles = rng.normal(size=(12, dim)) * 4
    x = (middles[rng.integers(0, 12, n)] + rng.normal(size=(n, dim)) * spread).astype(np.float32)
    x[:200] = x[0]
    rows = [(f"{i:05d}", f"r{i % 7}", [float(v) for v in x[i]]) for i in range(n)] + [("none", "r0", None)]
    asked = [(q, [float(v) for v in middles[q % 12] + rng.normal(size=dim) * spread], []) for q in range(n_q)] + [(n_q, [0.0] * dim, []), (n_q + 1, None, [])]
    return (spark.createDataFrame(rows, "review_id string, restaurant_id string, embedding array<float>"),
            spark.createDataFrame(asked, "q_id bigint, embedding array<double>, targets array<string>"))


def rows_of(df):
    return sorted((r["q_id"], r["rank"], r["review_id"], r["restaurant_id"], r["score"]) for r in df.collect())


@pytest.mark.parametrize("spread", [0.05, 1.0, 50.0])
def test_equal_to_a_full_search(spark, tmp_path, spread):
    index, questions = tables(spark, spread)
    build_clusters(index, str(tmp_path / "c"), 24)
    searches = plan_searches(questions)
    hits, told = cluster_hits(spark, str(tmp_path / "c"), searches)
    assert rows_of(hits) == rows_of(best_hits(index, searches))
    row = told.first()
    assert row["searched"] + row["skipped"] == 31 * spark.read.parquet(str(tmp_path / "c/clusters")).count()
    if spread < 1:
        assert row["skipped"] > 2 * row["searched"]


def test_empty_index_and_few_rows(spark, tmp_path):
    index, questions = tables(spark, 1.0)
    searches = plan_searches(questions)
    for name, few in (("none", index.limit(0)), ("few", index.where("review_id IN ('00001', '00900', '01900')"))):
        build_clusters(few, str(tmp_path / name), 24)
        hits, _ = cluster_hits(spark, str(tmp_path / name), searches)
        assert rows_of(hits) == rows_of(best_hits(few, searches))
