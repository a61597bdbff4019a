"""The exact dedup query answers every row, repeated ones too."""

from __future__ import annotations


def test_repeated_rows_are_all_answered(spark, tmp_path):
    from reviewmill.llm.queries import op7_exact_dedup

    rows = [(1, "a"), (1, "a"), (2, "a"), (3, "b")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted((r.doc_id, r.keep_id, r.group_size, r.kept) for r in op7_exact_dedup(spark, str(tmp_path)).collect())
    assert got == [(1, 1, 3, True), (1, 1, 3, True), (2, 1, 3, False), (3, 3, 1, True)]


def test_query_and_sql_agree_on_rows_without_id(spark, tmp_path):
    import duckdb

    from reviewmill.llm.oracle import SQL
    from reviewmill.llm.queries import op7_exact_dedup

    rows = [(None, "a"), (None, "a"), (2, "a  b"), (None, "a b"), (4, None), (None, "c")]
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(path)
    got = op7_exact_dedup(spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/*.parquet'")
    cursor = con.execute(SQL["op7_exact_dedup"])
    names = [d[0] for d in cursor.description]
    assert sorted(map(tuple, got.select(*names).collect()), key=repr) == sorted(cursor.fetchall(), key=repr)
