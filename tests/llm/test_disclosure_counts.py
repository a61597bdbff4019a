"""Terms that reveal entities: counts over different documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from reviewmill.llm import disclosure


def found(spark, rows):
    """Terms with a span, by doc_id."""
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    spans = disclosure.personal_data(docs).select("doc_id", F.explode("spans").alias("s"))
    hits = spans.where(F.col("s.kind").isin(disclosure.REVEALS, disclosure.HINTS)).collect()
    text = dict(rows)
    out = {}
    for r in hits:
        out.setdefault(r.doc_id, set()).add(text[r.doc_id][r.s.start:r.s.end])
    return out


def test_repeated_rows_count_once(spark):
    once = [(i, f"the zanthic order from bob@shop.org came, number {i}") for i in range(10)]
    plain = [(100 + i, f"the order of someone came from here, number {i}") for i in range(90)]
    want = {i: {"zanthic"} for i in range(10)}
    assert found(spark, once + plain) == want
    assert found(spark, once * 2 + plain) == want
    assert found(spark, once * 3 + plain + [(None, "the order")] * 40 + once[:1]) == want


def test_terms_with_digits_marks_and_other_scripts(spark):
    told = ("user_42", "INV-2031", "zanthic", "李明", "ab", "Σίσυφος")
    forms = ("({})", "“{}”", "—{}—", "x/{}", "`{}`=")
    rows = [(i, "bob@shop.org came " + " x ".join(forms[(i + k) % 5].format(t) for k, t in enumerate(told))) for i in range(10)]
    rows += [(100 + i, f"x came from here, number {i}") for i in range(40)]
    assert found(spark, rows) == {i: set(told) for i in range(10)}
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    clean = {r.doc_id: r.text for r in disclosure.sanitise(docs).collect()}
    assert not any(t in clean[i] for t in told for i in range(10)) and clean[100] == rows[10][1] and clean[3].startswith("[email] came ")


def test_text_inside_base_spans_holds_no_terms(spark):
    text = "é bob@shop.org, bob@shop.org at 10.0.0.1 or +1 555 010 9999 bob"
    got = spark.createDataFrame([(text,), ("",), ("a b",)], "text string").select(
        disclosure._open_text(F.col("text")).alias("o"), disclosure._terms(F.col("text")).alias("t")).collect()
    assert len(got[0].o) == len(text) and got[0].t == ["é", "at", "or", "bob"]
    assert got[1].t == [] and got[2].t == ["a", "b"]
